"""First occurrences per key: for ever, until a time to live runs out, and across runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.records import first_record
from tideline.functions.time import epoch_us
from tideline.operators.chain import greedy_chain
from tideline.operators.scan import MAX_ROWS


def dedup_forever(
    df: DataFrame, key: Sequence[str], order: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """(*key, *fields) of the first row per key, found by partial and final aggregation."""
    return df.groupBy(*key).agg(first_record(order, fields, "_first")).select(*key, "_first.*")


def dedup_ttl(
    df: DataFrame, key: Sequence[str], ts: str, order: Sequence[str], fields: Sequence[str],
    ttl: int, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """(*key, *fields) of the rows that come `ttl` microseconds or more after the key's last
    output row, and of each key's first row. Suppressed rows do not prolong the wait. Rows without a
    key or a time take no part."""
    kept = [c for c in dict.fromkeys([*order, *fields]) if c not in key]
    timed = df.select(*key, epoch_us(F.col(ts)).alias("_us"), *kept)
    chosen = greedy_chain(timed, key, "_us", ttl, order=order, max_rows=max_rows)
    return chosen.select(*key, *fields)
