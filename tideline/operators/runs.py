"""Runs of rows without a large gap between neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import slot_start
from tideline.operators import scan
from tideline.session import stored


def gap_slots(
    df: DataFrame, key: Sequence[str], at: str, gap: int, touching: bool,
    max_rows: int = scan.MAX_ROWS, **aggregates: Column,
) -> DataFrame:
    """(*key, slot, first, last, *aggregates, run): the rows summed up per time slot of length
    `gap`, named by its start, and the run each slot belongs to, named by its first time.

    Two rows of one slot are always in the same run, so only one row per slot has to be put in
    order, however many rows a key has. A new run starts at a distance of `gap`, or above `gap`
    if `touching`. Rows without a time are in no run.
    """
    slots = df.dropna(subset=[at]).groupBy(*key, slot_start(F.col(at), gap).alias("slot")).agg(
        F.min(at).alias("first"),
        F.max(at).alias("last"),
        *[column.alias(name) for name, column in aggregates.items()],
    )
    slots = stored(slots, "slots")
    seen = scan.cut(slots, key, ["slot"], max_rows).extend(
        [scan.previous("_before", F.col("last"), ["slot"])]
    )
    distance = F.col("first") - F.col("_before.value")
    apart = distance > gap if touching else distance >= gap
    start = F.when(F.col("_before").isNull() | apart, F.col("first"))
    marked = seen.with_columns({"_start": start})
    return marked.extend([scan.running_max("run", F.col("_start"))]).rows.drop("_before", "_start")
