"""Updating results as a log of added and retracted rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import scan


def measures(value: str) -> list[scan.Measure]:
    """What the log is made from: count and total with the row, and the total before it."""
    number = F.col(value)
    return [
        scan.running_count("_cnt"),
        scan.running_sum("_total", number),
        scan.running_sum("_total_before", number, inclusive=False),
    ]


def as_changes(found: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(*order, op, *key, cnt, total) of rows with their `measures`."""
    old = F.struct(
        F.lit(False).alias("op"), (F.col("_cnt") - 1).alias("cnt"),
        F.col("_total_before").alias("total"),
    )
    new = F.struct(
        F.lit(True).alias("op"), F.col("_cnt").alias("cnt"), F.col("_total").alias("total")
    )
    change = F.explode(F.when(F.col("_cnt") == 1, F.array(new)).otherwise(F.array(old, new)))
    return found.select(*order, *key, change.alias("_change")).select(
        *order, *key, "_change.op", "_change.cnt", "_change.total"
    )


def retract_changelog(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
    max_rows: int = scan.MAX_ROWS,
) -> DataFrame:
    """Count and total per key as a changelog: (*order, op, *key, cnt, total).

    Each input row takes back the key's last result (`op` false), if there is one, and adds the
    new one (`op` true).
    """
    return as_changes(scan.running(df, key, order, measures(value), max_rows), key, order)
