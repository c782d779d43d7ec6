"""Rolling aggregates: one output row per input row, over the rows of the key seen so far."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators import scan
from tideline.operators.scan import MAX_ROWS


def _newest_first(order: Sequence[str]) -> list[Column]:
    """Sort fields under which the earliest row of equal values is the highest."""
    return [(-F.col(name)).alias(f"_earlier{i}") for i, name in enumerate(order)]


def rolling_sum(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, name: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    return scan.running(df, key, order, [scan.running_sum(name, F.col(value))], max_rows)


def rolling_count(
    df: DataFrame, key: Sequence[str], order: Sequence[str], name: str, max_rows: int = MAX_ROWS
) -> DataFrame:
    return scan.running(df, key, order, [scan.running_count(name)], max_rows)


def rolling_max_by(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Per input row the whole record with the highest value so far, the first one on ties.

    `order` must hold numbers. The output keeps the input's columns, now those of the record, and
    says in `at_<order>` which input row it answers.
    """
    record = F.struct(*df.columns)
    ranked = F.struct(F.col(value).alias("_value"), *_newest_first(order), record.alias("_record"))
    best = scan.running_max("_best", F.when(F.col(value).isNotNull(), ranked))
    return scan.running(df, key, order, [best], max_rows).select(
        *[F.col(name).alias(f"at_{name}") for name in order], "_best._record.*"
    )


def rolling_reduce(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Per input row its own fields with `value` replaced by the highest value so far."""
    found = scan.running(
        df, key, order, [scan.running_max("_highest", F.col(value))], max_rows
    )
    return found.withColumn(value, F.col("_highest")).drop("_highest")


def count_window(
    df: DataFrame, key: Sequence[str], order: Sequence[str], size: int, slide: int, value: str,
    total: str = "total", count: str = "n", max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Sliding count window: every `slide`-th row of a key fires over the last `size` rows."""
    framed = scan.framed(
        df, key, order, size - 1,
        {
            total: lambda w: F.sum(value).over(w),
            count: lambda w: F.count(F.lit(1)).over(w),
        },
        position="_nth",
        max_rows=max_rows,
    )
    return framed.filter(F.col("_nth") % slide == 0).drop("_nth")


def over_rows(
    df: DataFrame, key: Sequence[str], order: Sequence[str], preceding: int, value: str,
    counted: str, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Count and total over the current row and the `preceding` ones."""
    return scan.framed(
        df, key, order, preceding,
        {
            "cnt": lambda w: F.count(counted).over(w),
            "total": lambda w: F.sum(value).over(w),
        },
        max_rows=max_rows,
    )
