"""Printing, for trying things out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def show(df: DataFrame, label: str | None = None, rows: int = 20):
    """Print rows of a table, or start a query that prints a stream; `label` becomes a column."""
    labelled = df.select(F.lit(label).alias("label"), "*") if label else df
    if df.isStreaming:
        return labelled.writeStream.format("console").option("numRows", rows).start()
    labelled.show(rows, truncate=False)
    return None
