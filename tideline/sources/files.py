"""Bounded and streaming sources of rows and text lines."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def from_collection(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal records."""
    return spark.createDataFrame(list(rows), schema)


def from_elements(spark: SparkSession, *elements, name: str = "value") -> DataFrame:
    """Literal values as a one-column table."""
    return spark.createDataFrame([(element,) for element in elements], [name])


def from_source(source: Callable[..., DataFrame], *arguments) -> DataFrame:
    """Records of a source of the user's own: any function that gives a DataFrame, bounded or not.

    Splitting, pruning and retries are those of the readers that the function is made of.
    """
    return source(*arguments)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, blank lines included."""
    return spark.read.text(path)


def stream_text_lines(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a socket. Cannot be replayed after a failure, so for trying things out only."""
    return spark.readStream.format("socket").options(host=host, port=port).load()


def csv_table(spark: SparkSession, path: str, schema: str, view: str | None = None) -> DataFrame:
    """CSV files under a declared schema, registered as `view`; fields it cannot read are null."""
    df = spark.read.schema(schema).csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def stream_csv_table(
    spark: SparkSession, path: str, schema: str, view: str | None = None, files_per_batch: int = 1
) -> DataFrame:
    df = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )
    if view:
        df.createOrReplaceTempView(view)
    return df
