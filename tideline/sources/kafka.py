"""Kafka topics as line sources and sinks.

Offsets are kept in the query's checkpoint; a consumer group is only a label for monitoring. The
connector is a package of its own that has to be on the cluster (`spark-sql-kafka`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(
    servers: str, topic: str, group: str | None = None, starting: str = "latest"
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group:
        options["groupIdPrefix"] = group
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def topic_lines(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The values of a topic as text lines in `value`."""
    reader = spark.readStream.format("kafka").options(**source_options(servers, topic, **options))
    return as_lines(reader.load())


def as_lines(records: DataFrame) -> DataFrame:
    return records.select(F.col("value").cast("string").alias("value"))


def csv_payload(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """CSV values as columns; a field that cannot be read is null."""
    return lines.select(F.from_csv(value, schema).alias("_row")).select("_row.*")


def to_csv_payload(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Rows as CSV text in `value`, the form a topic takes."""
    return df.select(F.to_csv(F.struct(*(columns or df.columns))).alias("value"))


def to_text_payload(df: DataFrame, name: str) -> DataFrame:
    """Rows as `Name{field='text', field=number}` in `value`."""
    parts = []
    for column, kind in df.dtypes:
        shown = F.col(column).cast("string")
        if kind == "string":
            shown = F.concat(F.lit("'"), shown, F.lit("'"))
        parts.append(F.concat(F.lit(f"{column}="), F.coalesce(shown, F.lit("null"))))
    body = F.concat_ws(", ", *parts)
    return df.select(F.concat(F.lit(name + "{"), body, F.lit("}")).alias("value"))


def write_topic(payload: DataFrame, servers: str, topic: str, checkpoint: str):
    """Start a streaming query that appends the payload to a topic."""
    return (
        payload.writeStream.format("kafka")
        .options(**sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .start()
    )
