"""The driver's tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.time import HOUR, MINUTE, epoch_ms, epoch_us, from_epoch_us
from tideline.session import shared_path, table

BOUND = HOUR
LATENESS = 30 * MINUTE
WINDOW = HOUR

# the same scaled events for the oracle
CENTS = "cast(round(value * 100) as bigint)"
ARRIVED = "(ts + to_minutes(cast(((event_id * 7919) % 13) * 15 as integer)))"


def cents(value: str = "value") -> Column:
    """Two-decimal values as whole hundredths, so that sums are exact in any order."""
    return F.round(F.col(value) * 100).cast("bigint")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as readings: id = event_type, with exact cents."""
    return events(spark, folder).select(
        "event_id", "user_id", F.col("event_type").alias("id"), "ts", "value",
        cents().alias("cents"),
    )


def disordered(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with an arrival time up to three hours after the event time."""
    delay = F.pmod(F.col("event_id") * 7919, F.lit(13)) * 15 * MINUTE
    return readings(spark, folder).withColumn(
        "arrived", from_epoch_us(epoch_us(F.col("ts")) + delay)
    )


def sensor_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as text lines `type,ms,value`; error events carry no value."""
    line = F.concat_ws(
        ",", "event_type", epoch_ms(F.col("ts")).cast("string"),
        F.when(F.col("event_type") != "error", F.col("value").cast("string")),
    )
    return events(spark, folder).select("event_id", line.alias("value"))


# `sensor_lines` for the oracle
LINES = """(select event_id, concat_ws(',', event_type, cast(epoch_us(ts) // 1000 as varchar),
  case when event_type <> 'error' then cast(value as varchar) end) as value from events)"""


def action_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as text lines `user,action`; error events carry no action."""
    line = F.concat_ws(
        ",", F.col("user_id").cast("string"),
        F.when(F.col("event_type") != "error", F.col("event_type")),
    )
    return events(spark, folder).select("event_id", line.alias("value"))


def written_lines(lines: DataFrame, name: str) -> str:
    """The lines as text files in the shared folder; gives their path."""
    path = shared_path(lines.sparkSession, name)
    lines.select("value").write.text(path)
    return path
