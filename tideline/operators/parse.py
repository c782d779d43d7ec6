"""Line events to typed rows. A line that cannot be read never stops the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.strings import split_line


def _whole_number(field: Column) -> Column:
    """bigint; a padded number is an error, as it is for a strict parser."""
    return F.when(F.trim(field) == field, field.try_cast("bigint"))


def _with_fields(lines: DataFrame, line: str) -> DataFrame:
    """(line, fields): a generator keeps the split from being repeated for every use of a field."""
    once = F.transform(F.array(line), lambda text: F.struct(split_line(text).alias("fields")))
    return lines.select(F.col(line).alias("line"), F.inline(once))


def read_sensor(lines: DataFrame, line: str = "value") -> DataFrame:
    """Every line as (id, timestamp, temperature, line, malformed); more than 3 fields are fine."""
    parsed = _with_fields(lines, line).select(
        F.get("fields", F.lit(0)).alias("id"),
        _whole_number(F.get("fields", F.lit(1))).alias("timestamp"),
        F.get("fields", F.lit(2)).try_cast("double").alias("temperature"),
        "line",
    )
    bad = F.col("id").isNull() | F.col("timestamp").isNull() | F.col("temperature").isNull()
    return parsed.withColumn("malformed", bad)


def parse_sensor(lines: DataFrame, line: str = "value") -> DataFrame:
    return read_sensor(lines, line).filter(~F.col("malformed")).drop("malformed", "line")


def malformed_sensor(lines: DataFrame, line: str = "value") -> DataFrame:
    return read_sensor(lines, line).filter("malformed").select("line")


def parse_fare(lines: DataFrame, line: str = "value") -> DataFrame:
    """(driverId, timeStamp, fares) of the lines with exactly three readable fields."""
    parsed = _with_fields(lines, line).filter(F.size("fields") == 3).select(
        F.col("fields")[0].alias("driverId"),
        _whole_number(F.col("fields")[1]).alias("timeStamp"),
        F.col("fields")[2].try_cast("float").alias("fares"),
    )
    return parsed.filter(F.col("timeStamp").isNotNull() & F.col("fares").isNotNull())


def map_pair(lines: DataFrame, names: tuple[str, str], line: str = "value") -> DataFrame:
    """One row per line: the two fields, or nulls where the line has not exactly two."""
    whole = F.size("fields") == 2
    return _with_fields(lines, line).select(
        *[F.when(whole, F.col("fields")[i]).alias(name) for i, name in enumerate(names)]
    )


def flat_map_pair(lines: DataFrame, names: tuple[str, str], line: str = "value") -> DataFrame:
    """As `map_pair`, but a bad line gives no row."""
    return _with_fields(lines, line).filter(F.size("fields") == 2).select(
        *[F.col("fields")[i].alias(name) for i, name in enumerate(names)]
    )


def first_two(lines: DataFrame, names: tuple[str, str], line: str = "value") -> DataFrame:
    """The first two fields of every line that has them; further fields are ignored."""
    return _with_fields(lines, line).filter(F.size("fields") >= 2).select(
        *[F.col("fields")[i].alias(name) for i, name in enumerate(names)]
    )
