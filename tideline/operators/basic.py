"""Row-wise operators, splits, unions and exchanges."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.strings import split_line, utf16_length


def flat_map_split(df: DataFrame, text: str, separator: str = ",", word: str = "word") -> DataFrame:
    """One row per part of `text`; a text without parts gives no row."""
    return df.select(F.explode(split_line(F.col(text), separator)).alias(word))


def lateral_split(df: DataFrame, text: str, separator: str = ",") -> DataFrame:
    """Every row joined with the (word, length) rows of its text; no parts, no row."""
    word = F.explode(split_line(F.col(text), separator)).alias("word")
    return df.select("*", word).withColumn("length", utf16_length(F.col("word")))


def with_tag(df: DataFrame, value: str, threshold: float, tag: str = "tag") -> DataFrame:
    """Rows named `high` where value > threshold and `low` elsewhere."""
    return df.withColumn(tag, F.when(F.col(value) > threshold, "high").otherwise("low"))


def select_tags(df: DataFrame, tags: Sequence[str], tag: str = "tag") -> DataFrame:
    return df.filter(F.col(tag).isin(*tags))


def side_output(df: DataFrame, main: Column) -> tuple[DataFrame, DataFrame]:
    """(main, side): the rows where the condition holds, and all the others, nulls included."""
    holds = F.coalesce(main, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def co_map(
    first: DataFrame, second: DataFrame, of_first: Sequence[Column], of_second: Sequence[Column]
) -> DataFrame:
    """Two inputs of different type, each with its own projection, as one output."""
    return first.select(*of_first).unionByName(
        second.select(*of_second), allowMissingColumns=True
    )


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union; the inputs must have the same columns and types."""
    for other in others:
        if other.dtypes != first.dtypes:
            raise ValueError(f"cannot unite {other.dtypes} with {first.dtypes}")
        first = first.union(other)
    return first


def side_outputs(df: DataFrame, outputs: dict[str, Column], rest: str) -> DataFrame:
    """Every row once with the name of its `output`: the first whose condition holds, else `rest`."""
    name = F.lit(rest)
    for label, condition in reversed(outputs.items()):
        name = F.when(condition, F.lit(label)).otherwise(name)
    return df.withColumn("output", name)


def co_map_split(
    df: DataFrame, first: Column, one: dict[str, Column], other: dict[str, Column]
) -> DataFrame:
    """Two maps over the two parts of one input, in one pass: `one` where `first` holds, `other`
    where it doesn't, rows of neither (a null condition) left out; missing fields are null."""
    names = list(dict.fromkeys([*one, *other]))
    null = F.lit(None)
    known = df.filter(first.isNotNull())
    return known.select(
        *[F.when(first, one.get(n, null)).otherwise(other.get(n, null)).alias(n) for n in names]
    )


def connect(first: DataFrame, second: DataFrame, marker: str = "input") -> DataFrame:
    """Two inputs as one tagged stream (1 and 2), the input of a two-input stateful operator."""
    return first.withColumn(marker, F.lit(1)).unionByName(
        second.withColumn(marker, F.lit(2)), allowMissingColumns=True
    )


def key_by(df: DataFrame, *key: Column | str, partitions: int | None = None) -> DataFrame:
    """Rows of a key side by side, for an operator that has no shuffle of its own."""
    return df.repartition(partitions, *key) if partitions else df.repartition(*key)


def shuffled(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows spread at random, with a fixed seed so that a retried task sends them the same way.

    Without a number, into the session's shuffle partitions, which adaptive execution sizes.
    """
    at = F.rand(seed=17)
    return df.repartition(partitions, at) if partitions else df.repartition(at)


def rebalanced(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt out evenly, one partition after another.

    Without a number, into as many parts of an even size as the data needs.
    """
    return df.repartition(partitions) if partitions else df.hint("rebalance")


def in_one_task(df: DataFrame) -> DataFrame:
    """Everything in one partition. For small results only; no operator here relies on it."""
    # a coalesce would pull the operators below it into the one task as well
    return df.repartition(1)


def rich_map(
    df: DataFrame,
    schema: str,
    open: Callable[[], object],
    call: Callable[[object, pa.RecordBatch], pa.RecordBatch],
    close: Callable[[object], None],
) -> DataFrame:
    """Map Arrow batches with something opened once per task and closed when the task is done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resource = open()
        try:
            for batch in batches:
                yield call(resource, batch)
        finally:
            close(resource)

    return df.mapInArrow(run, schema)
