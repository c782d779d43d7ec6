"""Aggregates that the user writes: create, add, merge and result.

Every task adds its rows to accumulators of its own, one per key, and gives them out as rows. They are
merged as a tree: in each round up to `fan` accumulators of a key meet, dealt by key and place in the
tree, so a key with most of the rows is in no one task, neither with its rows nor with all its
accumulators. Only the last round makes results.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructType

from tideline.session import stored

FAN = 32
#: accumulators that a task holds before it gives them out
MAX_HELD = 100_000


class Accumulator(ABC):
    """An aggregate of rows. `state` and `output` are the columns of an accumulator and of a result.

    `merge` must be associative, and give the same in any order of its arguments up to what `result`
    makes of it. `create` is neutral: merging it changes nothing.
    """

    state: str
    output: str

    @abstractmethod
    def create(self) -> tuple: ...

    @abstractmethod
    def add(self, state: tuple, row: tuple) -> tuple: ...

    @abstractmethod
    def merge(self, one: tuple, other: tuple) -> tuple: ...

    @abstractmethod
    def result(self, state: tuple) -> tuple: ...


class Mean(Accumulator):
    """The mean of a whole number that counts `unit`-ths; null without values."""

    state = "total bigint, n bigint"

    def __init__(self, name: str = "mean", unit: int = 1):
        self.output, self.unit = f"{name} double", unit

    def create(self) -> tuple:
        return 0, 0

    def add(self, state: tuple, row: tuple) -> tuple:
        return state if row[0] is None else (state[0] + row[0], state[1] + 1)

    def merge(self, one: tuple, other: tuple) -> tuple:
        return one[0] + other[0], one[1] + other[1]

    def result(self, state: tuple) -> tuple:
        return (state[0] / (state[1] * self.unit) if state[1] else None,)


class SumWithLast(Accumulator):
    """The sum of the second column, null without values, and the highest value of the first."""

    state = output = "last bigint, total bigint"

    def create(self) -> tuple:
        return None, None

    def add(self, state: tuple, row: tuple) -> tuple:
        return self.merge(state, row)

    def merge(self, one: tuple, other: tuple) -> tuple:
        known = [[x for x in pair if x is not None] for pair in zip(one, other, strict=True)]
        return max(known[0], default=None), sum(known[1]) if known[1] else None

    def result(self, state: tuple) -> tuple:
        return state


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def aggregated(
    df: DataFrame, key: Sequence[str], values: Sequence[str], accumulator: Accumulator,
    fan: int = FAN, max_held: int = MAX_HELD,
) -> DataFrame:
    """(*key, *output) of each key; nulls in the key are a key like others."""
    keys = df.select(*key).schema
    state, output = (StructType.fromDDL(x) for x in (accumulator.state, accumulator.output))
    held = StructType([*keys.fields]).add("_part", IntegerType())
    # the state's columns by number, as the key may have the same names
    for i, field in enumerate(state.fields):
        held = held.add(f"_s{i}", field.dataType)
    made = StructType([*keys.fields, *output.fields])
    held_arrow, made_arrow = to_arrow_schema(held), to_arrow_schema(made)
    n = len(key)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = TaskContext.get().partitionId(), {}
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                name = row[:n]
                at = sums.get(name)
                sums[name] = accumulator.add(accumulator.create() if at is None else at, row[n:])
            if len(sums) > max_held:
                yield _batch([(*k, part, *s) for k, s in sums.items()], held_arrow)
                sums = {}
        yield _batch([(*k, part, *s) for k, s in sums.items()], held_arrow)

    def merge(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        at, sums = None, None

        def out() -> pa.RecordBatch:
            if last:
                return _batch([(*at[:n], *accumulator.result(sums))], made_arrow)
            return _batch([(*at, *sums)], held_arrow)

        for batch in batches:
            done = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at is not None and row[: n + 1] == at:
                    sums = accumulator.merge(sums, row[n + 1 :])
                    continue
                if at is not None:
                    done.append((at, sums))
                at, sums = row[: n + 1], row[n + 1 :]
            if done:
                if last:
                    yield _batch([(*a[:n], *accumulator.result(s)) for a, s in done], made_arrow)
                else:
                    yield _batch([(*a, *s) for a, s in done], held_arrow)
        if at is not None:
            yield out()

    partials = stored(df.select(*key, *values).mapInArrow(add, held), "partials")
    parts = (partials.agg(F.max("_part")).first()[0] or 0) + 1
    while True:
        parts = -(-parts // fan)
        last = parts == 1
        placed = partials.withColumn("_part", F.floor(F.col("_part") / fan).cast("int"))
        met = placed.repartition(*key, "_part").sortWithinPartitions(*key, "_part")
        if last:
            return met.mapInArrow(lambda b: merge(b, True), made)
        partials = met.mapInArrow(lambda b: merge(b, False), held)
