"""Greedy chains: after a chosen row, the next chosen row of the group is the first one at least
`step` later. Each choice depends on the last, so the rows of a group must be walked in order.

Groups of at most `max_rows` rows are walked side by side, many groups per task, over sorted
partitions and without holding a group in memory. A larger group is first cut where two neighbours
are `step` or more apart, since the later one is chosen in any case. A run that is still too large
is not walked at all: every row gets a pointer to its successor, the pointers are doubled with
joins, and the rows reached from the first one are marked. The number of joins grows with the
logarithm of the chain's length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.records import first_record
from tideline.functions.time import slot_start
from tideline.operators import runs, scan
from tideline.session import stored


def greedy_chain(
    df: DataFrame,
    group: Sequence[str],
    at: str,
    step: int,
    strict: bool = False,
    order: Sequence[str] = (),
    max_rows: int = scan.MAX_ROWS,
) -> DataFrame:
    """The chosen rows of `df`.

    `at` is a bigint time; of rows at the same time only the first in `order` can be chosen. Rows
    without a time or with a null in a group column take no part. The first row of a group is chosen; after a chosen row at t the next one
    is the first with `at >= t + step`, or `at > t + step` if `strict`.
    """
    names = list(group)
    df = df.dropna(subset=[*names, at])
    reach = step + 1 if strict else step
    small, large = _by_size(df, names, max_rows)
    chosen = _walked(small, names, at, order, reach)
    if large is None:
        return chosen

    rest = [c for c in df.columns if c not in [*names, at]]
    single = large.groupBy(*names, at).agg(first_record(order, rest, "_rest")) if rest else (
        large.distinct()
    )
    unpacked = single.select(*names, at, "_rest.*") if rest else single
    slots = runs.gap_slots(large, names, at, reach, touching=False, max_rows=max_rows)
    marked = stored(
        unpacked.withColumn("slot", slot_start(F.col(at), reach)).join(
            slots.select(*names, "slot", "run"), [*names, "slot"]
        ),
        "marked",
    )
    short, long = _by_size(marked, [*names, "run"], max_rows)
    chosen = chosen.unionByName(
        _walked(short, [*names, "run"], at, (), reach).select(*df.columns)
    )
    if long is None:
        return chosen
    path = _jumped(long, [*names, "run"], at, reach, max_rows)
    return chosen.unionByName(
        long.join(path, [*names, "run", at], "left_semi").select(*df.columns)
    )


def _by_size(
    df: DataFrame, group: list[str], max_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups up to the limit, and those of the groups beyond it."""
    sizes = df.groupBy(*group).count()
    above = stored(sizes.filter(F.col("count") > max_rows).drop("count"), "large")
    if above.isEmpty():
        return df, None
    # Spark knows the size of a stored table and broadcasts it or not
    return df.join(above, group, "left_anti"), df.join(above, group, "left_semi")


def _walked(
    df: DataFrame, group: list[str], at: str, order: Sequence[str], reach: int
) -> DataFrame:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bar = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = [batch.column(name) for name in group]
            changed = np.zeros(batch.num_rows, dtype=bool)
            changed[0] = tuple(c[0].as_py() for c in columns) != current
            for c in columns:
                codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy()
                changed[1:] |= codes[1:] != codes[:-1]
            bounds = np.unique(np.concatenate([[0], np.flatnonzero(changed), [batch.num_rows]]))
            times = batch.column(at).to_numpy()
            chosen = []
            for begin, end in zip(bounds[:-1], bounds[1:]):
                if changed[begin]:
                    bar = times[begin]
                i = begin + np.searchsorted(times[begin:end], bar)
                while i < end:
                    chosen.append(i)
                    bar = times[i] + reach
                    i += np.searchsorted(times[i:end], bar)
            current = tuple(c[-1].as_py() for c in columns)
            yield batch.take(pa.array(chosen, pa.int64()))

    ordered = df.repartition(*group).sortWithinPartitions(*group, at, *order)
    return ordered.mapInArrow(walk, df.schema)


def _jumped(df: DataFrame, group: list[str], at: str, reach: int, max_rows: int) -> DataFrame:
    nodes = df.select(*group, at)
    probes = nodes.select(*group, F.col(at).alias("_from"), (F.col(at) + reach).alias(at))
    pointers = scan.first_at_or_after(probes, nodes, group, at, at, "_to", max_rows)
    jumps = [
        stored(
            pointers.filter(F.col("_to").isNotNull()).select(
                *group, F.col("_from").alias(at), "_to"
            )
        )
    ]
    while True:
        onward = jumps[-1].select(*group, F.col(at).alias("_to"), F.col("_to").alias("_beyond"))
        doubled = stored(
            jumps[-1].join(onward, [*group, "_to"]).select(
                *group, at, F.col("_beyond").alias("_to")
            )
        )
        if doubled.isEmpty():
            break
        jumps.append(doubled)
    path = nodes.groupBy(*group).agg(F.min(at).alias(at))
    for jump in reversed(jumps):
        landed = path.join(jump, [*group, at]).select(*group, F.col("_to").alias(at))
        path = stored(path.unionByName(landed))
    return path
