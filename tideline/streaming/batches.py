"""Running values over a stream whose keys may be hot.

Keyed state puts all rows of a key of one micro-batch into one task. Here each micro-batch goes
through the segmented scan instead, and what the batches before it came to is kept as a table with
one row per key (`state.KeyedState`). A batch reads and writes the rows of its own keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from tideline.operators import scan
from tideline.session import stored
from tideline.sinks.tables import batch_writer
from tideline.streaming.state import KeyedState, renamed, same_key


def running_batches(
    key: Sequence[str], order: Sequence[str], measures: Sequence[scan.Measure], path: str,
    state: str, max_rows: int = scan.MAX_ROWS,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Callable[[DataFrame, int], None]:
    """A writer for `foreachBatch`: rows with their running values go to `path/batch=<id>`, after
    `finish` has made of them what is wanted.

    Batches must follow each other in `order`. A batch that is run again reads the state of the
    batch before it and so writes the same rows.
    """
    names = [f"_{m.name}" for m in measures]
    table = KeyedState(state, key)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.count()
        table.prune(spark, batch_id)
        found = scan.running(batch, key, order, measures, max_rows, rows)
        latest = batch.groupBy(*key).agg(*[m.summary.alias(n) for m, n in zip(measures, names)])
        if batch_id > 0:
            keys = batch.select(*key).distinct()
            before = table.before(spark, batch_id, latest.schema, keys).persist()
            held, other = renamed(
                before, key, *[F.col(n).alias(f"_held{n}") for n in names]
            )
            found = _merged(found, held, key, other, measures, [m.name for m in measures])
            latest = _merged(latest, held, key, other, measures, names)
        finish(found).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        table.write(latest, batch_id, rows)
        if batch_id > 0:
            before.unpersist()

    return batch_writer(write)


def _merged(
    df: DataFrame, held: DataFrame, key: Sequence[str], other: Sequence[str],
    measures: Sequence[scan.Measure], columns: Sequence[str],
) -> DataFrame:
    """The measures in `columns` with what their keys had come to before."""
    kept = [c for c in df.columns if c not in columns]
    return df.join(held, same_key(key, other), "left").select(
        *kept,
        *[m.merge(F.col(f"_held_{m.name}"), F.col(c)).alias(c) for m, c in zip(measures, columns)],
    )


def framed_batches(
    key: Sequence[str], order: Sequence[str], preceding: int,
    values: dict[str, Callable[[WindowSpec], Column]], position: str, path: str, state: str,
    max_rows: int = scan.MAX_ROWS,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Callable[[DataFrame, int], None]:
    """A writer for `foreachBatch`: window values over the row and `preceding` rows before it, and
    the row's place within its key, as `scan.framed` gives them for the whole input.

    Kept between batches are the last `preceding` rows of each key, one at least, with their places.
    """
    placed = f"_{position}"
    table = KeyedState(state, key)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table.prune(spark, batch_id)
        rest = [c for c in batch.columns if c not in key]
        row = StructType([f for f in batch.schema.fields if f.name in rest]).add(placed, LongType())
        schema = StructType([f for f in batch.schema.fields if f.name in key]).add("_rows", ArrayType(row))
        held = table.before(spark, batch_id, schema, batch.select(*key).distinct())
        before = stored(held.select(*key, F.inline("_rows")), "before")
        both = before.unionByName(batch, allowMissingColumns=True)
        framed = scan.framed(both, key, order, preceding, values, "_local", max_rows)
        # the kept rows of a key come first, so the place of its first row shifts all others
        shift, other = renamed(
            before.groupBy(*key).agg((F.min(placed) - 1).alias("_shift")), key, "_shift"
        )
        place = F.col("_local") + F.coalesce("_shift", F.lit(0))
        found = stored(
            framed.join(shift, same_key(key, other), "left").select(
                *batch.columns, F.col(placed).alias("_old"), place.alias(position), *values
            ),
            "framed",
        )
        finish(found.filter(F.col("_old").isNull()).drop("_old")).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}"
        )
        ends, other = renamed(found.groupBy(*key).agg(F.max(position).alias("_end")), key, "_end")
        kept = found.join(ends, same_key(key, other)).filter(
            F.col(position) > F.col("_end") - max(preceding, 1)
        )
        last = F.collect_list(F.struct(*rest, F.col(position).alias(placed)))
        table.write(kept.groupBy(*key).agg(last.alias("_rows")), batch_id, found.count())

    return batch_writer(write)
