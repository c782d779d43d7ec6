"""Running values per key in arrival order, spread over many tasks when a key is hot.

A plain window puts all rows of a key into one task. If the largest key has more than `max_rows`
rows, the whole input is put in order once instead: range-partitioned by key and order into parts
whose number follows the number of rows, and stored with the part's number as segment. Each segment
of a key is summed up, the summaries of the few keys that reach over the end of a part are folded in
order, and what came before a segment joins it as one header row, which a single window picks up.
Order columns may be of any type that sorts, nulls and NaN included. The result is the same either
way, and the only thing that decides between them is one number, the size of the largest key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tideline.functions.time import slot_start
from tideline.session import stored

MAX_ROWS = 2_000_000

SEGMENT = "_segment"
_IS_ROW = "_is_row"


@dataclass(frozen=True)
class Measure:
    """A running value: inside a segment, summed up per segment, and across segments."""

    name: str
    within: Callable[[WindowSpec], Column]
    summary: Column
    fold: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]


def _frame(w: WindowSpec, inclusive: bool) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)


def running_sum(name: str, value: Column, inclusive: bool = True) -> Measure:
    return Measure(
        name,
        lambda w: F.sum(value).over(_frame(w, inclusive)),
        F.sum(value),
        F.sum,
        lambda before, here: F.coalesce(before + here, before, here),
    )


def running_count(name: str, value: Column | None = None, inclusive: bool = True) -> Measure:
    counted = F.lit(1) if value is None else value
    return Measure(
        name,
        lambda w: F.count(counted).over(_frame(w, inclusive)),
        F.count(counted),
        F.sum,
        lambda before, here: F.coalesce(before, F.lit(0)) + here,
    )


def running_max(name: str, value: Column, inclusive: bool = True) -> Measure:
    """Highest value so far; `value` may be a struct, compared field by field."""
    return Measure(
        name, lambda w: F.max(value).over(_frame(w, inclusive)), F.max(value), F.max, F.greatest
    )


def running_min(name: str, value: Column, inclusive: bool = True) -> Measure:
    return Measure(
        name, lambda w: F.min(value).over(_frame(w, inclusive)), F.min(value), F.min, F.least
    )


def previous(name: str, value: Column, order: Sequence[str]) -> Measure:
    """`struct(value)` of the row before in `order`, null on the first row of a key."""
    boxed = F.struct(value.alias("value"))
    return Measure(
        name,
        lambda w: F.lag(boxed).over(w),
        F.max_by(boxed, F.struct(*order)),
        lambda part: F.last(part, ignorenulls=True),
        lambda before, here: F.coalesce(here, before),
    )


@dataclass(frozen=True)
class Cut:
    """Rows ready for running values by `key` in `order`, with segments if a key is hot."""

    df: DataFrame
    key: Sequence[str]
    order: Sequence[str]
    split: bool
    derived: bool = False

    @property
    def rows(self) -> DataFrame:
        return self.df.drop(SEGMENT)

    def with_columns(self, columns: dict[str, Column]) -> Cut:
        return replace(self, df=self.df.withColumns(columns))

    def extend(self, measures: Sequence[Measure]) -> Cut:
        """One more column per measure. Extensions of the same cut share one shuffle and sort."""
        if not self.split:
            w = Window.partitionBy(*self.key).orderBy(*self.order)
            added = [m.within(w).alias(m.name) for m in measures]
            return replace(self, df=self.df.select("*", *added), derived=True)
        # the summaries read the rows once more, so windows below them are not computed twice
        df = stored(self.df, "segments") if self.derived else self.df
        return replace(self, df=_over_segments(df, self.key, self.order, measures), derived=True)


def cut(
    df: DataFrame, key: Sequence[str], order: Sequence[str], max_rows: int = MAX_ROWS,
    rows: int | None = None,
) -> Cut:
    """Look for hot keys once; `order` must be unique within a key. `rows` is the number of rows, if
    it is known: no key has more."""
    few = rows is not None and rows <= max_rows
    segmented = None if few else segment(df, key, order, max_rows)
    return Cut(df if segmented is None else segmented, key, order, segmented is not None)


def running(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    measures: Sequence[Measure],
    max_rows: int = MAX_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """`df` with one column per measure. `order` must be unique within a key."""
    return cut(df, key, order, max_rows, rows).extend(measures).rows


def _over_segments(
    segmented: DataFrame, key: Sequence[str], order: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    summed = [m.summary.alias(f"_{m.name}") for m in measures]
    parts = stored(segmented.groupBy(*key, SEGMENT).agg(*summed), "summaries")
    # keys in more than one segment: at most one for each end of a part
    ends = parts.groupBy(*key).agg(
        F.min(SEGMENT).alias("_first"), F.max(SEGMENT).alias("_last")
    )
    spread = ends.filter(F.col("_first") < F.col("_last")).select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)], "_first"
    )
    same = F.col(SEGMENT) >= F.col("_first")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    several = parts.join(spread, same) if key else parts
    earlier = (
        Window.partitionBy(*key).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    )
    headers = several.select(
        *key, SEGMENT, F.lit(False).alias(_IS_ROW),
        *[m.fold(F.col(f"_{m.name}")).over(earlier).alias(f"_{m.name}") for m in measures],
    )
    both = segmented.withColumn(_IS_ROW, F.lit(True)).unionByName(
        headers, allowMissingColumns=True
    )
    # the header sorts first; rows are looked at apart from it, in the same exchange and sort
    so_far = Window.partitionBy(*key, SEGMENT).orderBy(_IS_ROW, *order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    carried = both.select(
        "*", *[F.first(f"_{m.name}").over(so_far).alias(f"_before_{m.name}") for m in measures]
    )
    w = Window.partitionBy(*key, SEGMENT, _IS_ROW).orderBy(*order)
    return carried.select(
        *segmented.columns, _IS_ROW,
        *[m.merge(F.col(f"_before_{m.name}"), m.within(w)).alias(m.name) for m in measures],
    ).filter(_IS_ROW).drop(_IS_ROW)


def framed(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    preceding: int,
    values: dict[str, Callable[[WindowSpec], Column]],
    position: str | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Window values over the current row and `preceding` rows before it, per key.

    `position` names a column for the 1-based place of the row within its key.
    """
    copies = _copied(df, key, order, preceding, position or "_place", max_rows)
    if copies is None:
        w = Window.partitionBy(*key).orderBy(*order)
        frame = w.rowsBetween(-preceding, 0)
        added = [make(frame).alias(name) for name, make in values.items()]
        if position:
            added.append(F.row_number().over(w).cast("bigint").alias(position))
        return df.select("*", *added)
    frame = Window.partitionBy(*key, "block").orderBy(*order).rowsBetween(-preceding, 0)
    kept = [*df.columns, *([position] if position else [])]
    return (
        copies.select("*", *[make(frame).alias(name) for name, make in values.items()])
        .filter(F.col("home") == F.col("block"))
        .select(*kept, *values)
    )


def in_blocks(
    df: DataFrame, key: Sequence[str], order: Sequence[str], preceding: int,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """`df` prepared for a row frame written in SQL: partition by key and `block`, and keep the
    rows where `home = block`. Each row's `preceding` rows are in its home block."""
    copies = _copied(df, key, order, preceding, "_place", max_rows)
    if copies is None:
        zero = F.lit(0).cast("bigint")
        return df.withColumns({"home": zero, "block": zero})
    return copies.drop("_place")


def _copied(
    df: DataFrame, key: Sequence[str], order: Sequence[str], preceding: int, place: str,
    max_rows: int,
) -> DataFrame | None:
    """None if no key is hot. Else the rows of each key in blocks of `max_rows` places; the last
    `preceding` rows of a block are also given to the block after it."""
    segmented = segment(df, key, order, max_rows)
    if segmented is None:
        return None
    placed = _over_segments(segmented, key, order, [running_count(place)]).drop(SEGMENT)
    start = lambda at: slot_start(at - 1, max_rows)
    last = start(F.col(place) + F.lit(preceding))
    return placed.withColumn("home", start(F.col(place))).withColumn(
        "block", F.explode(F.sequence(F.col("home"), last, F.lit(max_rows).cast("bigint")))
    )


def segment(
    df: DataFrame, key: Sequence[str], order: Sequence[str], max_rows: int = MAX_ROWS
) -> DataFrame | None:
    """`df` in parts that follow key and order, with the part's number; None if no key is hot."""
    largest, rows = df.groupBy(*key).count().agg(F.max("count"), F.sum("count")).first()
    if largest is None or largest <= max_rows:
        return None
    parts = -(-2 * rows // max_rows)
    # stored, since a part's number holds for this one way of dealing out the rows
    dealt = df.repartitionByRange(parts, *key, *order)
    return stored(dealt.withColumn(SEGMENT, F.spark_partition_id().cast("bigint")), "segments")


def first_at_or_after(
    probes: DataFrame,
    targets: DataFrame,
    group: Sequence[str],
    at: str,
    payload: str,
    name: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """`probes` with `name`: the payload of the group's target with the smallest `at` that is not
    below the probe's; null if there is none. `at` is a bigint, unique among a group's targets."""
    boxed = F.struct(F.col(payload).alias("value"))
    found = targets.select(*group, (-F.col(at)).alias("_back"), F.lit(0).alias("_kind"),
                           boxed.alias("_target"))
    asked = probes.withColumns({"_back": -F.col(at), "_kind": F.lit(1)})
    nearest = Measure(
        name,
        lambda w: F.last("_target", ignorenulls=True).over(_frame(w, True)),
        F.max_by("_target", F.when(F.col("_kind") == 0, F.col("_back"))),
        lambda part: F.last(part, ignorenulls=True),
        lambda before, here: F.coalesce(here, before),
    )
    both = asked.unionByName(found, allowMissingColumns=True)
    scanned = running(both, group, ["_back", "_kind"], [nearest], max_rows)
    return scanned.filter(F.col("_kind") == 1).select(
        *probes.columns, F.col(f"{name}.value").alias(name)
    )
