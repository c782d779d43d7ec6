"""Watermarks, allowed lateness and late side outputs, replayed over static tables.

The watermark before a row is the highest event time that arrived earlier, less the bound. It is a
running maximum over all rows, computed in segments of the arrival order. With it every row's fate
is fixed: on time, late but accepted (the window fires again), or too late (side output).

Beside the watermark that moves with every row there are one that moves at the ticks of a clock and one
over several sources, some of which may be idle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import epoch_us, from_epoch_us, slot_start
from tideline.operators import scan
from tideline.session import stored

MILLISECOND = 1_000

ON_TIME, LATE, TOO_LATE = "on time", "late", "too late"
NO_PART = "no part"


def watermarks(
    df: DataFrame, order: Sequence[str], ts: str, bound: int, max_rows: int = scan.MAX_ROWS
) -> DataFrame:
    """`df` with `before_us` and `after_us`: the highest event time before and after each row's
    arrival, less `bound` microseconds. The watermark a job reports is one millisecond lower."""
    us = epoch_us(F.col(ts))
    seen = scan.running(
        df, [], order, [scan.running_max("before_us", us, inclusive=False)], max_rows
    )
    return seen.withColumns(
        {
            "after_us": F.greatest("before_us", us) - bound,
            "before_us": F.col("before_us") - bound,
        }
    )


def periodic_watermarks(
    df: DataFrame, arrived: str, ts: str, period: int, bound: int, max_rows: int = scan.MAX_ROWS
) -> DataFrame:
    """As `watermarks`, for a watermark that moves every `period` microseconds of the arrival clock.

    Between two ticks it stays: a row sees what had arrived before the last tick (`before_us`), and
    counts from the next one on (`after_us`). Only one row per tick is put in order. Rows without an
    arrival see no watermark and do not move it.
    """
    tick = slot_start(epoch_us(F.col(arrived)), period)
    high = F.max(epoch_us(F.col(ts)))
    ticks = df.filter(F.col(arrived).isNotNull()).groupBy(tick.alias("_tick")).agg(high.alias("_high"))
    moved = scan.running(
        ticks, [], ["_tick"],
        [
            scan.running_max("before_us", F.col("_high"), inclusive=False),
            scan.running_max("after_us", F.col("_high")),
        ],
        max_rows,
    ).select(
        F.col("_tick").alias("_at"), (F.col("before_us") - bound).alias("before_us"),
        (F.col("after_us") - bound).alias("after_us"),
    )
    seen = df.withColumn("_tick", tick).join(moved, F.col("_tick") == F.col("_at"), "left")
    return seen.drop("_tick", "_at")


def merged_watermarks(
    df: DataFrame, order: Sequence[str], arrived: str, ts: str, source: str,
    sources: Sequence, bound: int, idle_after: int, max_rows: int = scan.MAX_ROWS,
) -> DataFrame:
    """As `watermarks`, for rows of several `sources` that arrive in one order.

    Each source has its highest event time; the watermark is the least of them and never goes back. A
    source that nothing has arrived from for more than `idle_after` microseconds is idle and holds
    nothing up; before that, a source without any row holds up everything. Rows of other sources and
    rows without an arrival do not move the watermark. One scan has all sources' maxima.
    """
    us, now = epoch_us(F.col(ts)), epoch_us(F.col(arrived))
    measures = [scan.running_min("_start", now)]
    for i, name in enumerate(sources):
        here = F.col(source) == F.lit(name)
        measures.append(scan.running_max(f"_high{i}", F.when(here & now.isNotNull(), us)))
        measures.append(scan.running_max(f"_seen{i}", F.when(here, now)))
    seen = scan.cut(df, [], order, max_rows).extend(measures)
    waiting, highs = F.lit(False), []
    for i in range(len(sources)):
        last = F.coalesce(F.col(f"_seen{i}"), F.col("_start"))
        active = now - last <= idle_after
        waiting = waiting | (active & F.col(f"_high{i}").isNull())
        highs.append(F.when(active, F.col(f"_high{i}")))
    least = highs[0] if len(highs) == 1 else F.least(*highs)
    counted = F.col(source).isin(list(sources)) & now.isNotNull()
    held = seen.with_columns({"_least": F.when(counted & ~waiting, least)})
    moved = held.extend(
        [
            scan.running_max("before_us", F.col("_least"), inclusive=False),
            scan.running_max("after_us", F.col("_least")),
        ]
    ).rows
    return moved.select(
        *df.columns, (F.col("before_us") - bound).alias("before_us"),
        (F.col("after_us") - bound).alias("after_us"),
    )


def as_watermark(us: str):
    """The reported watermark as a timestamp."""
    return from_epoch_us(F.col(us) - MILLISECOND)


def replay(
    df: DataFrame, order: Sequence[str], ts: str, size: int, bound: int, lateness: int = 0,
    max_rows: int = scan.MAX_ROWS,
) -> DataFrame:
    """`df` with its watermarks, its tumbling window (`start_us`, `end_us`) and its `fate`.

    `stored` the result before reading it more than once, as the functions below do.
    """
    return judged(watermarks(df, order, ts, bound, max_rows), ts, size, lateness)


def judged(seen: DataFrame, ts: str, size: int, lateness: int = 0) -> DataFrame:
    """Rows with their watermarks of any kind, their tumbling window and their `fate`."""
    start = slot_start(epoch_us(F.col(ts)), size)
    fate = (
        F.when(F.col("before_us") >= F.col("end_us") + lateness, TOO_LATE)
        .when(F.col("before_us") >= F.col("end_us"), LATE)
        .otherwise(ON_TIME)
    )
    return seen.withColumns({"start_us": start, "end_us": start + size}).withColumn("fate", fate)


def late_rows(replayed: DataFrame) -> DataFrame:
    """The side output: rows that came too late to change any result."""
    return replayed.filter(F.col("fate") == TOO_LATE)


def closing_watermarks(
    replayed: DataFrame, size: int, max_rows: int = scan.MAX_ROWS
) -> DataFrame:
    """(end_us, closed_at): the watermark at which each window fired, null if the input ended
    first. Only one row per time slot of the window size is put in order."""
    steps = replayed.groupBy(slot_start(F.col("after_us"), size).alias("end_us")).agg(
        F.min("after_us").alias("after_us")
    )
    ends = replayed.select("end_us").distinct()
    return scan.first_at_or_after(ends, steps, [], "end_us", "after_us", "closed_at", max_rows)


def firings(
    replayed: DataFrame, key: Sequence[str], order: Sequence[str], size: int,
    measures: Sequence[scan.Measure], max_rows: int = scan.MAX_ROWS,
) -> DataFrame:
    """Every result of a keyed window for any measures that can be folded.

    One firing over the rows on time, then one updated result per accepted late row. Gives
    (*key, start_us, end_us, firing, *fired_by, *measures, watermark_us): `firing` is "first" or
    "update" and `fired_by_*` the arrival of the late row. `late_rows` gives the side output.
    """
    window = [*key, "start_us", "end_us"]
    names = [m.name for m in measures]
    first = stored(
        replayed.filter(F.col("fate") == ON_TIME)
        .groupBy(*window).agg(*[m.summary.alias(m.name) for m in measures]),
        "firings",
    )
    late = replayed.filter(F.col("fate") == LATE)
    inside = scan.running(late, window, order, measures, max_rows)
    before = first.select(
        *[F.col(c).alias(f"_window{i}") for i, c in enumerate(window)],
        *[F.col(n).alias(f"_first_{n}") for n in names],
    )
    same = F.lit(True)
    for i, c in enumerate(window):
        same = same & F.col(c).eqNullSafe(F.col(f"_window{i}"))
    updates = inside.join(before, same, "left").select(
        *window, F.lit("update").alias("firing"),
        *[F.col(o).alias(f"fired_by_{o}") for o in order],
        *[m.merge(F.col(f"_first_{m.name}"), F.col(m.name)).alias(m.name) for m in measures],
        (F.col("before_us") - MILLISECOND).alias("watermark_us"),
    )
    closed = closing_watermarks(replayed, size, max_rows)
    firsts = first.join(closed, "end_us").select(
        *window, F.lit("first").alias("firing"), *names,
        (F.col("closed_at") - MILLISECOND).alias("watermark_us"),
    )
    return updates.unionByName(firsts, allowMissingColumns=True)


def lowest_firings(
    replayed: DataFrame, key: Sequence[str], order: Sequence[str], value: str, size: int,
    fields: Sequence[str], max_rows: int = scan.MAX_ROWS,
) -> DataFrame:
    """The firings of a keyed window that keeps the record with the lowest value, the struct of
    `fields`, as `record`. Rows without a value move the watermark but take no part in a window."""
    ranked = F.struct(
        F.col(value).alias("_value"),
        *[F.col(o).alias(f"_order{i}") for i, o in enumerate(order)],
        F.struct(*fields).alias("_record"),
    )
    fate = F.when(F.col(value).isNull() & (F.col("fate") != TOO_LATE), NO_PART)
    known = replayed.withColumn("fate", fate.otherwise(F.col("fate")))
    lowest = [scan.running_min("_lowest", ranked)]
    fired = firings(known, key, order, size, lowest, max_rows)
    return fired.withColumn("record", F.col("_lowest._record")).drop("_lowest")
