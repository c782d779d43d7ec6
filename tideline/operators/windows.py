"""Time windows over event time: tumbling, session, and windows over windows.

All results come from partial and final aggregation. No window is ever buffered, so neither a busy
window nor a busy key ends up in one task. The functions also take a streaming DataFrame unless
they say otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import epoch_us, from_epoch_us
from tideline.operators import runs, scan
from tideline.session import stored


def tumbling(
    df: DataFrame, key: Sequence[str], ts: str, size: str, aggregates: Sequence[Column]
) -> DataFrame:
    """(*key, window, *aggregates); windows start at multiples of `size` from the epoch."""
    return df.groupBy(F.window(ts, size).alias("window"), *key).agg(*aggregates)


def window_total(
    df: DataFrame, key: Sequence[str], ts: str, size: str, value: str, name: str = "total"
) -> DataFrame:
    """Sum per key and window, in the type of the value for floats: (*key, total, window)."""
    total = F.sum(value)
    if dict(df.dtypes)[value] == "float":
        total = total.cast("float")
    return tumbling(df, key, ts, size, [total.alias(name)])


def window_winner(totals: DataFrame, key: str, size: str, name: str = "total") -> DataFrame:
    """Per window the key with the highest total: (key, total, window_end).

    Only one partial winner per task and window meets the others. The lowest key wins a tie. A null
    total takes no part; a window of null totals has no winner.
    """
    totals = totals.filter(F.col(name).isNotNull())
    if totals.isStreaming:
        again = F.window(F.window_time("window"), size)
    else:
        again = F.col("window")
    ranked = F.struct((-F.col(name)).alias("_rank"), F.col(key).alias("_key"))
    best = F.min(F.struct(ranked.alias("_by"), F.struct(key, name).alias("_record")))
    return (
        totals.groupBy(again.alias("window"))
        .agg(best.alias("_best"))
        .select("_best._record.*", F.col("window.end").alias("window_end"))
    )


def running_winner(
    totals: DataFrame, key: str, size: int, name: str = "total", max_rows: int = scan.MAX_ROWS
) -> DataFrame:
    """Per window the key with the highest sum over this and all earlier windows.

    Static input (*key, total, window), `size` in microseconds. A key's sum holds from its window to
    the key's next one. That span of windows is made up of at most two aligned pieces of each power
    of two; the best sum of each piece is found first, and a window takes the best of the pieces it
    lies in, one of each power. So rows grow by the logarithm of a span, not by its length. A null
    total adds nothing, and a key takes part from its first total that is not null.
    """
    flat = stored(
        totals.select(
            key, name, F.floor(epoch_us(F.col("window.end")) / size).cast("bigint").alias("_at"),
            F.pmod(epoch_us(F.col("window.end")), F.lit(size)).alias("_off"),
        ),
        "totals",
    )
    known = flat.filter(F.col(name).isNotNull())
    last = flat.agg(F.max("_at")).first()[0]
    rows = scan.cut(known.withColumn("_back", -F.col("_at")), [key], ["_back"], max_rows)
    until = rows.extend([scan.previous("_next", F.col("_at"), ["_back"])]).rows
    sums = scan.running(until, [key], ["_at"], [scan.running_sum("_sum", F.col(name))], max_rows)
    stop = F.coalesce(F.col("_next.value"), F.lit((last or 0) + 1))
    spans = sums.select(key, F.col("_sum").alias(name), F.col("_at").alias("_from"), stop.alias("_to"))
    pieces = stored(
        spans.select(key, name, F.explode(_aligned("_from", "_to")).alias("_piece")).select(
            key, name, "_piece.*"
        ),
        "pieces",
    )
    ranked = F.struct((-F.col(name)).alias("_rank"), F.col(key).alias("_key"))
    record = F.struct(ranked.alias("_by"), F.struct(key, name).alias("_record"))
    best = pieces.groupBy("_level", "_place").agg(F.min(record).alias("_best"))
    highest = pieces.agg(F.max("_level")).first()[0]
    windows = flat.select("_at", "_off").distinct()
    asked = windows.select(
        "_at", "_off", F.explode(F.sequence(F.lit(0), F.lit(highest or 0))).alias("_level")
    ).withColumn("_place", F.call_function("shiftright", "_at", "_level"))
    found = asked.join(best, ["_level", "_place"]).groupBy("_at", "_off").agg(
        F.min("_best").alias("_best")
    )
    end = F.col("_at") * size + F.col("_off")
    return found.select("_best._record.*", from_epoch_us(end).alias("window_end"))


def _aligned(start: str, stop: str) -> Column:
    """The aligned pieces (level, place) that make up [start, stop): piece (l, p) is all numbers
    that give p when shifted right by l."""

    def at_level(level: Column) -> Column:
        low = -F.call_function("shiftright", -F.col(start), level)
        high = F.call_function("shiftright", F.col(stop), level)
        left = F.struct(level.alias("_level"), low.alias("_place"))
        right = F.struct(level.alias("_level"), (high - 1).alias("_place"))
        return F.array(
            F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), left),
            F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), right),
        )

    top = F.ceil(F.log2((F.col(stop) - F.col(start) + 1).cast("double"))).cast("int")
    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), top), at_level)))


def sessions(
    df: DataFrame, key: Sequence[str], ts: str, gap: int, max_rows: int = scan.MAX_ROWS,
    **aggregates: tuple[Column, str],
) -> DataFrame:
    """Session windows: (*key, session_start, session_end, n, *aggregates), end = last row + gap.

    Rows at a distance of exactly `gap` microseconds share a session. An aggregate is given as
    (column, how): the aggregate of the rows of a slot, and the name of the function that adds
    slots up. Rows without a time are in no session. Static input; `timed.session_batches` is the form
    for streams.
    """
    wanted = {"n": (F.count(F.lit(1)), "sum"), **aggregates}
    timed = df.withColumn("_us", epoch_us(F.col(ts)))
    cut = runs.gap_slots(
        timed, key, "_us", gap, touching=True, max_rows=max_rows,
        **{name: column for name, (column, _) in wanted.items()},
    )
    return (
        cut.groupBy(*key, "run")
        .agg(
            F.max("last").alias("_last"),
            *[getattr(F, how)(name).alias(name) for name, (_, how) in wanted.items()],
        )
        .select(
            *key,
            from_epoch_us(F.col("run")).alias("session_start"),
            from_epoch_us(F.col("_last") + gap).alias("session_end"),
            *wanted,
        )
    )
