"""Streams that act on time: windows with allowed lateness, sessions, lasting rises, deduplication with
expiry, and rules that arrive while the stream runs.

Each function gives a writer for `foreachBatch`. A micro-batch is worked on like a table, by the
operators for tables, and what later batches need is kept as a table between them (`KeyedState`). The
watermark moves once per batch: all rows of a batch are judged by the one before it, and what the one
after it passes is given out. No key's rows are held in memory, so a key may be hot.

Rows without a key, a time or a value that the operator needs take no part; with a time they move the
watermark. A batch that is run again writes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from tideline.functions.time import slot_start
from tideline.operators import scan
from tideline.operators.chain import greedy_chain
from tideline.operators.detect import SMALLEST_POSITIVE
from tideline.operators.lateness import MILLISECOND
from tideline.session import stored
from tideline.sinks.tables import batch_writer
from tideline.streaming.batches import running_batches
from tideline.streaming.state import KeyedState, Watermarks, renamed, same_key

Writer = Callable[[DataFrame, int], None]


def _passed(mark: int | None, at: Column) -> Column:
    """Whether a watermark is at or behind a time."""
    return F.lit(False) if mark is None else F.lit(mark).cast("bigint") >= at


def window_batches(
    key: Sequence[str], at: str, size: int, bound: int, lateness: int,
    measures: Sequence[scan.Measure], path: str, state: str,
) -> Writer:
    """Tumbling windows with allowed lateness, for measures that can be folded.

    `path/firings/batch=<id>` gets (*key, start_us, end_us, firing, *measures, watermark_us): `firing`
    is "first" when the watermark passes the end of a window, and "update" for a window that had late
    rows in the batch, with the result of all its rows so far. `path/late/batch=<id>` gets the rows
    that come `lateness` microseconds or more after the end of their window and change nothing.

    Kept are partial results of the windows that can still change.
    """
    marks = Watermarks(f"{state}/watermark", bound)
    windows = [*key, "end_us"]
    table = KeyedState(f"{state}/windows", windows)
    names = [m.name for m in measures]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        low, high = marks.advance(batch, F.col(at), batch_id)
        table.prune(spark, batch_id)
        end = F.col("end_us")
        timed = batch.filter(F.col(at).isNotNull()).withColumn("end_us", slot_start(F.col(at), size) + size)
        too_late = _passed(low, end + lateness)
        timed.filter(too_late).drop("end_us").write.mode("overwrite").parquet(
            f"{path}/late/batch={batch_id}"
        )
        fresh = timed.filter(~too_late).groupBy(*windows).agg(
            *[m.summary.alias(m.name) for m in measures]
        )
        schema = StructType([*fresh.schema.fields]).add("fired", BooleanType())
        # all open windows: those without rows in the batch may close
        held, other = renamed(
            table.before(spark, batch_id, schema), windows,
            *[F.col(n).alias(f"_held_{n}") for n in names], F.col("fired").alias("_fired"),
        )
        fresh = fresh.withColumn("_new", F.lit(True))
        both = fresh.join(held, same_key(windows, other), "full").select(
            *[F.coalesce(w, o).alias(w) for w, o in zip(windows, other, strict=True)],
            *[
                F.when(F.col("_new"), m.merge(F.col(f"_held_{m.name}"), F.col(m.name)))
                .otherwise(F.col(f"_held_{m.name}")).alias(m.name)
                for m in measures
            ],
            F.coalesce("_new", F.lit(False)).alias("_new"),
            F.col("_fired").isNotNull().alias("_kept"),
            F.coalesce("_fired", F.lit(False)).alias("_fired"),
        )
        late, closed = _passed(low, end), _passed(high, end)
        first = closed & ~late & ~F.col("_fired")
        update = F.col("_new") & late
        firing = F.when(update, "update").when(first, "first")
        judged = stored(
            both.withColumns({"firing": firing, "_over": _passed(high, end + lateness)}), "windows"
        )
        mark = F.when(update, F.lit(low)).otherwise(F.lit(high)).cast("bigint")
        judged.filter(F.col("firing").isNotNull()).select(
            *key, (end - size).alias("start_us"), "end_us", "firing", *names,
            (mark - MILLISECOND).alias("watermark_us"),
        ).write.mode("overwrite").parquet(f"{path}/firings/batch={batch_id}")
        changed = F.col("_new") | F.col("firing").isNotNull() | F.col("_over")
        changes = judged.filter(changed & (F.col("_kept") | ~F.col("_over"))).select(
            *windows, *names, (F.col("_fired") | closed).alias("fired"),
            F.col("_over").alias("_gone"),
        )
        table.write(changes, batch_id, judged.count())

    return batch_writer(write)


def session_batches(
    key: Sequence[str], at: str, gap: int, bound: int, path: str, state: str,
    max_rows: int = scan.MAX_ROWS, **aggregates: tuple[Column, str],
) -> Writer:
    """Session windows: (*key, first, last, n, *aggregates) of a session once the watermark is more
    than `gap` behind its last row, as `windows.sessions` gives them for a table.

    Open sessions are kept, and merged when a row joins two. A row that is too late to reach a session
    that is still open is left out. An aggregate is given as (column, how), `how` being the name of the
    function that adds results up.
    """
    marks = Watermarks(f"{state}/watermark", bound)
    table = KeyedState(f"{state}/sessions", [*key, "first"])
    wanted = {"n": (F.count(F.lit(1)), "sum"), **aggregates}
    columns = [*key, "first", "last", *wanted]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        low, high = marks.advance(batch, F.col(at), batch_id)
        table.prune(spark, batch_id)
        known = batch.dropna(subset=[*key, at])
        # rows of one slot are never further apart than the gap
        pieces = known.groupBy(*key, slot_start(F.col(at), gap).alias("_slot")).agg(
            F.min(at).alias("first"), F.max(at).alias("last"),
            *[column.alias(name) for name, (column, _) in wanted.items()],
        ).drop("_slot")
        held = table.before(spark, batch_id, pieces.schema)
        both = stored(
            pieces.withColumn("_held", F.lit(False)).unionByName(held.withColumn("_held", F.lit(True))),
            "sessions",
        )
        order = ["first", "_held", "last"]
        cut = scan.cut(both, key, order, max_rows).extend(
            [scan.running_max("_until", F.col("last"), inclusive=False)]
        )
        apart = F.col("_until").isNull() | (F.col("first") - F.col("_until") > gap)
        cut = cut.with_columns({"_start": F.when(apart, F.col("first"))})
        runs = cut.extend([scan.running_max("_run", F.col("_start"))]).rows
        merged = runs.groupBy(*key, F.col("_run").alias("first")).agg(
            F.max("last").alias("last"),
            *[getattr(F, how)(name).alias(name) for name, (_, how) in wanted.items()],
            F.bool_or(~F.col("_held")).alias("_new"),
        )
        end = F.col("last") + gap
        # only late rows alone end up in a session that is over before the batch
        alive = F.lit(True) if low is None else end >= F.lit(low).cast("bigint")
        closes = F.lit(False) if high is None else end < F.lit(high).cast("bigint")
        judged = merged.filter(alive).withColumn("_closes", closes).persist()
        try:
            judged.filter("_closes").select(*columns).write.mode("overwrite").parquet(
                f"{path}/batch={batch_id}"
            )
            # sessions that go on under their old name are written, the other old ones go
            changed = judged.filter(F.col("_new") & ~F.col("_closes")).select(*columns)
            staying, names = renamed(judged.filter(~F.col("_closes")), table.key)
            old = both.filter("_held").select(*columns).join(
                staying, same_key(table.key, names), "left_anti"
            )
            changes = changed.withColumn("_gone", F.lit(False)).unionByName(
                old.withColumn("_gone", F.lit(True))
            )
            table.write(changes, batch_id, both.count())
        finally:
            judged.unpersist()

    return batch_writer(write)


def dedup_batches(
    key: Sequence[str], at: str, ttl: int, order: Sequence[str], path: str, state: str,
    max_rows: int = scan.MAX_ROWS, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Writer:
    """The rows that come `ttl` or more after the last row given out for their key, and the first of
    each key, as `dedup.dedup_ttl` gives them for a table. Kept is the time of a key's last output.

    What the last output still covers goes first; the rest of a batch is a chain of its own.
    """
    table = KeyedState(state, key)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table.prune(spark, batch_id)
        known = batch.dropna(subset=[*key, at])
        schema = StructType([*known.select(*key).schema.fields]).add("emitted", LongType())
        held = table.before(spark, batch_id, schema, known.select(*key).distinct())
        last, names = renamed(held, key, "emitted")
        open_rows = known.join(last, same_key(key, names), "left").filter(
            F.col("emitted").isNull() | (F.col(at) >= F.col("emitted") + ttl)
        )
        chain = greedy_chain(open_rows.select(*known.columns), key, at, ttl, order=order, max_rows=max_rows)
        chosen = stored(chain, "chosen")
        finish(chosen).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        latest = chosen.groupBy(*key).agg(F.max(at).alias("emitted"))
        table.write(latest, batch_id, chosen.count())

    return batch_writer(write)


def rise_batches(
    key: Sequence[str], at: str, arrival: str, value: str, interval: int, bound: int, path: str,
    state: str, max_rows: int = scan.MAX_ROWS,
) -> Writer:
    """(*key, armed_at, alert_at) of alerts for keys whose value did not fall for `interval`, as
    `detect.lasting_rises` gives them for a table, once a row or the watermark has passed them.

    Two tables are kept: the last value of each key, of which a batch reads and writes those of its
    keys, and the alerts that are armed, which are the timers. Rows before the watermark are too late.
    """
    marks = Watermarks(f"{state}/watermark", bound)
    values, timers = KeyedState(f"{state}/last", key), KeyedState(f"{state}/armed", key)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        low, high = marks.advance(batch, F.col(at), batch_id)
        values.prune(spark, batch_id)
        timers.prune(spark, batch_id)
        known = batch.select(*key, at, arrival, value).dropna(subset=[*key, at, value])
        if low is not None:
            known = known.filter(F.col(at) >= low)
        newest = F.max_by(value, F.struct(at, arrival)).alias(value)
        latest = known.groupBy(*key).agg(newest).persist()
        try:
            keys, names = renamed(latest, key)
            # the last value of a key stands before its rows of this batch
            heads = values.before(spark, batch_id, latest.schema, latest.select(*key))
            first = F.lit(-(1 << 63)).cast("bigint")
            heads = heads.withColumns({at: first, "_head": F.lit(True)})
            rows = known.withColumn("_head", F.lit(False)).unionByName(heads, allowMissingColumns=True)
            schema = StructType([*latest.select(*key).schema.fields]).add("armed_at", LongType())
            armed = stored(timers.before(spark, batch_id, schema), "armed")
            busy = armed.join(keys, same_key(key, names), "left_semi")

            seen = scan.cut(rows, key, [at, arrival], max_rows).extend(
                [scan.previous("_last", F.col(value), [at, arrival])]
            )
            last = F.coalesce(F.col("_last.value"), F.lit(SMALLEST_POSITIVE))
            marked = seen.with_columns({
                "_rise": ~F.col("_head") & (F.col(value) > last),
                "_fall": (F.col("_last").isNotNull() & (F.col(value) < last)).cast("bigint"),
            })
            runs = stored(
                marked.extend([scan.running_sum("_run", F.col("_fall"))])
                .rows.filter(F.col("_rise") | (F.col("_fall") == 1))
                .select(*key, "_run", at, "_rise", "_fall"),
                "runs",
            )
            # an alert that is armed already is the first rise of the run that goes on
            rises = runs.filter("_rise").select(*key, "_run", at).unionByName(
                busy.select(*key, F.lit(0).cast("bigint").alias("_run"), F.col("armed_at").alias(at))
            )
            chain = greedy_chain(rises, [*key, "_run"], at, interval, strict=True, max_rows=max_rows)
            ends = runs.filter("_fall = 1").select(
                *key, (F.col("_run") - 1).alias("_run"), F.col(at).alias("_ended")
            )
            chain = stored(chain.join(ends, [*key, "_run"], "left"), "chain")
            still = chain.filter(F.col("_ended").isNull())
            tops, top_names = renamed(still.groupBy(*key).agg(F.max(at).alias("_top")), key, "_top")
            alert_at = F.col(at) + interval
            passed = F.lit(None).cast("bigint") if high is None else F.lit(high).cast("bigint")
            judged = chain.join(tops, same_key(key, top_names), "left").select(
                *key, F.col(at).alias("armed_at"), alert_at.alias("alert_at"),
                F.when(F.col("_ended").isNotNull(), F.col("_ended") > alert_at)
                .otherwise(F.coalesce(F.greatest("_top", passed) > alert_at, F.lit(False)))
                .alias("_fires"),
                F.col("_ended").isNull().alias("_open"),
            )
            judged = stored(judged, "judged")
            idle = armed.join(keys, same_key(key, names), "left_anti").withColumn(
                "alert_at", F.col("armed_at") + interval
            ).filter(F.coalesce(passed > F.col("alert_at"), F.lit(False)))
            fired = judged.filter("_fires").select(*key, "armed_at", "alert_at")
            fired.unionByName(idle).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

            staying = judged.filter("_open and not _fires").select(
                *key, "armed_at", F.lit(False).alias("_gone")
            )
            kept, kept_names = renamed(staying, key)
            ended = busy.join(kept, same_key(key, kept_names), "left_anti")
            gone = ended.unionByName(idle.select(*key, "armed_at")).withColumn("_gone", F.lit(True))
            most = latest.count()
            timers.write(staying.unionByName(gone), batch_id, most + armed.count())
            values.write(latest, batch_id, most)
        finally:
            latest.unpersist()

    return batch_writer(write)


class RuleLog:
    """Rules that arrive on a stream, each from its first arrival on."""

    def __init__(self, path: str, columns: Sequence[str], arrival: str):
        self.columns, self.arrival = list(columns), arrival
        self.table = KeyedState(path, columns)

    def extend(self, rules: DataFrame, batch_id: int) -> DataFrame:
        """Take in the rules of a batch; gives (*columns, arrival) of all rules up to this batch."""
        spark = rules.sparkSession
        self.table.prune(spark, batch_id)
        new = rules.dropna(subset=self.columns).groupBy(*self.columns).agg(
            F.min(self.arrival).alias(self.arrival)
        )
        before = stored(self.table.before(spark, batch_id, new.schema), "rules")
        known, names = renamed(before, self.columns)
        added = stored(new.join(known, same_key(self.columns, names), "left_anti"), "rules")
        self.table.write(added, batch_id, added.count())
        return before.unionByName(added)


def pattern_batches(
    user: str, action: str, arrival: str, path: str, state: str, max_rows: int = scan.MAX_ROWS,
) -> Writer:
    """(user, arrival, action1, action2) of actions that complete a rule with the user's action before,
    as `detect.patterns` gives them for tables.

    The stream is two inputs as `basic.connect` joins them: rules (1: action1, action2) and actions (2).
    Rules go to a log, and an action meets those that have arrived before it, in its batch or earlier.
    """
    log = RuleLog(f"{state}/rules", ["action1", "action2"], arrival)

    def write(batch: DataFrame, batch_id: int) -> None:
        rules = batch.filter(F.col("input") == 1).select("action1", "action2", arrival)
        known = log.extend(rules, batch_id).withColumnRenamed(arrival, "_known_from")
        matched = lambda found: found.join(
            known,
            (F.col("_last.value") == F.col("action1")) & (F.col(action) == F.col("action2"))
            & (F.col("_known_from") < F.col(arrival)),
        ).select(user, arrival, "action1", "action2")
        last = [scan.previous("_last", F.col(action), [arrival])]
        actions = batch.filter(F.col("input") == 2).select(user, action, arrival)
        running = running_batches(
            [user], [arrival], last, path, f"{state}/last", max_rows, finish=matched
        )
        running(actions.dropna(subset=[user, action]), batch_id)

    return batch_writer(write)
