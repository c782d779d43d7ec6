"""Bounded streams over the events, with the results of their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.strings import split_line
from tideline.functions.time import DAY, HOUR, epoch_us, from_epoch_us
from tideline.operators import basic, changelog, scan, windows
from tideline.plans import row_queries, window_queries
from tideline.plans import state_queries as batch
from tideline.plans.inputs import ARRIVED, BOUND, CENTS, LATENESS, WINDOW, cents, disordered, events
from tideline.plans.registry import ORACLES, query
from tideline.session import shared_path, table
from tideline.streaming import timed
from tideline.streaming.batches import framed_batches, running_batches
from tideline.streaming.run import as_slices, as_stream, final_rows, run_bounded

#: later than any row
FAR = "9999-01-01"

ROLLING_MAX = """select user_id, event_id,
  max(value) over (partition by user_id order by event_id) as value from events"""


def event_stream(spark, folder, *columns: str, closing: bool = False):
    """The events as a stream; if `closing`, a row far in the future follows and ends windows."""
    rows = events(spark, folder).select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        cents().alias("cents"), epoch_us(F.col("ts")).alias("us"),
    )
    rows = rows.select("event_id", *columns)
    if not closing:
        return as_stream(rows, "event_id")
    null = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema}
    far = null | {"ts": F.lit(FAR).cast("timestamp")}
    last = spark.range(1).select(*[c.alias(n) for n, c in far.items()], F.lit(True).alias("closing"))
    return as_stream(rows.withColumn("closing", F.lit(False)), "event_id", last=last)


def watermarked(rows, bound: str, *known: str):
    """The watermark of all rows, and of them those that have a value in the columns `known` and
    aren't the closing one.

    The condition names `ts`, so that it is not moved below the watermark.
    """
    wanted = ~F.col("closing")
    for name in known:
        wanted &= F.col(name).isNotNull()
    return rows.withWatermark("ts", bound).filter(wanted | F.col("ts").isNull())


def scanned(rows, key, measures, finish=lambda found: found, order=("event_id",)):
    """Running values of a stream per micro-batch."""
    spark = rows.sparkSession
    path, state = shared_path(spark, "stream-out"), shared_path(spark, "stream-state")
    write = running_batches(key, list(order), measures, path, state, finish=finish)
    return run_bounded(rows, path=path, write=write).drop("batch")


def framed(rows, key, preceding, values, finish):
    """Row frames of a stream per micro-batch."""
    spark = rows.sparkSession
    path, state = shared_path(spark, "stream-out"), shared_path(spark, "stream-state")
    write = framed_batches(
        key, ["event_id"], preceding, values, "nth", path, state, finish=finish
    )
    return run_bounded(rows, path=path, write=write).drop("batch")


@query("stream_hourly_tips_max", ORACLES["hourly_tips_max"])
def stream_hourly_tips_max(spark, folder):
    fares = event_stream(spark, folder, "ts", "user_id", "cents", closing=True)
    fares = watermarked(fares, "1 hour")
    totals = windows.window_total(
        fares.withColumnRenamed("user_id", "driver"), ["driver"], "ts", "1 hour", "cents"
    )
    winners = run_bounded(windows.window_winner(totals, "driver", "1 hour"))
    return winners.select(
        "driver", "total", F.col("window_end").cast("timestamp_ntz").alias("window_end")
    )


@query("stream_word_count", row_queries.WORDS)
def stream_word_count(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    words = as_stream(docs, "doc_id").select(F.explode(split_line(F.col("text"))).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return final_rows(run_bounded(counted, mode="update"), ["word"])


@query("stream_state_key_count", ORACLES["state_key_count"])
def stream_state_key_count(spark, folder):
    rows = event_stream(spark, folder, "user_id")
    return scanned(rows, ["user_id"], [scan.running_count("n")])


@query("stream_rolling_sum", ORACLES["rolling_sum"])
def stream_rolling_sum(spark, folder):
    """Only two keys, both hot: each micro-batch is scanned in segments."""
    rows = event_stream(spark, folder, "cents").withColumn("parity", F.col("event_id") % 2)
    total = [scan.running_sum("total", F.col("cents"))]
    return scanned(rows, ["parity"], total, lambda found: found.drop("cents"))


@query("stream_rolling_reduce", ROLLING_MAX)
def stream_rolling_reduce(spark, folder):
    rows = event_stream(spark, folder, "user_id", "value")
    highest = [scan.running_max("highest", F.col("value"))]
    picked = lambda found: found.select("user_id", "event_id", F.col("highest").alias("value"))
    return scanned(rows, ["user_id"], highest, picked)


@query("stream_temp_jump", batch.TEMP_JUMP)
def stream_temp_jump(spark, folder):
    rows = event_stream(spark, folder, "user_id", "value")
    last = [scan.previous("last", F.col("value"), ["event_id"])]
    jumps = lambda found: found.filter(F.abs(F.col("value") - F.col("last.value")) >= 50).select(
        "user_id", "event_id", F.col("last.value").alias("last"), F.col("value").alias("current")
    )
    return scanned(rows, ["user_id"], last, jumps)


@query("stream_rise_alert", batch.RISES)
def stream_rise_alert(spark, folder):
    """Armed alerts are a table that rows and the watermark are joined with."""
    rows = event_stream(spark, folder, "ts", "user_id", "value", closing=True)
    rows = rows.withColumn("us", epoch_us(F.col("ts")))
    path, state = shared_path(spark, "stream-out"), shared_path(spark, "stream-state")
    write = timed.rise_batches(["user_id"], "us", "event_id", "value", 6 * HOUR, HOUR, path, state)
    return run_bounded(rows, path=path, write=write).select(
        "user_id", from_epoch_us(F.col("armed_at")).alias("armed_at"),
        from_epoch_us(F.col("alert_at")).alias("alert_at"),
    )


@query("stream_dedup_ttl", batch.TTL)
def stream_dedup_ttl(spark, folder):
    """Chains of a batch begin where the last output of the batches before leaves them."""
    rows = event_stream(spark, folder, "user_id", "us", "event_type")
    path, state = shared_path(spark, "stream-out"), shared_path(spark, "stream-state")
    line = F.concat_ws("$$", F.col("user_id").cast("string"), "event_type").alias("line")
    write = timed.dedup_batches(
        ["user_id"], "us", DAY, ["event_id"], path, state,
        finish=lambda kept: kept.select(line, "event_id"),
    )
    return run_bounded(rows, path=path, write=write).drop("batch")


@query("stream_dedup_forever", "select distinct user_id, event_type from events")
def stream_dedup_forever(spark, folder):
    keys = event_stream(spark, folder, "user_id", "event_type").select("user_id", "event_type")
    return run_bounded(keys.dropDuplicates(["user_id", "event_type"])).drop("batch")


@query("stream_control_filter", batch.CONTROLLED)
def stream_control_filter(spark, folder):
    words = events(spark, folder).select(F.col("event_type").alias("word"), "event_id")
    both = basic.connect(batch.control(spark, folder), words)
    # every word is hot: whether a control row came before is a running maximum
    control = [scan.running_max("blocked", F.col("input") == 1)]
    kept = lambda found: found.filter(
        (F.col("input") == 2) & ~F.coalesce("blocked", F.lit(False))
    ).select("word", "event_id")
    # of rows that arrive together, the word goes first
    both = both.withColumn("turn", -F.col("input"))
    order = ["event_id", "turn"]
    return scanned(as_stream(both, "event_id"), ["word"], control, kept, order)


@query("stream_count_window", ORACLES["win_count_sliding"])
def stream_count_window(spark, folder):
    rows = event_stream(spark, folder, "user_id", "cents")
    values = {
        "total": lambda w: F.sum("cents").over(w), "n": lambda w: F.count(F.lit(1)).over(w)
    }
    fired = lambda found: found.filter(F.col("nth") % 2 == 0).select(
        "user_id", "event_id", "total", "n"
    )
    return framed(rows, ["user_id"], 9, values, fired)


@query("stream_over_rows", window_queries.STREAM_OVER)
def stream_over_rows(spark, folder):
    """A row frame over a stream is a count window that slides by one row."""
    rows = event_stream(spark, folder, "user_id", "cents")
    values = {
        "total": lambda w: F.sum("cents").over(w), "cnt": lambda w: F.count("user_id").over(w)
    }
    named = lambda found: found.select(F.col("user_id").alias("id"), "event_id", "total", "cnt")
    return framed(rows, ["user_id"], 2, values, named)


@query("stream_retract_changelog", ORACLES["retract_changelog"])
def stream_retract_changelog(spark, folder):
    rows = event_stream(spark, folder, "user_id", "cents")
    log = lambda found: changelog.as_changes(found, ["user_id"], ["event_id"])
    return scanned(rows, ["user_id"], changelog.measures("cents"), log)


@query("stream_pattern_strict", batch.STRICT)
def stream_pattern_strict(spark, folder):
    """Rules and actions are two inputs: a rule holds for the actions that arrive after it."""
    return patterns(spark, batch.rules(spark, folder), events(spark, folder))


def patterns(spark, rules, actions):
    empty = F.lit(None).cast("string")
    both = rules.select(
        F.lit(1).alias("input"), "event_id", "action1", "action2",
        F.lit(None).cast("bigint").alias("user_id"), empty.alias("event_type"),
    ).unionByName(
        actions.select(
            F.lit(2).alias("input"), "event_id", empty.alias("action1"), empty.alias("action2"),
            "user_id", "event_type",
        )
    )
    path, state = shared_path(spark, "stream-out"), shared_path(spark, "stream-state")
    write = timed.pattern_batches("user_id", "event_type", "event_id", path, state)
    return run_bounded(as_stream(both, "event_id"), path=path, write=write).drop("batch")


#: every error is a rule of its user's two actions before it, known from then on
LEARNED = """(select action1, action2, min(event_id) as known_from from (
    select event_id, event_type, lag(event_type) over w as action2, lag(event_type, 2) over w as action1
    from events window w as (partition by user_id order by event_id))
  where event_type = 'error' and action1 is not null group by 1, 2)"""


@query(
    "stream_pattern_arriving",
    f"""with a as (select user_id, event_id, event_type as action,
      lag(event_type) over (partition by user_id order by event_id) as last from events)
    select user_id, event_id, action1, action2 from a join {LEARNED} r
    on action = action2 and last = action1 and known_from < event_id""",
)
def stream_pattern_arriving(spark, folder):
    """Rules that keep arriving, in early and late batches, some of them again."""
    rows = events(spark, folder).select("user_id", "event_id", "event_type")
    actions = {"recent": lambda w: F.collect_list("event_type").over(w)}
    recent = scan.framed(rows, ["user_id"], ["event_id"], 2, actions)
    rules = recent.filter((F.col("event_type") == "error") & (F.size("recent") == 3)).select(
        "event_id", F.col("recent")[0].alias("action1"), F.col("recent")[1].alias("action2")
    )
    return patterns(spark, rules, rows)


@query("stream_session", ORACLES["win_session"])
def stream_session(spark, folder):
    rows = event_stream(spark, folder, "ts", "user_id", "cents", closing=True)
    rows = rows.withColumn("us", epoch_us(F.col("ts")))
    path, state = shared_path(spark, "stream-out"), shared_path(spark, "stream-state")
    write = timed.session_batches(
        ["user_id"], "us", 6 * HOUR, HOUR, path, state, cents=(F.sum("cents"), "sum")
    )
    return run_bounded(rows, path=path, write=write).select(
        "user_id", from_epoch_us(F.col("first")).alias("session_start"),
        from_epoch_us(F.col("last") + 6 * HOUR).alias("session_end"), "n", "cents",
    )


#: rows of four days of arrival are one micro-batch
SLICE = 4 * DAY

#: the watermark moves once per micro-batch: rows are judged by the one before, windows by the one after
SLICED = f"""(with a as (select *, {ARRIVED} as arrived, {CENTS} as cents,
      epoch_us({ARRIVED}) // {SLICE} as slice, date_trunc('hour', ts) + interval 1 hour as window_end
      from events),
  m as (select slice, max(max(ts)) over (order by slice) - interval 1 hour as after from a group by 1),
  w as (select *, lag(after) over (order by slice) as before from m)
  select a.*, before, after, case when before >= window_end + interval 30 minute then 'too late'
    when before >= window_end then 'late' else 'on time' end as fate
  from a join w using (slice))"""


def sliced_windows(spark, folder, lateness):
    """Firings and late rows of windows over disordered arrivals."""
    rows = disordered(spark, folder).select(
        "event_id", "id", "cents", epoch_us(F.col("ts")).alias("us"),
        F.floor(epoch_us(F.col("arrived")) / SLICE).cast("bigint").alias("slice"),
    )
    path, state = shared_path(spark, "stream-out"), shared_path(spark, "stream-state")
    measures = [
        scan.running_sum("total", F.col("cents")), scan.running_count("n"),
        scan.running_min("lowest", F.struct("cents", "event_id")),
    ]
    write = timed.window_batches(["id"], "us", WINDOW, BOUND, lateness, measures, path, state)
    run_bounded(as_slices(rows, "slice"), path=f"{path}/firings", write=write)
    return path


@query(
    "stream_allowed_lateness",
    f"""with r as materialized (select * from {SLICED}),
    marks as (select distinct slice, after from r),
    firsts as (select event_type, window_end, sum(cents) as total, count(*) as n,
        arg_min(event_id, (cents, event_id)) as lowest
      from r where fate = 'on time' group by 1, 2),
    closed as (select e.window_end, min(after) as mark
      from (select distinct window_end from firsts) e join marks on after >= e.window_end group by 1),
    late as (select distinct event_type, window_end, slice, before from r where fate = 'late'),
    updates as (select l.event_type, l.window_end, l.before, sum(p.cents) as total, count(*) as n,
        arg_min(p.event_id, (p.cents, p.event_id)) as lowest
      from late l join r p on p.event_type = l.event_type and p.window_end = l.window_end
        and p.fate <> 'too late' and p.slice <= l.slice group by l.event_type, l.window_end, l.before)
    select event_type as id, window_end, 'first' as firing, cast(total as bigint) as total, n,
      lowest, mark - interval 1 millisecond as watermark from firsts join closed using (window_end)
    union all
    select event_type, window_end, 'update', cast(total as bigint), n, lowest,
      before - interval 1 millisecond from updates""",
)
def stream_allowed_lateness(spark, folder):
    fired = spark.read.parquet(f"{sliced_windows(spark, folder, LATENESS)}/firings")
    return fired.select(
        "id", from_epoch_us(F.col("end_us")).alias("window_end"), "firing", "total", "n",
        F.col("lowest.event_id").alias("lowest"),
        from_epoch_us(F.col("watermark_us")).alias("watermark"),
    )


@query(
    "stream_late_side_output",
    f"select event_id, event_type as id, ts, cents from {SLICED} where fate = 'too late'",
)
def stream_late_side_output(spark, folder):
    late = spark.read.parquet(f"{sliced_windows(spark, folder, LATENESS)}/late")
    return late.select("event_id", "id", from_epoch_us(F.col("us")).alias("ts"), "cents")


@query("stream_side_output", ORACLES["side_output_split"])
def stream_side_output(spark, folder):
    rows = event_stream(spark, folder, "value")
    name = F.when(F.col("value") > 30, "main").otherwise("lowTemp")
    path = shared_path(spark, "stream-out")

    def write(rows_of_batch, number: int) -> None:
        """Both outputs in one pass, each in a folder of its own."""
        laid = rows_of_batch.write.mode("overwrite").partitionBy("output")
        laid.parquet(f"{path}/batch={number}")

    return run_bounded(rows.withColumn("output", name), path=path, write=write).drop("batch")
