"""Time-window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import accumulate
from tideline.functions.records import first_record, last_record, lowest_record
from tideline.functions.strings import label
from tideline.functions.time import HOUR
from tideline.operators import lateness, rolling, scan, windows
from tideline.plans.inputs import BOUND, CENTS, WINDOW, disordered, readings
from tideline.plans.registry import query
from tideline.session import stored

HOURLY = f"""select user_id as driver, date_trunc('hour', ts) as window_start,
  cast(sum({CENTS}) as bigint) as total from events group by 1, 2"""


def driver_totals(spark: SparkSession, folder: str) -> DataFrame:
    fares = readings(spark, folder).select(F.col("user_id").alias("driver"), "ts", "cents")
    return windows.window_total(fares, ["driver"], "ts", "1 hour", "cents")


@query(
    "hourly_tips",
    f"select driver, total, window_start + interval 1 hour as window_end from ({HOURLY})",
)
def hourly_tips(spark, folder):
    return driver_totals(spark, folder).select(
        "driver", "total", F.col("window.end").alias("window_end")
    )


@query(
    "hourly_tips_max",
    f"""select driver, total, window_start + interval 1 hour as window_end
    from (select *, row_number() over (partition by window_start order by total desc, driver) as r
          from ({HOURLY})) where r = 1""",
)
def hourly_tips_max(spark, folder):
    return windows.window_winner(driver_totals(spark, folder), "driver", "1 hour")


# the same result from the other form of the job: one operator over the whole window
@query(
    "hourly_tips_all",
    f"""select min(driver) as driver, total, window_start + interval 1 hour as window_end
    from ({HOURLY}) t join
      (select window_start, max(total) as total from ({HOURLY}) group by 1) m
      using (window_start, total)
    group by total, window_start""",
)
def hourly_tips_all(spark, folder):
    return windows.window_winner(driver_totals(spark, folder), "driver", "1 hour")


@query(
    "hourly_tips_all_cumulative",
    f"""with h as ({HOURLY}),
    sums as (select driver, window_start,
      cast(sum(total) over (partition by driver order by window_start) as bigint) as total from h),
    held as (select w.window_start, s.driver, arg_max(s.total, s.window_start) as total
      from (select distinct window_start from h) w
      join sums s on s.window_start <= w.window_start group by 1, 2)
    select driver, total, window_start + interval 1 hour as window_end
    from (select *, row_number() over (partition by window_start order by total desc, driver) as r
          from held) where r = 1""",
)
def hourly_tips_all_cumulative(spark, folder):
    return windows.running_winner(driver_totals(spark, folder), "driver", HOUR)


@query(
    "win_tumble_count",
    """select event_type as id, date_trunc('hour', ts) as window_start, count(*) as n
    from events group by 1, 2""",
)
def win_tumble_count(spark, folder):
    counted = windows.tumbling(
        readings(spark, folder), ["id"], "ts", "1 hour", [F.count(F.lit(1)).alias("n")]
    )
    return counted.select("id", F.col("window.start").alias("window_start"), "n")


@query(
    "win_apply_count",
    """select event_type as id, epoch_ms(date_trunc('hour', ts) + interval 1 hour) as end_ms,
    count(*) as n from events group by 1, 2""",
)
def win_apply_count(spark, folder):
    counted = windows.tumbling(
        readings(spark, folder), ["id"], "ts", "1 hour", [F.count(F.lit(1)).alias("n")]
    )
    end = F.unix_millis(F.col("window.end").cast("timestamp"))
    return counted.select("id", end.alias("end_ms"), "n")


@query(
    "win_sum_first",
    f"""select event_type as id, time_bucket(interval 3 hour, ts, timestamp '1970-01-01')
      as window_start, arg_min(event_id, event_id) as first_event, arg_min(ts, event_id) as first_ts,
    cast(sum({CENTS}) as bigint) as cents from events group by 1, 2""",
)
def win_sum_first(spark, folder):
    summed = windows.tumbling(
        readings(spark, folder), ["id"], "ts", "3 hours",
        [
            F.sum("cents").alias("cents"),
            first_record(["event_id"], ["event_id", "ts"], "first"),
        ],
    )
    return summed.select(
        "id", F.col("window.start").alias("window_start"),
        F.col("first.event_id").alias("first_event"), F.col("first.ts").alias("first_ts"), "cents",
    )


@query(
    "win_reduce_sum",
    f"""select event_type as id, arg_min(ts, event_id) as ts, cast(sum({CENTS}) as bigint) as cents
    from events group by event_type, date_trunc('hour', ts)""",
)
def win_reduce_sum(spark, folder):
    summed = windows.tumbling(
        readings(spark, folder), ["id"], "ts", "1 hour",
        [F.sum("cents").alias("cents"), first_record(["event_id"], ["ts"], "first")],
    )
    return summed.select("id", "first.ts", "cents")


# windows over disordered arrivals, as a running watermark closes them
REPLAY = f"""(with a as (select *, ts + to_minutes(cast(((event_id * 7919) % 13) * 15 as integer))
      as arrived, {CENTS} as cents from events),
  w as (select *, max(ts) over (order by arrived, event_id
      rows between unbounded preceding and 1 preceding) - interval 1 hour as before,
    max(ts) over (order by arrived, event_id
      rows between unbounded preceding and current row) - interval 1 hour as after,
    date_trunc('hour', ts) as window_start, date_trunc('hour', ts) + interval 1 hour as window_end
    from a)
  select *, case when before >= window_end + interval 30 minute then 'too late'
    when before >= window_end then 'late' else 'on time' end as fate from w)"""

CLOSED = f"""(select e.window_end, min(r.after) - interval 1 millisecond as watermark
  from (select distinct window_end from {REPLAY}) e
  left join {REPLAY} r on r.after >= e.window_end group by 1)"""


@query(
    "win_process_meta",
    f"""select event_type as id, watermark, window_start, window_end, cents from
    (select event_type, window_start, window_end, cast(sum(cents) as bigint) as cents
     from {REPLAY} where fate = 'on time' group by all) join {CLOSED} using (window_end)""",
)
def win_process_meta(spark, folder):
    order = ["arrived", "event_id"]
    rows = disordered(spark, folder).select("event_id", "arrived", "id", "ts", "cents")
    replayed = stored(lateness.replay(rows, order, "ts", WINDOW, BOUND), "replayed")
    totals = (
        replayed.filter(F.col("fate") == lateness.ON_TIME)
        .groupBy("id", "start_us", "end_us")
        .agg(F.sum("cents").alias("cents"))
    )
    closed = lateness.closing_watermarks(replayed, WINDOW)
    return totals.join(closed, "end_us").select(
        "id", lateness.as_watermark("closed_at").alias("watermark"),
        lateness.from_epoch_us(F.col("start_us")).alias("window_start"),
        lateness.from_epoch_us(F.col("end_us")).alias("window_end"), "cents",
    )


@query(
    "win_reduce_min",
    f"""select event_type as id, arg_min(event_id, (value, event_id)) as event_id,
    min(value) as value,
    concat(epoch_ms(date_trunc('hour', ts)), '$$$', epoch_ms(date_trunc('hour', ts)) + 3600000)
      as span
    from events group by event_type, date_trunc('hour', ts)""",
)
def win_reduce_min(spark, folder):
    lowest = windows.tumbling(
        readings(spark, folder), ["id"], "ts", "1 hour",
        [lowest_record("value", ["event_id"], ["event_id", "value"], "lowest")],
    )
    start, end = (
        F.unix_millis(F.col(f"window.{side}").cast("timestamp")) for side in ("start", "end")
    )
    return lowest.select("id", "lowest.*", label(start, end, separator="$$$").alias("span"))


@query(
    "win_reduce_process",
    f"""select event_type as id, event_id, value, concat(epoch_ms(window_start), '$$$',
      epoch_ms(window_end)) as span, watermark
    from (select event_type, window_start, window_end,
        arg_min(event_id, (value, arrived, event_id)) as event_id, min(value) as value
      from {REPLAY} where fate = 'on time' group by all) join {CLOSED} using (window_end)""",
)
def win_reduce_process(spark, folder):
    """The reduced record of a window with its span and the watermark at which it fired."""
    order = ["arrived", "event_id"]
    rows = disordered(spark, folder).select("event_id", "arrived", "id", "ts", "value")
    replayed = stored(lateness.replay(rows, order, "ts", WINDOW, BOUND), "replayed")
    fired = lateness.lowest_firings(
        replayed, ["id"], order, "value", WINDOW, ["event_id", "value"]
    )
    start, end = (F.floor(F.col(c) / 1000) for c in ("start_us", "end_us"))
    span = label(start, end, separator="$$$")
    watermark = lateness.from_epoch_us(F.col("watermark_us")).alias("watermark")
    return fired.select("id", "record.event_id", "record.value", span.alias("span"), watermark)


@query(
    "win_session",
    f"""with g as (select user_id, ts, {CENTS} as cents,
      case when ts - lag(ts) over (partition by user_id order by ts) <= interval 6 hour
        then 0 else 1 end as starts from events),
    s as (select *, sum(starts) over (partition by user_id order by ts) as session from g)
    select user_id, min(ts) as session_start, max(ts) + interval 6 hour as session_end,
      count(*) as n, cast(sum(cents) as bigint) as cents
    from s group by user_id, session""",
)
def win_session(spark, folder):
    return windows.sessions(
        readings(spark, folder), ["user_id"], "ts", 6 * HOUR, cents=(F.sum("cents"), "sum")
    )


@query(
    "win_session_nulls",
    f"""with g as (select user_id, ts, {CENTS} as cents,
      case when ts - lag(ts) over (partition by user_id order by ts) <= interval 6 hour
        then 0 else 1 end as starts from events where event_type <> 'error'),
    s as (select *, sum(starts) over (partition by user_id order by ts) as session from g)
    select user_id, min(ts) as session_start, max(ts) + interval 6 hour as session_end,
      count(*) as n, cast(sum(cents) as bigint) as cents
    from s group by user_id, session""",
)
def win_session_nulls(spark, folder):
    """Error events have no time, and are in no session."""
    rows = readings(spark, folder).withColumn("ts", F.expr("case when id <> 'error' then ts end"))
    return windows.sessions(rows, ["user_id"], "ts", 6 * HOUR, cents=(F.sum("cents"), "sum"))


@query(
    "win_avg_accumulator",
    f"""select event_type as id, date_trunc('hour', ts) as window_start,
    cast(sum({CENTS}) as double) / (count(*) * 100) as avg_temp from events group by 1, 2""",
)
def win_avg_accumulator(spark, folder):
    """The mean of a window through an accumulator."""
    rows = readings(spark, folder).withColumn("window_start", F.window("ts", "1 hour").start)
    return accumulate.aggregated(rows, ["id", "window_start"], ["cents"], accumulate.Mean("avg_temp", 100))


@query(
    "agg_sum_last_accumulator",
    f"""select event_type as id, arg_max(event_id, event_id) as last, cast(sum({CENTS}) as bigint)
      as total from events group by event_type""",
)
def agg_sum_last_accumulator(spark, folder):
    """A sum with the last row's id through an accumulator; every key is hot."""
    rows = readings(spark, folder)
    return accumulate.aggregated(rows, ["id"], ["event_id", "cents"], accumulate.SumWithLast())


TABLE_TUMBLE = f"""select user_id as id, count(user_id) as cnt,
  cast(sum({CENTS}) as double) / (count(value) * 100) as avg_temp,
  date_trunc('day', ts) + interval 1 day as window_end from events group by 1, date_trunc('day', ts)"""


@query("tbl_tumble", TABLE_TUMBLE)
def tbl_tumble(spark, folder):
    average = F.sum("cents").cast("double") / (F.count("value") * 100)
    grouped = windows.tumbling(
        readings(spark, folder).drop("id"), ["user_id"], "ts", "1 day",
        [F.count("user_id").alias("cnt"), average.alias("avg_temp")],
    )
    return grouped.select(
        F.col("user_id").alias("id"), "cnt", "avg_temp", F.col("window.end").alias("window_end")
    )


@query("sql_tumble", TABLE_TUMBLE)
def sql_tumble(spark, folder):
    readings(spark, folder).createOrReplaceTempView("sensor")
    return spark.sql(
        """select user_id as id, count(user_id) as cnt,
             cast(sum(cents) as double) / (count(value) * 100) as avg_temp, window.end as window_end
           from sensor group by user_id, window(ts, '1 day')"""
    )


TABLE_OVER = f"""select user_id as id, ts as rt, count(user_id) over ow as cnt,
  cast(sum({CENTS}) over ow as bigint) as total from events
  window ow as (partition by user_id order by ts, event_id rows between 2 preceding and current row)"""


STREAM_OVER = f"""select user_id as id, event_id, count(*) over ow as cnt,
  cast(sum({CENTS}) over ow as bigint) as total from events
  window ow as (partition by user_id order by event_id rows between 2 preceding and current row)"""


@query("tbl_over_rows", TABLE_OVER)
def tbl_over_rows(spark, folder):
    rows = readings(spark, folder).select("user_id", "ts", "event_id", "cents")
    framed = rolling.over_rows(rows, ["user_id"], ["ts", "event_id"], 2, "cents", "user_id")
    return framed.select(F.col("user_id").alias("id"), F.col("ts").alias("rt"), "cnt", "total")


@query("sql_over_rows", TABLE_OVER)
def sql_over_rows(spark, folder):
    rows = readings(spark, folder).select("user_id", "ts", "event_id", "cents")
    order = ["ts", "event_id"]
    scan.in_blocks(rows, ["user_id"], order, 2).createOrReplaceTempView("sensor")
    return spark.sql(
        """select id, rt, cnt, total from (
             select user_id as id, ts as rt, home, block,
               count(user_id) over ow as cnt, sum(cents) over ow as total from sensor
             window ow as (partition by user_id, block order by ts, event_id
               rows between 2 preceding and current row))
           where home = block"""
    )


@query(
    "agg_sum_last",
    f"""select event_type as id, arg_max(ts, event_id) as ts, cast(sum({CENTS}) as bigint) as cents
    from events group by event_type, date_trunc('hour', ts)""",
)
def agg_sum_last(spark, folder):
    summed = windows.tumbling(
        readings(spark, folder), ["id"], "ts", "1 hour",
        [F.sum("cents").alias("cents"), last_record(["event_id"], ["ts"], "last")],
    )
    return summed.select("id", "last.ts", "cents")


@query(
    "win_avg",
    f"""select event_type as id, date_trunc('hour', ts) as window_start,
    cast(sum({CENTS}) as double) / (count(*) * 100) as avg_temp from events group by 1, 2""",
)
def win_avg(spark, folder):
    average = F.sum("cents").cast("double") / (F.count("cents") * 100)
    grouped = windows.tumbling(
        readings(spark, folder), ["id"], "ts", "1 hour", [average.alias("avg_temp")]
    )
    return grouped.select("id", F.col("window.start").alias("window_start"), "avg_temp")


@query(
    "win_count_sliding",
    f"""select user_id, event_id, total, n from (select user_id, event_id,
      cast(sum({CENTS}) over w as bigint) as total, count(*) over w as n,
      row_number() over (partition by user_id order by event_id) as nth from events
      window w as (partition by user_id order by event_id rows between 9 preceding and current row))
    where nth % 2 = 0""",
)
def win_count_sliding(spark, folder):
    rows = readings(spark, folder).select("user_id", "event_id", "cents")
    fired = rolling.count_window(rows, ["user_id"], ["event_id"], 10, 2, "cents")
    return fired.drop("cents")
