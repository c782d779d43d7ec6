"""Rolling aggregates, keyed state, lateness, changelogs, detection and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.records import lowest_record
from tideline.functions.time import DAY, HOUR, from_epoch_us
from tideline.operators import changelog, dedup, detect, lateness, rolling, scan, windows
from tideline.plans.inputs import (
    ARRIVED,
    BOUND,
    CENTS,
    LATENESS,
    WINDOW,
    cents,
    disordered,
    events,
    readings,
)
from tideline.plans.registry import query
from tideline.plans.window_queries import REPLAY
from tideline.session import stored

ORDER = ["event_id"]
ARRIVAL = ["arrived", "event_id"]


@query(
    "rolling_maxby",
    """select event_id as at_event_id, best.event_id as event_id, user_id, best.ts as ts,
      best.value as value
    from (select event_id, user_id,
      max(struct_pack(value := value, earlier := -event_id, event_id := event_id, ts := ts))
        over (partition by user_id order by event_id) as best from events)""",
)
def rolling_maxby(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "ts", "value")
    return rolling.rolling_max_by(rows, ["user_id"], ORDER, "value")


@query(
    "rolling_sum",
    f"""select event_id, event_id % 2 as parity,
      cast(sum({CENTS}) over (partition by event_id % 2 order by event_id) as bigint) as total
    from events""",
)
def rolling_sum(spark, folder):
    rows = readings(spark, folder).select(
        "event_id", (F.col("event_id") % 2).alias("parity"), "cents"
    )
    return rolling.rolling_sum(rows, ["parity"], ORDER, "cents", "total").drop("cents")


@query(
    "rolling_reduce",
    """select event_id, event_type as id, ts,
      max(value) over (partition by event_type order by event_id) as value from events""",
)
def rolling_reduce(spark, folder):
    rows = readings(spark, folder).select("event_id", "id", "ts", "value")
    return rolling.rolling_reduce(rows, ["id"], ORDER, "value")


@query(
    "state_key_count",
    """select event_id, user_id, row_number() over (partition by user_id order by event_id) as n
    from events""",
)
def state_key_count(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id")
    return rolling.rolling_count(rows, ["user_id"], ORDER, "n")


@query(
    "state_shard_count",
    """select event_id, event_type as shard,
      row_number() over (partition by event_type order by event_id) as n from events""",
)
def state_shard_count(spark, folder):
    rows = events(spark, folder).select("event_id", F.col("event_type").alias("shard"))
    return rolling.rolling_count(rows, ["shard"], ORDER, "n")


TEMP_JUMP = """select user_id, event_id, last, current from (
      select user_id, event_id, value as current,
        lag(value) over (partition by user_id order by event_id) as last from events)
    where abs(current - last) >= 50"""


@query("state_temp_jump", TEMP_JUMP)
def state_temp_jump(spark, folder):
    return detect.jumps(events(spark, folder), ["user_id"], ORDER, "value", 50.0)


RISES = """with recursive e as (
      select user_id, ts, value, row_number() over (partition by user_id order by ts, event_id) as n,
        coalesce(lag(value) over (partition by user_id order by ts, event_id), 4.9e-324) as last
      from events),
    walk as (
      select user_id, n, cast(null as timestamp) as fired,
        case when value > last then ts end as armed from e where n = 1
      union all
      select e.user_id, e.n,
        case when w.armed + interval 6 hour < e.ts then w.armed end,
        case when w.armed + interval 6 hour < e.ts or w.armed is null
            then case when e.value > e.last then e.ts end
          when e.value < e.last then null else w.armed end
      from walk w join e on e.user_id = w.user_id and e.n = w.n + 1),
    ends as (select user_id, arg_max(armed, n) filter (armed is not null) as armed,
        max(n) as n, max(n) filter (armed is not null) as armed_n from walk group by 1),
    alerts as (select user_id, fired as armed_at from walk where fired is not null
      union all select user_id, armed from ends where armed_n = n)
    select user_id, armed_at, armed_at + interval 6 hour as alert_at from alerts"""


@query("rise_alert", RISES)
def rise_alert(spark, folder):
    rows = readings(spark, folder).withColumn("us", lateness.epoch_us(F.col("ts")))
    alerts = detect.lasting_rises(rows, ["user_id"], "us", "event_id", "value", 6 * HOUR)
    return alerts.select(
        "user_id", from_epoch_us(F.col("armed_at")).alias("armed_at"),
        from_epoch_us(F.col("alert_at")).alias("alert_at"),
    )


def rules(spark, folder):
    """(view, purchase) and (click, purchase), each known from its user's first error event on."""
    known = spark.createDataFrame(
        [(1, "view", "purchase"), (2, "click", "purchase")],
        "user_id bigint, action1 string, action2 string",
    )
    errors = events(spark, folder).filter("event_type = 'error'")
    first = errors.join(F.broadcast(known), "user_id").groupBy("action1", "action2")
    return first.agg(F.min("event_id").alias("event_id"))


RULE_ROWS = """(select r.action1, r.action2, min(e.event_id) as known_from
  from events e join (values (1, 'view', 'purchase'), (2, 'click', 'purchase'))
    r(user_id, action1, action2) using (user_id)
  where e.event_type = 'error' group by 1, 2)"""


@query(
    "broadcast_pattern_ref",
    f"""with a as (select user_id, event_id, event_type as action,
      min(event_id) over (partition by user_id) as first from events)
    select user_id, event_id, action1, action2 from a join {RULE_ROWS} r
    on action = action2 and first < event_id and known_from < event_id""",
)
def broadcast_pattern_ref(spark, folder):
    return detect.patterns(
        events(spark, folder), rules(spark, folder), "user_id", "event_type", "event_id",
        mode="reference",
    )


STRICT = f"""with a as (select user_id, event_id, event_type as action,
      lag(event_type) over (partition by user_id order by event_id) as last from events)
    select user_id, event_id, action1, action2 from a join {RULE_ROWS} r
    on action = action2 and last = action1 and known_from < event_id"""


@query("broadcast_pattern_strict", STRICT)
def broadcast_pattern_strict(spark, folder):
    return detect.patterns(
        events(spark, folder), rules(spark, folder), "user_id", "event_type", "event_id"
    )


def control(spark, folder):
    return events(spark, folder).filter(
        "event_type = 'error' and ts >= timestamp_ntz'2024-01-10'"
    ).select(F.col("event_type").alias("word"), "event_id")


CONTROLLED = """select event_type as word, event_id from events w where not exists (
      select 1 from events c where c.event_type = 'error' and c.ts >= timestamp '2024-01-10'
        and c.event_type = w.event_type and c.event_id < w.event_id)"""


@query("control_filter_keyed", CONTROLLED)
def control_filter_keyed(spark, folder):
    words = events(spark, folder).select(F.col("event_type").alias("word"), "event_id")
    return detect.control_filter(words, control(spark, folder), "word", "event_id")


@query(
    "control_filter_unkeyed",
    """select event_type as word from events where event_type = 'error'
      and ts >= timestamp '2024-01-10'
    union all select event_type from events where event_type is distinct from 'view'""",
)
def control_filter_unkeyed(spark, folder):
    words = events(spark, folder).select(F.col("event_type").alias("word"))
    return detect.constant_filter(words, control(spark, folder), "word", "view")


TTL = """with recursive e as (
      select user_id, event_id, event_type, ts,
        row_number() over (partition by user_id order by ts, event_id) as n from events),
    walk as (
      select user_id, n, event_id, event_type, ts as emitted, true as out from e where n = 1
      union all
      select e.user_id, e.n, e.event_id, e.event_type,
        case when e.ts >= w.emitted + interval 1 day then e.ts else w.emitted end,
        e.ts >= w.emitted + interval 1 day
      from walk w join e on e.user_id = w.user_id and e.n = w.n + 1)
    select concat(user_id, '$$', event_type) as line, event_id from walk where out"""


@query("dedup_ttl", TTL)
def dedup_ttl(spark, folder):
    kept = dedup.dedup_ttl(
        events(spark, folder), ["user_id"], "ts", ORDER, ["event_id", "event_type"], DAY
    )
    return kept.select(
        F.concat_ws("$$", F.col("user_id").cast("string"), "event_type").alias("line"), "event_id"
    )


NO_TIME = "case when event_type <> 'error' then ts end"


@query("dedup_ttl_nulls", TTL.replace("from events)", "from events where event_type <> 'error')"))
def dedup_ttl_nulls(spark, folder):
    """Error events have no time, and take no part."""
    rows = events(spark, folder).withColumn("ts", F.expr(NO_TIME))
    kept = dedup.dedup_ttl(rows, ["user_id"], "ts", ORDER, ["event_id", "event_type"], DAY)
    return kept.select(
        F.concat_ws("$$", F.col("user_id").cast("string"), "event_type").alias("line"), "event_id"
    )


FOREVER = """select user_id, event_type, arg_min(event_id, event_id) as event_id,
      arg_min(value, event_id) as value from events group by 1, 2"""


@query("dedup_forever", FOREVER)
def dedup_forever(spark, folder):
    return dedup.dedup_forever(
        events(spark, folder), ["user_id", "event_type"], ORDER, ["event_id", "value"]
    )


@query(
    "retract_changelog",
    f"""with r as (select event_id, user_id,
      row_number() over w as cnt, cast(sum({CENTS}) over w as bigint) as total, {CENTS} as cents
      from events window w as (partition by user_id order by event_id))
    select event_id, user_id, true as op, cnt, total from r
    union all select event_id, user_id, false, cnt - 1, total - cents from r where cnt > 1""",
)
def retract_changelog(spark, folder):
    rows = readings(spark, folder)
    return changelog.retract_changelog(rows, ["user_id"], ORDER, "cents")


@query(
    "watermark_replay",
    f"""select event_id, arrived, ts, before as wm_before,
      after - interval 1 millisecond as watermark, fate from {REPLAY}""",
)
def watermark_replay(spark, folder):
    replayed = lateness.replay(disordered(spark, folder), ARRIVAL, "ts", WINDOW, BOUND, LATENESS)
    return replayed.select(
        "event_id", "arrived", "ts", from_epoch_us(F.col("before_us")).alias("wm_before"),
        lateness.as_watermark("after_us").alias("watermark"), "fate",
    )


@query(
    "late_side_output",
    f"select event_id, event_type as id, ts, value from {REPLAY} where fate = 'too late'",
)
def late_side_output(spark, folder):
    replayed = lateness.replay(disordered(spark, folder), ARRIVAL, "ts", WINDOW, BOUND, LATENESS)
    return lateness.late_rows(replayed).select("event_id", "id", "ts", "value")


@query(
    "allowed_lateness_firings",
    f"""with r as materialized (select * from {REPLAY}),
    ends as (select distinct window_end from r),
    closed as (select e.window_end, min(r.after) - interval 1 millisecond as watermark
      from ends e left join r on r.after >= e.window_end group by 1),
    firsts as (select event_type, window_end, arg_min(event_id, (value, arrived, event_id)) as lowest
      from r where fate = 'on time' group by 1, 2),
    updates as (select l.event_type, l.window_end, l.event_id as fired_by,
        l.before - interval 1 millisecond as watermark,
        arg_min(p.event_id, (p.value, p.arrived, p.event_id)) as lowest
      from r l join r p on p.event_type = l.event_type and p.window_end = l.window_end
        and p.fate <> 'too late' and (p.arrived, p.event_id) <= (l.arrived, l.event_id)
      where l.fate = 'late' group by all)
    select event_type as id, window_end, 'first' as firing, cast(null as bigint) as fired_by,
      lowest as event_id, watermark from firsts join closed using (window_end)
    union all
    select event_type, window_end, 'update', fired_by, lowest, watermark from updates""",
)
def allowed_lateness_firings(spark, folder):
    rows = disordered(spark, folder).select("event_id", "arrived", "id", "ts", "value")
    replayed = stored(
        lateness.replay(rows, ARRIVAL, "ts", WINDOW, BOUND, LATENESS), "replayed"
    )
    fired = lateness.lowest_firings(
        replayed, ["id"], ARRIVAL, "value", WINDOW, ["event_id", "value"]
    )
    return fired.select(
        "id", from_epoch_us(F.col("end_us")).alias("window_end"), "firing",
        F.col("fired_by_event_id").alias("fired_by"), F.col("record.event_id").alias("event_id"),
        from_epoch_us(F.col("watermark_us")).alias("watermark"),
    )


@query(
    "win_sum_lateness",
    f"""with r as materialized (select * from {REPLAY}),
    ends as (select distinct window_end from r),
    closed as (select e.window_end, min(r.after) - interval 1 millisecond as watermark
      from ends e left join r on r.after >= e.window_end group by 1),
    firsts as (select event_type, window_end, sum(cents) as cents, count(*) as n
      from r where fate = 'on time' group by 1, 2),
    updates as (select l.event_type, l.window_end, l.event_id as fired_by,
        l.before - interval 1 millisecond as watermark, sum(p.cents) as cents, count(*) as n
      from r l join r p on p.event_type = l.event_type and p.window_end = l.window_end
        and p.fate <> 'too late' and (p.arrived, p.event_id) <= (l.arrived, l.event_id)
      where l.fate = 'late' group by all)
    select event_type as id, window_end, 'first' as firing, cast(null as bigint) as fired_by,
      cast(cents as bigint) as cents, n, watermark from firsts join closed using (window_end)
    union all
    select event_type, window_end, 'update', fired_by, cast(cents as bigint), n, watermark
    from updates""",
)
def win_sum_lateness(spark, folder):
    """A keyed window that sums, with allowed lateness; `late_side_output` has what came too late."""
    rows = disordered(spark, folder).select("event_id", "arrived", "id", "ts", "cents")
    replayed = stored(
        lateness.replay(rows, ARRIVAL, "ts", WINDOW, BOUND, LATENESS), "replayed"
    )
    measures = [scan.running_sum("cents_so_far", F.col("cents")), scan.running_count("n")]
    fired = lateness.firings(replayed, ["id"], ARRIVAL, WINDOW, measures)
    return fired.select(
        "id", from_epoch_us(F.col("end_us")).alias("window_end"), "firing",
        F.col("fired_by_event_id").alias("fired_by"), F.col("cents_so_far").alias("cents"), "n",
        from_epoch_us(F.col("watermark_us")).alias("watermark"),
    )


#: the watermark moves every two hours of arrival
TICK = 2 * HOUR

#: rows as `REPLAY` gives them, under another watermark
FATE = """date_trunc('hour', ts) + interval 1 hour as window_end,
    case when before >= date_trunc('hour', ts) + interval 90 minute then 'too late'
      when before >= date_trunc('hour', ts) + interval 1 hour then 'late' else 'on time' end as fate"""

PERIODIC = f"""(with a as (select *, {ARRIVED} as arrived, {CENTS} as cents,
      epoch_us({ARRIVED}) // {TICK} as tick from events),
  t as (select tick, max(ts) as high from a group by 1),
  w as (select tick, max(high) over o - interval 1 hour as after,
      max(high) over (order by tick rows between unbounded preceding and 1 preceding)
        - interval 1 hour as before
    from t window o as (order by tick))
  select *, {FATE} from a join w using (tick))"""


@query(
    "watermark_periodic",
    f"select event_id, arrived, ts, before as wm_before, after as wm_next, fate from {PERIODIC}",
)
def watermark_periodic(spark, folder):
    """Rows between two ticks see the watermark of the first."""
    rows = disordered(spark, folder).select("event_id", "arrived", "ts")
    seen = lateness.periodic_watermarks(rows, "arrived", "ts", TICK, BOUND)
    return lateness.judged(seen, "ts", WINDOW, LATENESS).select(
        "event_id", "arrived", "ts", from_epoch_us(F.col("before_us")).alias("wm_before"),
        from_epoch_us(F.col("after_us")).alias("wm_next"), "fate",
    )


@query(
    "win_sum_periodic",
    f"""with r as materialized (select * from {PERIODIC}),
    ends as (select distinct window_end from r),
    closed as (select e.window_end, min(r.after) - interval 1 millisecond as watermark
      from ends e left join r on r.after >= e.window_end group by 1)
    select event_type as id, window_end, cast(sum(cents) as bigint) as cents, count(*) as n, watermark
    from r join closed using (window_end) where fate = 'on time' group by all""",
)
def win_sum_periodic(spark, folder):
    """Windows that fire at the first tick whose watermark passes their end."""
    rows = disordered(spark, folder).select("event_id", "arrived", "id", "ts", "cents")
    seen = lateness.periodic_watermarks(rows, "arrived", "ts", TICK, BOUND)
    replayed = stored(lateness.judged(seen, "ts", WINDOW, LATENESS), "replayed")
    measures = [scan.running_sum("total", F.col("cents")), scan.running_count("n")]
    fired = lateness.firings(replayed, ["id"], ARRIVAL, WINDOW, measures)
    return fired.filter("firing = 'first'").select(
        "id", from_epoch_us(F.col("end_us")).alias("window_end"), F.col("total").alias("cents"), "n",
        from_epoch_us(F.col("watermark_us")).alias("watermark"),
    )


#: three sources, of which the third only sends in the first six hours of a day
SOURCE = "case when event_id % 3 = 2 and hour(arrived) >= 6 then 0 else event_id % 3 end"

SOURCES = f"""(with a as (select *, {SOURCE} as source from (select *, {ARRIVED} as arrived from events)),
  h as (select *,
      max(case when source = 0 then ts end) over o as high0,
      max(case when source = 1 then ts end) over o as high1,
      max(case when source = 2 then ts end) over o as high2,
      arrived - max(case when source = 0 then arrived end) over o <= interval 2 hour as on0,
      arrived - max(case when source = 1 then arrived end) over o <= interval 2 hour as on1,
      arrived - max(case when source = 2 then arrived end) over o <= interval 2 hour as on2,
      arrived - min(arrived) over o <= interval 2 hour as starting
    from a window o as (order by arrived, event_id)),
  l as (select *, case when starting and (high0 is null or high1 is null or high2 is null) then null
      else least(case when on0 then high0 end, case when on1 then high1 end,
        case when on2 then high2 end) end as low from h),
  w as (select *, max(low) over (order by arrived, event_id rows between unbounded preceding
        and 1 preceding) - interval 1 hour as before,
      max(low) over (order by arrived, event_id rows between unbounded preceding and current row)
        - interval 1 hour as after from l)
  select *, {FATE} from w)"""


@query(
    "watermark_sources",
    f"""select event_id, cast(source as bigint) as source, before as wm_before, after as wm_after, fate
    from {SOURCES}""",
)
def watermark_sources(spark, folder):
    """The watermark of three sources, one of them idle for hours every day."""
    rows = disordered(spark, folder).withColumn("source", F.expr(SOURCE).cast("bigint")).select(
        "event_id", "arrived", "ts", "source"
    )
    seen = lateness.merged_watermarks(
        rows, ARRIVAL, "arrived", "ts", "source", [0, 1, 2], BOUND, 2 * HOUR
    )
    return lateness.judged(seen, "ts", WINDOW, LATENESS).select(
        "event_id", "source", from_epoch_us(F.col("before_us")).alias("wm_before"),
        from_epoch_us(F.col("after_us")).alias("wm_after"), "fate",
    )


NO_VALUE = "case when event_type <> 'error' then value end"


@query(
    "win_reduce_nulls",
    f"""select event_type as id, date_trunc('hour', ts) as window_start,
      arg_min(event_id, (value, event_id)) filter (value is not null) as event_id
    from (select event_id, event_type, ts, {NO_VALUE} as value from events) group by 1, 2""",
)
def win_reduce_nulls(spark, folder):
    """Error events have no value: a window of them has no lowest record."""
    rows = readings(spark, folder).withColumn("value", F.expr(NO_VALUE.replace("event_type", "id")))
    lowest = windows.tumbling(
        rows, ["id"], "ts", "1 hour", [lowest_record("value", ["event_id"], ["event_id"], "lowest")]
    )
    return lowest.select("id", F.col("window.start").alias("window_start"), "lowest.event_id")


@query(
    "hourly_tips_all_signed",
    f"""with t as (select user_id, date_trunc('hour', ts) + interval 1 hour as window_end,
        cast(sum(case when event_type <> 'view' then 2000 - {CENTS} end) as bigint) as cents
      from events group by 1, 2),
    w as (select distinct window_end from t),
    s as (select w.window_end, t.user_id, cast(sum(t.cents) as bigint) as total
      from w join t on t.window_end <= w.window_end and t.cents is not null group by 1, 2)
    select user_id as driver, total, window_end from s
    qualify row_number() over (partition by window_end order by total desc, user_id) = 1""",
)
def hourly_tips_all_signed(spark, folder):
    """Totals of both signs, and null for a driver who only has views: sums also fall."""
    signed = F.expr("case when event_type <> 'view' then 2000 - cents end")
    rows = events(spark, folder).select(
        F.col("user_id").alias("driver"), "ts", "event_type", cents().alias("cents")
    )
    totals = windows.window_total(rows.withColumn("cents", signed), ["driver"], "ts", "1 hour", "cents")
    return windows.running_winner(totals, "driver", HOUR).select(
        "driver", "total", F.col("window_end").cast("timestamp_ntz").alias("window_end")
    )
