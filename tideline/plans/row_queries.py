"""Sources, sinks, row-wise operators, splits, connects, exchanges and functions."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tideline.functions import udf
from tideline.functions.strings import split_line, string_hash, utf16_length
from tideline.functions.time import epoch_ms, epoch_us, event_time
from tideline.operators import basic, parse
from tideline.plans.inputs import (
    CENTS,
    LINES,
    action_lines,
    cents,
    events,
    readings,
    sensor_lines,
    written_lines,
)
from tideline.plans.registry import query
from tideline.session import shared_path, table
from tideline.sinks.tables import KeyValueTable, SeenKeys, append_csv, append_documents
from tideline.sources import files, kafka

# ---- sources


@query(
    "src_collection",
    """select e.event_id, e.event_type, l.warn_above, e.value > l.warn_above as above from events e
    left join (values ('click', 30.0::double), ('view', 45.5), ('purchase', 60.0))
      l(event_type, warn_above) using (event_type)""",
)
def src_collection(spark, folder):
    limits = files.from_collection(
        spark, [("click", 30.0), ("view", 45.5), ("purchase", 60.0)],
        "event_type string, warn_above double",
    )
    # three literal rows
    joined = events(spark, folder).join(F.broadcast(limits), "event_type", "left")
    above = (F.col("value") > F.col("warn_above")).alias("above")
    return joined.select("event_id", "event_type", "warn_above", above)


@query(
    "src_elements",
    "select event_id, user_id, user_id in (1, 34, 4, 657, 23) as listed from events",
)
def src_elements(spark, folder):
    users = files.from_elements(spark, 1, 34, 4, 657, 23, name="user_id")
    marked = users.withColumn("listed", F.lit(True))  # five literals
    joined = events(spark, folder).join(F.broadcast(marked), "user_id", "left")
    listed = F.when(F.col("user_id").isNotNull(), F.coalesce("listed", F.lit(False)))
    return joined.select("event_id", "user_id", listed.alias("listed"))


@query("src_text", f"select value from {LINES}")
def src_text(spark, folder):
    return files.text_lines(spark, written_lines(sensor_lines(spark, folder), "lines"))


CSV_ROWS = """select event_type as id, epoch_us(ts) // 1000 as timestamp,
  case when event_type <> 'error' then value end as temp from events"""


@query("src_csv_table", CSV_ROWS)
def src_csv_table(spark, folder):
    path = written_lines(sensor_lines(spark, folder), "csv")
    files.csv_table(spark, path, "id string, timestamp bigint, temp double", "input_table")
    return spark.table("input_table")


@query("src_csv_payload", CSV_ROWS)
def src_csv_payload(spark, folder):
    return kafka.csv_payload(
        sensor_lines(spark, folder), "id string, timestamp bigint, temp double"
    )


@query(
    "src_custom_datasource",
    """select event_id as seq, event_type as id, epoch_us(ts) as time_us, value as temperature
    from events""",
)
def src_custom_datasource(spark, folder):
    """A source of the user's own is a function that gives a DataFrame of readings."""

    def source(path: str):
        rows = spark.read.parquet(path)
        return rows.select(
            F.col("event_id").alias("seq"), F.col("event_type").alias("id"),
            epoch_us(F.col("ts")).alias("time_us"), F.col("value").alias("temperature"),
        )

    return files.from_source(source, f"{folder}/events.parquet")


# ---- sinks


@query(
    "sink_csv_append",
    "select event_type as id, value as temperature from events",
)
def sink_csv_append(spark, folder):
    path = shared_path(spark, "sink-csv")
    rows = readings(spark, folder).select("id", F.col("value").alias("temp"))
    clicks = F.col("id") == "click"
    for part in (clicks, ~clicks | F.col("id").isNull()):  # two appends
        append_csv(rows.filter(part), path, ["id", "temperature"])
    return files.csv_table(spark, path, "id string, temperature double")


@query(
    "sink_json_docs",
    """select json_object('id', event_type, 'temp', cast(value as varchar), 'ts',
      cast(epoch_us(ts) // 1000 as varchar))::varchar as value from events""",
)
def sink_json_docs(spark, folder):
    path = shared_path(spark, "sink-json")
    rows = readings(spark, folder).withColumn("ms", epoch_ms(F.col("ts")))
    append_documents(rows, path, {"id": "id", "temp": "value", "ts": "ms"})
    return spark.read.text(path)


@query(
    "sink_kafka_payload",
    """select concat_ws(',', event_type, cast(epoch_us(ts) // 1000 as varchar), cast(value as varchar))
      as value from events""",
)
def sink_kafka_payload(spark, folder):
    rows = readings(spark, folder).withColumn("ms", epoch_ms(F.col("ts")))
    return kafka.to_csv_payload(rows, "id", "ms", "value")


@query(
    "sink_kafka_text",
    """select concat('Reading{id=''', event_type, ''', timestamp=', cast(epoch_us(ts) // 1000 as varchar),
      ', temperature=', cast(value as varchar), '}') as value from events""",
)
def sink_kafka_text(spark, folder):
    rows = readings(spark, folder).select(
        "id", epoch_ms(F.col("ts")).alias("timestamp"), F.col("value").alias("temperature")
    )
    return kafka.to_text_payload(rows, "Reading")


@query(
    "sink_kv_upsert",
    "select user_id as id, arg_max(value, event_id) as temperature from events group by 1",
)
def sink_kv_upsert(spark, folder):
    store = KeyValueTable(shared_path(spark, "sink-kv"), ["id"], ["event_id"])
    rows = events(spark, folder).select(
        F.col("user_id").alias("id"), "event_id", F.col("value").alias("temperature"), "ts"
    )
    noon = F.lit("2024-01-16").cast("timestamp_ntz")
    store.upsert(rows.filter(F.col("ts") < noon).drop("ts"), 0)
    store.upsert(rows.filter(F.col("ts") >= noon).drop("ts"), 1)
    return store.read(spark).select("id", "temperature")


@query(
    "dedup_persistent",
    """select user_id, event_type, arg_min(event_id, event_id) as event_id,
      cast(min(ts) >= timestamp '2024-01-03' as bigint) as run from events group by 1, 2""",
)
def dedup_persistent(spark, folder):
    store = SeenKeys(shared_path(spark, "seen-keys"), ["user_id", "event_type"], ["event_id"])
    rows = events(spark, folder).select("user_id", "event_type", "event_id", "ts")
    border = F.lit("2024-01-03").cast("timestamp_ntz")
    first = store.first_seen(rows.filter(F.col("ts") < border).drop("ts"), 0)
    second = store.first_seen(rows.filter(F.col("ts") >= border).drop("ts"), 1)
    run = lambda df, n: df.withColumn("run", F.lit(n).cast("bigint"))
    return run(first, 0).unionByName(run(second, 1))


# ---- projections, filters, parsing


@query("map_length", "select doc_id, cast(length(text) as bigint) as length from documents")
def map_length(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", utf16_length(F.col("text")).alias("length")
    )


@query("map_id_length", "select event_type as id, length(event_type) as length from events")
def map_id_length(spark, folder):
    rows = readings(spark, folder)
    return rows.select("id", utf16_length(F.col("id")).alias("length"))


@query(
    "parse_sensor",
    """select event_type as id, epoch_us(ts) // 1000 as timestamp, value as temperature from events
    where event_type <> 'error'""",
)
def parse_sensor(spark, folder):
    return parse.parse_sensor(sensor_lines(spark, folder))


@query("parse_malformed", f"select value as line from {LINES} where value like 'error,%'")
def parse_malformed(spark, folder):
    return parse.malformed_sensor(sensor_lines(spark, folder))


@query(
    "parse_fare",
    """select event_type as "driverId", epoch_us(ts) // 1000 as "timeStamp", cast(value as float) as fares
    from events where event_type <> 'error'""",
)
def parse_fare(spark, folder):
    return parse.parse_fare(sensor_lines(spark, folder))


@query(
    "map_permissive",
    """select case when event_type <> 'error' then cast(user_id as varchar) end as "userId",
      case when event_type <> 'error' then event_type end as action from events""",
)
def map_permissive(spark, folder):
    return parse.map_pair(action_lines(spark, folder), ("userId", "action"))


@query(
    "flatmap_drop_bad",
    """select cast(user_id as varchar) as "userId", event_type as action from events
    where event_type <> 'error'""",
)
def flatmap_drop_bad(spark, folder):
    return parse.flat_map_pair(action_lines(spark, folder), ("userId", "action"))


@query(
    "project_field",
    "select case when event_type <> 'error' then event_type end as action from events",
)
def project_field(spark, folder):
    return parse.map_pair(action_lines(spark, folder), ("userId", "action")).select("action")


@query(
    "flatmap_split",
    """select d.doc_id, w.word from documents d,
      lateral (select unnest(case when text = '' then [''] when rtrim(text, ',') = '' then []
        else string_split(rtrim(text, ','), ',') end) as word) w""",
)
def flatmap_split(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.explode(split_line(F.col("text"))).alias("word"))


@query("filter_prefix", "select c_custkey, c_name from customer where c_name like 'Customer#0000001%'")
def filter_prefix(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_name")
    return rows.filter(F.col("c_name").startswith("Customer#0000001"))


@query(
    "tbl_select_where",
    "select event_type as id, value as temperature from events where event_type = 'click'",
)
def tbl_select_where(spark, folder):
    rows = readings(spark, folder).select("id", F.col("value").alias("temperature"))
    return rows.where("id = 'click'")


@query(
    "tbl_select_filter",
    "select event_type as id, value as temp from events where event_type = 'view'",
)
def tbl_select_filter(spark, folder):
    rows = readings(spark, folder).select("id", F.col("value").alias("temp"))
    return rows.filter(F.col("id") == "view")


@query(
    "sql_select_where",
    "select event_type as id, value as temperature from events where event_type = 'purchase'",
)
def sql_select_where(spark, folder):
    readings(spark, folder).withColumnRenamed("value", "temperature").createOrReplaceTempView(
        "sensor"
    )
    return spark.sql("select id, temperature from sensor where id = 'purchase'")


@query("sql_select_none", "select event_type as id, value as temperature from events where false")
def sql_select_none(spark, folder):
    """A literal that no row has gives no row."""
    readings(spark, folder).withColumnRenamed("value", "temperature").createOrReplaceTempView(
        "sensor"
    )
    return spark.sql("select id, temperature from sensor where id = 'purhcase'")


@query("tbl_from_stream", "select event_type as id, epoch_us(ts) // 1000 as ts, value as temp from events")
def tbl_from_stream(spark, folder):
    rows = readings(spark, folder).select(
        "id", epoch_ms(F.col("ts")).alias("timestamp"), F.col("value").alias("temperature")
    )
    rows.select(
        "id", F.col("timestamp").alias("ts"), F.col("temperature").alias("temp")
    ).createOrReplaceTempView("data_table")
    return spark.table("data_table")


@query(
    "attr_proctime",
    "select event_type as id, ts, value as temp, true as has_pt from events",
)
def attr_proctime(spark, folder):
    """A processing time is another one each time; what can be checked is that every row has it."""
    rows = readings(spark, folder).select("id", "ts", F.col("value").alias("temp"))
    timed = rows.withColumn("pt", F.current_timestamp())
    return timed.select("id", "ts", "temp", F.col("pt").isNotNull().alias("has_pt"))


@query(
    "attr_rowtime",
    """select event_type as id, epoch_us(ts) // 1000 as timestamp, value as temp,
      make_timestamp(epoch_us(ts) // 1000 * 1000) as rt from events""",
)
def attr_rowtime(spark, folder):
    """The epoch number stays, the event time is appended."""
    rows = readings(spark, folder).select(
        "id", epoch_ms(F.col("ts")).alias("timestamp"), F.col("value").alias("temp")
    )
    return rows.withColumn("rt", event_time(F.col("timestamp")).cast("timestamp_ntz"))


@query(
    "attr_rowtime_replaced",
    """select event_type as id, date_trunc('second', ts) as timestamp, value as temp from events""",
)
def attr_rowtime_replaced(spark, folder):
    """The event time takes the place of the epoch number, here in seconds."""
    rows = readings(spark, folder).select(
        "id", F.floor(epoch_ms(F.col("ts")) / 1000).alias("timestamp"), F.col("value").alias("temp")
    )
    return rows.withColumn("timestamp", event_time(F.col("timestamp"), "s").cast("timestamp_ntz"))


@query(
    "rich_partition_id",
    "select event_type as id, count(*) as n, true as has_task from events group by 1",
)
def rich_partition_id(spark, folder):
    """Tasks number their rows in their own way; rows per id, added up over tasks, do not change."""
    rows = readings(spark, folder).select("id", F.spark_partition_id().alias("task"))
    tasks = rows.groupBy("id", "task").agg(F.count(F.lit(1)).alias("n"))
    return tasks.groupBy("id").agg(
        F.sum("n").alias("n"), F.bool_and(F.col("task") >= 0).alias("has_task")
    )


@query("rich_lifecycle", "select event_type as id, length(event_type) as length from events")
def rich_lifecycle(spark, folder):
    def measure(beyond: str, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("id")
        # units of UTF-16, null for a null id
        units = pc.add(pc.utf8_length(ids), pc.count_substring_regex(ids, beyond))
        return pa.RecordBatch.from_arrays([ids, units.cast(pa.int64())], names=["id", "length"])

    return basic.rich_map(
        readings(spark, folder).select("id"), "id string, length bigint",
        open=lambda: "[\\x{10000}-\\x{10ffff}]", call=measure, close=lambda pattern: None,
    )


# ---- splits, connects, exchanges

SPLIT = "case when value > 30 then 'high' else 'low' end"


@query("split_select", f"select event_id, value, {SPLIT} as tag from events")
def split_select(spark, folder):
    tagged = basic.with_tag(readings(spark, folder).select("event_id", "value"), "value", 30.0)
    return basic.select_tags(tagged, ["high", "low"])


@query("split_select_high", "select event_id, value, 'high' as tag from events where value > 30")
def split_select_high(spark, folder):
    tagged = basic.with_tag(readings(spark, folder).select("event_id", "value"), "value", 30.0)
    return basic.select_tags(tagged, ["high"])


@query(
    "connect_comap",
    """select event_type as id, value as temp, 'high temp warning' as message from events
      where value > 30
    union all select event_type, null, 'normal' from events where value <= 30""",
)
def connect_comap(spark, folder):
    high = F.col("value") > 30
    return basic.co_map_split(
        readings(spark, folder), high,
        {"id": F.col("id"), "temp": F.col("value"), "message": F.lit("high temp warning")},
        {"id": F.col("id"), "message": F.lit("normal")},
    )


@query(
    "union_all",
    "select event_id, value from events union all select event_id, value from events",
)
def union_all(spark, folder):
    rows = readings(spark, folder).select("event_id", "value")
    high, low = basic.side_output(rows, F.col("value") > 30)
    return basic.union_all(high, low, rows)


@query(
    "side_output_split",
    """select event_id, value, case when value > 30 then 'main' else 'lowTemp' end as output
    from events""",
)
def side_output_split(spark, folder):
    rows = readings(spark, folder).select("event_id", "value")
    return basic.side_outputs(rows, {"main": F.col("value") > 30}, rest="lowTemp")


@query("key_by_expr", "select event_id % 2 as parity, event_id, user_id from events")
def key_by_expr(spark, folder):
    rows = events(spark, folder).select(
        (F.col("event_id") % 2).alias("parity"), "event_id", "user_id"
    )
    return basic.key_by(rows, "parity", "user_id")


@query("part_shuffle", "select event_id, value from events")
def part_shuffle(spark, folder):
    return basic.shuffled(events(spark, folder).select("event_id", "value"))


@query("part_rebalance", "select event_id, user_id from events")
def part_rebalance(spark, folder):
    return basic.rebalanced(events(spark, folder).select("event_id", "user_id"))


@query("part_global", f"select event_type as id, cast(sum({CENTS}) as bigint) as cents from events group by 1")
def part_global(spark, folder):
    """Only the small grouped result is gathered in one partition."""
    grouped = readings(spark, folder).groupBy("id").agg(F.sum("cents").alias("cents"))
    return basic.in_one_task(grouped)


@query(
    "lateral_split",
    """select c_custkey, w.word, cast(length(w.word) as bigint) as length from customer,
      lateral (select unnest(string_split(c_name, '#')) as word) w""",
)
def lateral_split(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_name")
    return basic.lateral_split(rows, "c_name", "#").drop("c_name")


@query(
    "sql_lateral_split",
    """select c_custkey, w.word, length(w.word) as length from customer,
      lateral (select unnest(string_split(c_name, '#')) as word) w""",
)
def sql_lateral_split(spark, folder):
    udf.register_split(spark, "split_words", "#")
    table(spark, folder, "customer").createOrReplaceTempView("sensor")
    return spark.sql(
        """select c_custkey, word, cast(length as bigint) as length
           from sensor, lateral split_words(c_name)"""
    )


# ---- aggregation and functions

WORDS = """select word, count(*) as n from (
      select unnest(case when text = '' then [''] when rtrim(text, ',') = '' then []
        else string_split(rtrim(text, ','), ',') end) as word from documents) group by 1"""


@query("word_count", WORDS)
def word_count(spark, folder):
    words = basic.flat_map_split(table(spark, folder, "documents"), "text")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


GROUPED = f"""select user_id as id, count(user_id) as cnt,
  cast(sum({CENTS}) as double) / (count(value) * 100) as avg_temp from events group by 1"""


@query("tbl_group_agg", GROUPED)
def tbl_group_agg(spark, folder):
    rows = events(spark, folder).select(F.col("user_id").alias("id"), "value", cents().alias("cents"))
    average = F.sum("cents").cast("double") / (F.count("value") * 100)
    return rows.groupBy("id").agg(F.count("id").alias("cnt"), average.alias("avg_temp"))


@query("sql_group_agg", GROUPED)
def sql_group_agg(spark, folder):
    readings(spark, folder).createOrReplaceTempView("sensor")
    return spark.sql(
        """select user_id as id, count(user_id) as cnt,
             cast(sum(cents) as double) / (count(value) * 100) as avg_temp
           from sensor group by user_id"""
    )


@query(
    "tbl_group_lineitem",
    """select l_returnflag, l_linestatus, count(*) as cnt,
      cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as cents,
      cast(sum(cast(l_quantity as bigint)) as double) / count(*) as avg_qty
    from lineitem group by 1, 2""",
)
def tbl_group_lineitem(spark, folder):
    average = F.sum(F.col("l_quantity").cast("bigint")).cast("double") / F.count(F.lit(1))
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(cents("l_extendedprice")).alias("cents"),
        average.alias("avg_qty"),
    )


HASHED = """select c_custkey, cast(case when h >= 2147483648 then h - 4294967296 else h end
      as integer) as hash from (select c_custkey, (list_reduce(
        list_transform(string_split(c_name, ''), lambda c: unicode(c)::bigint),
        lambda h, c: (h * 31 + c) % 4294967296, 0::bigint) * 23) % 4294967296 as h from customer)"""


@query("udf_hashcode", HASHED)
def udf_hashcode(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", string_hash(F.col("c_name"), 23).alias("hash")
    )


@query("sql_udf_hashcode", HASHED)
def sql_udf_hashcode(spark, folder):
    udf.register_string_hash(spark, "hash_code", 23)
    table(spark, folder, "customer").createOrReplaceTempView("sensor")
    return spark.sql("select c_custkey, hash_code(c_name) as hash from sensor")


AVERAGED = f"""select user_id as id,
  cast(sum({CENTS}) as double) / count(value) as avg_cents from events group by 1"""


@query("udaf_avg", AVERAGED)
def udaf_avg(spark, folder):
    rows = readings(spark, folder).groupBy(F.col("user_id").alias("id"))
    return rows.agg(F.avg("cents").alias("avg_cents"))


@query("sql_udaf_avg", AVERAGED)
def sql_udaf_avg(spark, folder):
    udf.register_average(spark, "avg_temp")
    readings(spark, folder).createOrReplaceTempView("sensor")
    return spark.sql(
        """select user_id as id, avg_temp(sum(cents), count(cents)) as avg_cents
           from sensor group by user_id"""
    )
