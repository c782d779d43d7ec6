"""Rows without a key, a value or a total, in operators over tables and in their stream forms."""

from pyspark.sql import functions as F

from tideline import session
from tideline.functions.records import lowest_record
from tideline.operators import basic, changelog, detect, lateness, rolling, scan, windows
from tideline.session import shared_path
from tideline.streaming.batches import framed_batches, running_batches
from tideline.streaming.run import as_stream, run_bounded

HOUR = 3_600_000_000


def test_a_null_total_never_wins(spark, rows):
    made = [("a", None, 0), ("b", 5, 0), ("c", None, 9000), ("a", 2, 18000)]
    fares = spark.createDataFrame(made, "k string, v bigint, s bigint").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    totals = windows.window_total(fares, ["k"], "ts", "1 hour", "v")
    assert rows(windows.window_winner(totals, "k", "1 hour"), "k", "total") == [("a", 2), ("b", 5)]
    for limit in (1, 1000):
        found = windows.running_winner(totals, "k", HOUR, max_rows=limit)
        assert rows(found, F.hour("window_end"), "k", "total") == [
            (1, "b", 5), (3, "b", 5), (6, "b", 5),
        ]


def test_sums_of_both_signs(spark, rows):
    """Against every key's running sum at every window."""
    made = [(f"k{i % 5}", (i * 37) % 21 - 12, i // 3) for i in range(120)]
    df = spark.createDataFrame(made, "k string, v bigint, h bigint").withColumn(
        "ts", F.timestamp_seconds(F.col("h") * 3600)
    )
    totals = windows.window_total(df, ["k"], "ts", "1 hour", "v")
    expected, sums = [], {}
    for h in range(40):
        for k, v, at in made:
            if at == h:
                sums[k] = sums.get(k, 0) + v
        best = min(sums, key=lambda k: (-sums[k], k))
        expected.append((best, sums[best], (h + 1) * 3600))
    found = windows.running_winner(totals, "k", HOUR, max_rows=20)
    picked = found.select("k", "total", F.unix_seconds(F.col("window_end").cast("timestamp")))
    assert rows(picked) == sorted(expected, key=lambda r: [(False, str(x)) for x in r])


def test_lowest_record_has_a_value(spark, rows):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 3.0, 2), ("a", 3.0, 3), ("b", None, 4)], "k string, v double, seq int"
    )
    found = df.groupBy("k").agg(lowest_record("v", ["seq"], ["v", "seq"], "best"))
    assert rows(found, "k", "best.seq") == [("a", 2), ("b", None)]


def test_rises_without_key_or_value(spark, rows):
    made = [(k, at, at, v) for k in ("a", None) for at, v in [(1, 1.0), (3, 0.5), (20, 2.0), (22, None)]]
    df = spark.createDataFrame(made, "k string, at bigint, seq bigint, v double")
    for limit in (2, 1000):
        found = detect.lasting_rises(df, ["k"], "at", "seq", "v", 5, limit)
        assert rows(found) == [("a", 20, 25)]


def test_patterns_without_user(spark, rows):
    actions = spark.createDataFrame(
        [(None, "login", 1), (None, "pay", 2), ("u", "login", 3), ("u", "pay", 4)],
        "user string, action string, at bigint",
    )
    rules = spark.createDataFrame([("login", "pay", 0)], "action1 string, action2 string, at bigint")
    for mode in ("strict", "reference"):
        found = detect.patterns(actions, rules, "user", "action", "at", mode)
        assert rows(found) == [("u", 4, "login", "pay")]


def test_firings_without_values(spark, rows):
    made = [(0, None, 0), (1, 4.0, 1), (2, None, 2), (3, None, 8), (4, 1.0, 30)]
    df = spark.createDataFrame(made, "seq bigint, v double, s bigint").withColumn(
        "ts", F.timestamp_seconds("s")
    ).withColumn("k", F.lit("x"))
    replayed = lateness.replay(df, ["seq"], "ts", 5_000_000, 0)
    found = lateness.lowest_firings(replayed, ["k"], ["seq"], "v", 5_000_000, ["v"])
    assert rows(found, "start_us", "firing", "record.v") == [(0, "first", 4.0), (30_000_000, "first", 1.0)]


def test_maps_of_a_null_condition(spark, rows):
    df = spark.createDataFrame([(1, 40.0), (2, 10.0), (3, None)], "id int, v double")
    one = {"id": F.col("id"), "m": F.lit("high")}
    assert rows(basic.co_map_split(df, F.col("v") > 30, one, {"id": F.col("id")})) == [
        (1, "high"), (2, None),
    ]
    assert rows(basic.side_outputs(df, {"main": F.col("v") > 30}, "rest"), "id", "output") == [
        (1, "main"), (2, "rest"), (3, "rest"),
    ]


def skewed(spark):
    """Nine rows in ten under one key, null keys and null values."""
    made = [
        (i, "hot" if i % 10 else (None if i % 20 else "cold"), None if i % 7 == 0 else i * 31 % 50)
        for i in range(400)
    ]
    return spark.createDataFrame(made, "seq bigint, k string, v bigint")


def test_streams_equal_tables_with_hot_and_null_keys(spark, rows):
    df = skewed(spark)
    value = F.col("v")
    measures = [
        scan.running_count("n"), scan.running_max("hi", value),
        scan.previous("last", value, ["seq"]), *changelog.measures("v"),
    ]
    path, state = shared_path(spark, "out"), shared_path(spark, "state")
    write = running_batches(["k"], ["seq"], measures, path, state, max_rows=50)
    streamed = run_bounded(as_stream(df, "seq", batches=4), path=path, write=write)
    assert streamed.select("batch").distinct().count() == 4
    table = scan.running(df, ["k"], ["seq"], measures)
    assert rows(streamed, *table.columns) == rows(table)
    reduced = rolling.rolling_reduce(df, ["k"], ["seq"], "v")
    assert rows(streamed, "seq", "k", "hi") == rows(reduced, "seq", "k", "v")


def test_frames_of_streams_with_hot_and_null_keys(spark, rows):
    df = skewed(spark)
    values = {"s": lambda w: F.sum("v").over(w), "c": lambda w: F.count("v").over(w)}
    path, state = shared_path(spark, "out"), shared_path(spark, "state")
    write = framed_batches(["k"], ["seq"], 4, values, "nth", path, state, max_rows=50)
    streamed = run_bounded(as_stream(df, "seq", batches=4), path=path, write=write)
    table = scan.framed(df, ["k"], ["seq"], 4, values, "nth")
    names = ["seq", "k", "v", "nth", "s", "c"]
    assert rows(streamed, *names) == rows(table, *names)


def test_stored_tables_can_be_discarded(spark):
    kept = session.stored(spark.range(3).toDF("x"), "kept")
    path = session._made[-1]
    assert kept.count() == 3 and spark.read.parquet(path).count() == 3
    before, session._made[:] = list(session._made), [path]
    try:
        assert session.discard(spark) == 1
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    finally:
        session._made[:] = before[:-1]
