"""Stateful processors on real streams, one file per micro-batch."""

import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tideline.functions.time import event_time
from tideline.operators import basic, changelog, detect, rolling, scan, windows
from tideline.operators.parse import parse_sensor
from tideline.sinks.tables import KeyValueTable, SeenKeys, batch_writer, stream_csv
from tideline.sources import files
from tideline.streaming import processors as p
from tideline.streaming.batches import running_batches
from tideline.streaming import run
from tideline.streaming.run import as_stream, batch_folder, final_rows, run_bounded, settle

BASE = 1599990000


def write_files(folder, *batches):
    """One text file per batch, in the order in which the stream must read them."""
    folder.mkdir(exist_ok=True)
    for number, batch in enumerate(batches):
        (folder / f"{number:03}.txt").write_text("".join(line + "\n" for line in batch))
        time.sleep(0.02)
    return str(folder)


def sensor_stream(spark, path):
    parsed = parse_sensor(files.stream_text_lines(spark, path))
    return parsed.withColumn("ts", event_time(F.col("timestamp")))


def test_lateness_with_the_watermark_of_the_stream(spark, tmp_path, rows):
    """Allowed lateness, updates and side output; one row per micro-batch after the first."""
    line = lambda k, at, v: f"{k},{BASE + at}000,{v}"
    first = [line("sensor_1", 791, v) for v in (1, 1.1, 1.2)]
    first += [line("sensor_2", 791, v) for v in (2, 2.1, 2.2)]
    path = write_files(
        tmp_path / "in", first, [line("sensor_3", 795, 3)], [line("sensor_4", 796, 4.0)],
        [line("sensor_1", 790, -1.0)], [line("sensor_5", 797, 5.0)], [line("sensor_2", 790, -2.0)],
        [line("sensor_6", 798, 6.0)], [line("sensor_3", 790, -3.0)],
    )
    rows_in = sensor_stream(spark, path).withWatermark("ts", "1 second")
    keyed = p.keyed(
        rows_in.withColumn("seq", F.col("timestamp")), ["id"],
        p.LowestWindows("timestamp", "seq", "temperature", 5000, 2000),
        "id string, start_ms bigint, end_ms bigint, firing string, seq bigint, value double,"
        " watermark_ms bigint",
        "processingTime",
    )
    out = run_bounded(keyed, timers=True, wait=2.0, rows=13)
    closed = out.filter(F.col("end_ms") == (BASE + 795) * 1000)
    got = rows(closed, "id", "firing", "value", F.col("watermark_ms") - BASE * 1000)
    assert got == sorted(
        [
            ("sensor_1", "first", 1.0, 794999), ("sensor_2", "first", 2.0, 794999),
            ("sensor_1", "update", -1.0, 794999), ("sensor_2", "update", -2.0, 795999),
            ("sensor_3", "late", -3.0, 796999),
        ],
        key=lambda r: [(x is None, str(x)) for x in r],
    )


def test_dedup_by_the_clock(spark, tmp_path):
    folder = tmp_path / "in"
    path = write_files(folder, ["k,a", "k,b", "l,c"])
    pairs = files.stream_text_lines(spark, path).select(
        F.split("value", ",")[0].alias("key"), F.split("value", ",")[1].alias("value")
    )
    kept = p.keyed(
        pairs, ["key"], p.DedupClock("value", "value", 3000), "line string", "processingTime"
    )
    out = str(tmp_path / "out")
    query = (
        kept.writeStream.option("checkpointLocation", str(tmp_path / "check"))
        .foreachBatch(batch_folder(out)).start()
    )
    try:
        settle(query, 3)
        (folder / "001.txt").write_text("l,d\n")
        time.sleep(5)
        (folder / "002.txt").write_text("k,e\n")
        settle(query, 5)
    finally:
        query.stop()
    lines = [r.line for r in spark.read.parquet(out).select("line").collect()]
    assert {"k$$a", "l$$c", "k$$e"} <= set(lines) and "k$$b" not in lines


def test_rise_by_the_clock(spark, tmp_path, rows):
    path = write_files(
        tmp_path / "in", ["up,1,1.0", "down,1,5.0", "flat,1,-1.0"], ["up,2,2.0", "down,2,4.0"]
    )
    found = p.keyed(
        parse_sensor(files.stream_text_lines(spark, path)), ["id"],
        p.RiseClock("timestamp", "temperature", 6), "id string, message string", "processingTime",
    )
    out = run_bounded(found, timers=True, wait=12.0, rows=5)
    assert rows(out, "id", "message") == [("up", "values of up did not fall for 6 s")]


def test_timer_and_length(spark, tmp_path, rows):
    path = write_files(tmp_path / "in", ["sensor_1,1,1.0", "sensor_1,2,1.0", "s,1,1"])
    echoed = p.keyed(
        parse_sensor(files.stream_text_lines(spark, path)), ["id"], p.EchoLength("timestamp", 1),
        "id string, kind string, value bigint", "processingTime",
    )
    out = run_bounded(echoed, timers=True, wait=4.0, rows=3)
    assert rows(out.filter("kind = 'length'"), "id", "value") == [
        ("s", 1), ("sensor_1", 8), ("sensor_1", 8),
    ]
    assert rows(out.filter("kind = 'timer'"), "id") == [("s",), ("sensor_1",)]


def test_fold_as_reducing_state(spark, tmp_path, rows):
    path = write_files(tmp_path / "in", ["a,1,3", "a,2,1"], ["a,3,9", "b,4,2"])
    folded = p.keyed(
        parse_sensor(files.stream_text_lines(spark, path)), ["id"],
        p.Fold("timestamp", "temperature", "double", max), "id string, seq bigint, value double",
    )
    assert rows(run_bounded(folded), "id", "seq", "value") == [
        ("a", 1, 3.0), ("a", 2, 3.0), ("a", 3, 9.0), ("b", 4, 2.0),
    ]


def test_state_survives_a_restart(spark, tmp_path, rows):
    """Stop, add input, start again: counts go on, nothing is lost or read twice."""
    folder = tmp_path / "in"
    path = write_files(folder, ["a,1,1", "b,2,1"], ["a,3,1"])
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        counted = p.keyed(
            parse_sensor(files.stream_text_lines(spark, path)), ["id"],
            p.RunningCount("timestamp"), "id string, seq bigint, n bigint",
        )
        return run_bounded(counted, checkpoint=check, path=out)

    assert rows(run(), "id", "seq", "n") == [("a", 1, 1), ("a", 3, 2), ("b", 2, 1)]
    time.sleep(0.02)
    (folder / "009.txt").write_text("a,4,1\nb,5,1\n")
    again = [("a", 1, 1), ("a", 3, 2), ("a", 4, 3), ("b", 2, 1), ("b", 5, 2)]
    assert rows(run(), "id", "seq", "n") == again
    assert rows(run(), "id", "seq", "n") == again


def test_two_stage_window_on_a_stream(spark, tmp_path, rows):
    line = lambda k, at, v: f"{k},{BASE + at}000,{v}"
    path = write_files(
        tmp_path / "in", [line("a", 791, 1), line("a", 792, 2), line("b", 791, 2)],
        [line("b", 796, 7), line("a", 797, 1)], [line("end", 900, 0)], [line("end", 990, 0)],
    )
    timed = sensor_stream(spark, path).withWatermark("ts", "2 seconds")
    totals = windows.window_total(timed, ["id"], "ts", "5 seconds", "temperature")
    out = run_bounded(windows.window_winner(totals, "id", "5 seconds"))
    found = out.filter("id <> 'end'").select("id", "total", F.unix_seconds("window_end") - BASE)
    assert rows(found) == [("a", 3.0, 795), ("b", 7.0, 800)]


def test_idle_input_does_not_hold_the_watermark_back(spark, tmp_path):
    """Two inputs, one without new rows: with the policy `max` windows still close."""
    line = lambda k, at, v: f"{k},{BASE + at}000,{v}"
    busy = write_files(tmp_path / "busy", [line("a", 791, 1)], [line("a", 990, 1)], [line("a", 999, 1)])
    idle = write_files(tmp_path / "idle", [line("b", 791, 5)])
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    try:
        both = [sensor_stream(spark, x).withWatermark("ts", "2 seconds") for x in (busy, idle)]
        sums = windows.window_total(both[0].union(both[1]), ["id"], "ts", "5 seconds", "temperature")
        out = run_bounded(sums)
        closed = out.filter(F.unix_seconds("window.end") == BASE + 795)
        assert {r.id: r.total for r in closed.collect()} == {"a": 1.0, "b": 5.0}
    finally:
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")


def test_updating_result_cannot_be_appended(spark, tmp_path):
    path = write_files(tmp_path / "in", ["a,1,1"])
    counted = parse_sensor(files.stream_text_lines(spark, path)).groupBy("id").count()
    with pytest.raises(AnalysisException):
        stream_csv(counted, str(tmp_path / "out"), ["id", "n"], str(tmp_path / "check"))


def test_csv_sink_on_a_stream(spark, tmp_path, rows):
    path = write_files(tmp_path / "in", ["a,1,1.5"], ["b,2,2.5"])
    table = files.stream_csv_table(spark, path, "id string, ts bigint, temp double", "in_table")
    assert spark.table("in_table").isStreaming
    query = stream_csv(
        table.select("id", "temp"), str(tmp_path / "out"), ["id", "temperature"],
        str(tmp_path / "check"),
    )
    query.processAllAvailable()
    query.stop()
    found = files.csv_table(spark, str(tmp_path / "out"), "id string, temperature double")
    assert rows(found) == [("a", 1.5), ("b", 2.5)]


def test_keyed_state_needs_a_key(spark):
    with pytest.raises(ValueError):
        p.keyed(spark.range(1), [], p.RunningCount("id"), "n bigint")


def test_update_mode_and_final_rows(spark, rows):
    words = spark.createDataFrame(
        [(0, "a"), (1, "b"), (2, "a"), (3, "a"), (4, "b")], "seq bigint, word string"
    )
    counted = as_stream(words, "seq", batches=3).groupBy("word").count()
    out = run_bounded(counted, mode="update")
    assert out.count() > 2
    assert rows(final_rows(out, ["word"])) == [("a", 3), ("b", 2)]


def test_control_stream_with_two_inputs(spark, rows):
    words = spark.createDataFrame([("a", 1), ("a", 5), ("a", 6), ("b", 2)], "word string, at bigint")
    control = spark.createDataFrame([("a", 5)], "word string, at bigint")
    both = as_stream(basic.connect(control, words), "at", batches=2)
    kept = p.keyed(both, ["word"], p.ControlFilter("at"), "word string, at bigint")
    assert rows(run_bounded(kept), "word", "at") == [("a", 1), ("a", 5), ("b", 2)]


def test_upserts_and_seen_keys_in_micro_batches(spark, tmp_path, rows):
    """A batch that is run again changes nothing."""
    made = [[("a", 0, 1.0), ("b", 1, 2.0), ("a", 2, 3.0)], [("b", 3, 4.0), ("c", 4, 5.0)]]
    batches = [spark.createDataFrame(b, "id string, seq bigint, v double") for b in made]
    store = KeyValueTable(str(tmp_path / "kv"), ["id"], ["seq"])
    seen = SeenKeys(str(tmp_path / "seen"), ["id"], ["seq"])
    first = []

    def write(batch, batch_id):
        store.upsert(batch, batch_id)
        first.append(rows(seen.first_seen(batch, batch_id)))

    for n in (0, 1, 1, 0):
        batch_writer(write)(batches[n], n)
    assert rows(store.read(spark), "id", "v") == [("a", 3.0), ("b", 4.0), ("c", 5.0)]
    folded = store.compact(spark, str(tmp_path / "kv2"), 1)
    assert rows(folded.read(spark), "id", "v") == rows(store.read(spark), "id", "v")
    ab, c = [("a", 0, 1.0), ("b", 1, 2.0)], [("c", 4, 5.0)]
    assert first[0] == ab and first[1] == c and first[2] == c
    later = SeenKeys(str(tmp_path / "seen"), ["id"], ["seq"], run="second")
    assert rows(later.first_seen(batches[1], 0)) == []



def test_hot_key_over_micro_batches(spark, tmp_path, rows):
    """Running values of a hot key, in segments within a batch and carried from batch to batch."""
    made = [
        (n, "hot" if n % 3 == 0 else ("cold" if n % 3 == 1 else None), n * 7 % 11)
        for n in range(300)
    ]
    df = spark.createDataFrame(made, "seq bigint, key string, v bigint")
    value = F.col("v")
    measures = [
        scan.running_sum("s", value), scan.running_count("n"), scan.running_max("hi", value),
        scan.previous("last", value, ["seq"]), scan.running_min("lo", value, inclusive=False),
    ]
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = running_batches(["key"], ["seq"], measures, path, state, max_rows=10)
    stream = as_stream(df, "seq", batches=3)
    out = run_bounded(stream, path=path, write=write)
    expected = scan.running(df, ["key"], ["seq"], measures)
    assert out.select("batch").distinct().count() == 3
    assert rows(out, *expected.columns) == rows(expected)
    # a batch that is run again writes the same rows
    before = rows(out.filter("batch = 2"), *expected.columns)
    last = {r.seq for r in out.filter("batch = 2").select("seq").collect()}
    write(spark.createDataFrame([m for m in made if m[0] in last], df.schema), 2)
    assert rows(spark.read.parquet(path).filter("batch = 2"), *expected.columns) == before


def test_keyed_state_equals_the_scans(spark, rows):
    """Processors for keys that are not hot, against the operators over tables."""
    made = [(i, f"k{i % 4}", (i * 37) % 50) for i in range(60)]
    df = spark.createDataFrame(made, "seq bigint, k string, v bigint").withColumn(
        "x", F.col("v").cast("double")
    )
    run = lambda processor, schema: run_bounded(
        p.keyed(as_stream(df, "seq"), ["k"], processor, schema)
    ).drop("batch")
    jumps = run(p.Jump("seq", "x", 20.0), "k string, seq bigint, last double, current double")
    assert rows(jumps, "k", "seq", "last", "current") == rows(
        detect.jumps(df, ["k"], ["seq"], "x", 20.0), "k", "seq", "last", "current"
    )
    log = run(
        p.Changelog("seq", "v"), "k string, seq bigint, op boolean, cnt bigint, total bigint"
    )
    names = ["seq", "op", "k", "cnt", "total"]
    assert rows(log, *names) == rows(
        changelog.retract_changelog(df, ["k"], ["seq"], "v"), *names
    )
    fired = run(p.CountWindow("seq", "v", 10, 2), "k string, seq bigint, total bigint, n bigint")
    names = ["k", "seq", "total", "n"]
    assert rows(fired, *names) == rows(
        rolling.count_window(df, ["k"], ["seq"], 10, 2, "v"), *names
    )
    text = df.select("seq", "k", F.col("v").cast("string").alias("v"))
    pairs = p.keyed(
        as_stream(text, "seq"), ["k"], p.Previous("seq", "v"),
        "k string, seq bigint, last string, current string",
    )
    last = {}
    expected = []
    for seq, k, v in made:
        if k in last:
            expected.append((k, seq, last[k], str(v)))
        last[k] = str(v)
    assert sorted(map(tuple, run_bounded(pairs).drop("batch").collect())) == sorted(expected)


def test_a_table_with_long_texts_is_dealt_to_more_files(spark, tmp_path, rows, monkeypatch):
    """Few rows, many bytes: no task gets more than the bytes of a file, and batches stay as they are."""
    paths = iter([str(tmp_path / "in"), *[str(tmp_path / f"more{n}") for n in range(9)]])
    monkeypatch.setattr(run, "shared_path", lambda spark, name: next(paths))
    monkeypatch.setattr(run, "BYTES_PER_FILE", 10_000, raising=False)
    table = spark.range(120).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    stream = as_stream(table, "id")
    assert len(list((tmp_path / "in").glob("part-*"))) == 12
    out = run_bounded(stream)
    assert out.count() == 120 and out.select("batch").distinct().count() == 3
    assert rows(out, "id") == rows(table, "id")
