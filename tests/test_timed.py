"""State that is written as changes, and the operators over time that keep it between micro-batches."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tideline.functions import accumulate
from tideline.operators import dedup, detect, lateness, scan, windows
from tideline.sinks.tables import SeenKeys
from tideline.streaming import timed
from tideline.streaming.run import as_slices, as_stream, run_bounded
from tideline.streaming.state import KeyedState, Watermarks

HOUR = 3_600_000_000
STATE = "k string, v bigint"


def size(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))


def as_dict(df):
    return {r.k: r.v for r in df.collect()}


def test_state_is_that_of_the_last_changes(spark, tmp_path):
    """Random changes and removals against a dictionary, over several sizes of runs."""
    table, draw, model = KeyedState(str(tmp_path), ["k"], fan=2, rows_per_bucket=4), random.Random(1), {}
    schema = spark.createDataFrame([], STATE).schema
    for n in range(9):
        assert as_dict(table.before(spark, n, schema)) == model
        asked = draw.sample("abcdefghij", 4)
        keys = spark.createDataFrame([(k,) for k in asked], "k string")
        assert as_dict(table.before(spark, n, schema, keys)) == {k: model[k] for k in asked if k in model}
        table.prune(spark, n)
        left = {p.name for p in tmp_path.glob("run=*")}
        assert left == {f"run={a}-{b}" for a, b in table.runs(n)}
        changes = {k: (draw.randrange(100), draw.random() < 0.3) for k in [*draw.sample("abcdefgh", 5), None]}
        rows = [(k, v, gone) for k, (v, gone) in changes.items()]
        table.write(spark.createDataFrame(rows, f"{STATE}, _gone boolean"), n, len(rows))
        for k, (v, gone) in changes.items():
            model.pop(k, None) if gone else model.update({k: v})


def test_runs_cover_all_batches():
    table = KeyedState("", ["k"], fan=4)
    assert table.runs(0) == [] and table.runs(13) == [(0, 4), (4, 8), (8, 12), (12, 13)]
    for n in range(1, 300):
        runs = table.runs(n)
        assert [a for a, _ in runs] == [0, *[b for _, b in runs[:-1]]] and runs[-1][1] == n
        assert len(runs) <= 3 * 5


def test_idle_keys_are_not_written_again(spark, tmp_path):
    """A million keys that nothing happens to, and batches of a hundred keys."""
    table, schema = KeyedState(str(tmp_path), ["k"]), spark.createDataFrame([], STATE).schema
    idle = spark.range(1_000_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    table.write(idle, 0, 1_000_000)
    first = size(tmp_path)
    for n in range(1, 6):
        some = spark.range(100).select((F.col("id") * n).cast("string").alias("k"), F.lit(-n).cast("long").alias("v"))
        before = table.before(spark, n, schema, some.select("k"))
        assert before.count() == 100
        table.write(some, n, 100)
    assert size(tmp_path) - first < first / 100
    got = as_dict(table.before(spark, 6, schema).filter("v <= 0 or k = '999999'"))
    assert got["999999"] == 999_999 and got["495"] == -5 and got["7"] == -1


def test_few_keys_read_few_folders(spark, tmp_path):
    table, schema = KeyedState(str(tmp_path), ["k"], rows_per_bucket=100), spark.createDataFrame([], STATE).schema
    table.write(spark.range(6400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")), 0, 6400)
    keys = spark.createDataFrame([("17",), ("4711",)], "k string")
    found = table.before(spark, 1, schema, keys)
    assert as_dict(found) == {"17": 17, "4711": 4711}
    touched = table._touched(spark, table.runs(1), keys)
    read = table._read(spark, table.runs(1), schema).filter(touched).select(F.input_file_name()).distinct()
    assert read.count() <= 2 < len(list(tmp_path.rglob("*.parquet")))


def test_watermarks_of_batches(spark, tmp_path):
    marks, col = Watermarks(str(tmp_path), 10), F.col("us")
    batch = lambda *us: spark.createDataFrame([(u,) for u in us], "us bigint")
    assert marks.advance(batch(None), col, 0) == (None, None)
    assert marks.advance(batch(50, None, 30), col, 1) == (None, 40)
    assert marks.advance(batch(20), col, 2) == (40, 40)
    assert marks.advance(batch(60), col, 3) == marks.advance(batch(60), col, 3) == (40, 50)
    assert len(list(tmp_path.glob("batch=*"))) == 2


def test_late_windows(spark, tmp_path, rows):
    """First firing, update by a late row, an update of a window without rows on time, too late rows."""
    measures = [scan.running_sum("total", F.col("v")), scan.running_count("n")]
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = timed.window_batches(["k"], "us", 10, 2, 5, measures, path, state)
    batches = [
        [("a", 1, 1), ("a", 9, 2), ("b", 3, None), (None, 4, 7), ("a", None, 9)], [("b", 12, 5)],
        [("a", 2, 4), ("c", 5, 8), ("a", 11, 1)], [("z", 17, 1), ("a", 3, 100)], [("a", 4, 50)],
    ]
    made = [spark.createDataFrame(b, "k string, us bigint, v bigint") for b in batches]
    for n in (0, 1, 1, 2, 3, 4, 4):
        write(made[n], n)
    fired = spark.read.parquet(f"{path}/firings").filter("end_us = 10")
    assert rows(fired, "k", "firing", "total", "n", "batch") == sorted([
        ("a", "first", 3, 2, 1), ("b", "first", None, 1, 1), (None, "first", 7, 1, 1),
        ("a", "update", 7, 3, 2), ("c", "update", 8, 1, 2), ("a", "update", 107, 4, 3),
    ], key=lambda r: [(x is None, str(x)) for x in r])
    assert rows(spark.read.parquet(f"{path}/late"), "k", "us", "v", "batch") == [("a", 4, 50, 4)]
    # the window is over, and its state is gone
    open_windows = KeyedState(f"{state}/windows", ["k", "end_us"])
    schema = spark.createDataFrame([], "k string, end_us bigint, total bigint, n bigint, fired boolean").schema
    assert rows(open_windows.before(spark, 5, schema), "k", "end_us") == [
        ("a", 20), ("b", 20), ("z", 20),
    ]


def test_a_batch_of_windows_takes_no_more_tasks_than_its_rows_need(spark, tmp_path):
    """As many windows as shuffle partitions, yet a few files: empty and tiny partitions are put together."""
    path = str(tmp_path / "out")
    measures = [scan.running_count("n")]
    write = timed.window_batches(["k"], "us", 10, 2, 5, measures, path, str(tmp_path / "state"))
    rows = spark.range(900).select(F.lit("a").alias("k"), (F.col("id") * 10).alias("us"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        write(rows, 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    fired = f"{path}/firings/batch=0"
    assert spark.read.parquet(fired).count() == 898  # two windows are still open
    assert len(list((tmp_path / "out/firings/batch=0").glob("part-*"))) <= 10


def test_sessions_that_a_late_row_joins(spark, tmp_path, rows):
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = timed.session_batches(
        ["k"], "us", 10, 20, path, state, total=(F.sum("v"), "sum"), high=(F.max("v"), "max")
    )
    batches = [
        [("a", 5, 1), ("a", 30, 2), ("b", 7, 3)], [("a", 18, 4), ("b", 7, 1)],
        [("a", 15, 8), ("a", 24, 16), (None, 3, 1), ("a", None, 1)],  # joins all three
        [("c", 200, 1), ("b", 3, 5)], [("b", 9, 100), ("c", 215, 2)], [("c", 999, 0)],
    ]
    made = [spark.createDataFrame(b, "k string, us bigint, v bigint") for b in batches]
    for n in (0, 1, 2, 2, 3, 4, 5):
        write(made[n], n)
    out = spark.read.parquet(path)
    assert rows(out, "k", "first", "last", "n", "total", "high", "batch") == [
        ("a", 5, 30, 5, 31, 16, 3), ("b", 3, 7, 3, 9, 5, 3),
        ("c", 200, 200, 1, 1, 1, 5), ("c", 215, 215, 1, 2, 2, 5),
    ]


def hot(spark, n=400, seed=3):
    """Nine rows in ten are of one key; times go up with the order of arrival."""
    draw, at, made = random.Random(seed), 0, []
    for seq in range(n):
        at += draw.choice([0, 1, 2, 5, 40])
        key = "hot" if draw.random() < 0.9 else draw.choice(["x", "y"])
        made.append((seq, key, at, float(draw.randrange(4))))
    return spark.createDataFrame(made, "seq bigint, k string, us bigint, v double").withColumn(
        "ts", F.timestamp_micros("us")
    )


def by_batches(spark, df, write, cuts=3):
    last = df.agg(F.max("seq")).first()[0] + 1
    for n in range(cuts):
        write(df.filter((F.col("seq") >= n * last // cuts) & (F.col("seq") < (n + 1) * last // cuts)), n)


@pytest.mark.parametrize("max_rows", [10, 10_000])
def test_expiry_with_a_hot_key(spark, tmp_path, rows, max_rows):
    df, path = hot(spark), str(tmp_path / "out")
    nulls = spark.createDataFrame([(50, None, 3, 1.0, None), (51, "x", None, 1.0, None)], df.schema)
    df = df.unionByName(nulls)
    write = timed.dedup_batches(["k"], "us", 30, ["seq"], path, str(tmp_path / "state"), max_rows)
    by_batches(spark, df, write)
    expected = dedup.dedup_ttl(df, ["k"], "ts", ["seq"], ["seq", "v"], 30, max_rows)
    assert rows(spark.read.parquet(path), "k", "seq", "v") == rows(expected)
    assert expected.filter("k = 'hot'").count() > 20 and expected.filter("k is null").count() == 0


@pytest.mark.parametrize("max_rows", [10, 10_000])
def test_armed_alerts_with_a_hot_key(spark, tmp_path, rows, max_rows):
    df, path = hot(spark, seed=8), str(tmp_path / "out")
    write = timed.rise_batches(
        ["k"], "us", "seq", "v", 25, 0, path, str(tmp_path / "state"), max_rows
    )
    by_batches(spark, df, write, 4)
    far = spark.createDataFrame([(9999, None, 10**9, None, None)], df.schema)
    write(far, 4)
    expected = detect.lasting_rises(df, ["k"], "us", "seq", "v", 25, max_rows)
    found = spark.read.parquet(path)
    assert rows(found, "k", "armed_at", "alert_at") == rows(expected)
    assert found.filter("k = 'hot'").count() > 5
    assert found.select("batch").distinct().count() > 2


@pytest.mark.parametrize("max_rows", [10, 10_000])
def test_sessions_with_a_hot_key(spark, tmp_path, rows, max_rows):
    df, path = hot(spark, seed=5), str(tmp_path / "out")
    write = timed.session_batches(["k"], "us", 20, 0, path, str(tmp_path / "state"), max_rows)
    by_batches(spark, df, write)
    write(spark.createDataFrame([(9999, None, 10**9, None, None)], df.schema), 3)
    expected = windows.sessions(df, ["k"], "ts", 20, max_rows).select(
        "k", F.unix_micros("session_start"), F.unix_micros("session_end") - 20, "n"
    ) if dict(windows.sessions(df, ["k"], "ts", 20).dtypes)["session_start"] == "timestamp" else (
        windows.sessions(df, ["k"], "ts", 20, max_rows).select(
            "k", F.unix_micros(F.col("session_start").cast("timestamp")),
            F.unix_micros(F.col("session_end").cast("timestamp")) - 20, "n",
        )
    )
    assert rows(spark.read.parquet(path), "k", "first", "last", "n") == rows(expected)


def test_rules_that_arrive_later(spark, tmp_path, rows):
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    schema = "input int, at bigint, action1 string, action2 string, user string, action string"
    do = lambda at, user, action: (2, at, None, None, user, action)
    rule = lambda at, a, b: (1, at, a, b, None, None)
    batches = [
        [do(1, "u", "in"), do(2, "u", "out"), rule(3, "in", "out"), do(4, "v", "in")],
        [do(5, "v", "out"), rule(6, "out", "in"), do(7, "u", "in"), rule(8, None, "in")],
        [do(9, "v", "in"), rule(10, "in", "out"), do(11, "u", "out"), do(12, None, "out")],
    ]
    write = timed.pattern_batches("user", "action", "at", path, state)
    for n in (0, 1, 1, 2):
        write(spark.createDataFrame(batches[n], schema), n)
    assert rows(spark.read.parquet(path), "user", "at", "action1", "action2") == [
        ("u", 11, "in", "out"), ("u", 7, "out", "in"), ("v", 5, "in", "out"), ("v", 9, "out", "in"),
    ]


def test_a_stream_broken_off_goes_on(spark, tmp_path, rows, monkeypatch):
    """Batch 1 has written its output but not its state when the query dies; it is started again."""
    df, check = hot(spark, 120), str(tmp_path / "check")
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream = as_stream(df, "seq", batches=4)
    write = timed.dedup_batches(["k"], "us", 30, ["seq"], path, state)
    whole, died = KeyedState.write, []

    def dies(self, changes, batch_id, most):
        if batch_id == 1 and not died:
            died.append(batch_id)
            raise RuntimeError("lost")
        whole(self, changes, batch_id, most)

    monkeypatch.setattr(KeyedState, "write", dies)
    with pytest.raises(Exception, match="lost"):
        run_bounded(stream, checkpoint=check, path=path, write=write)
    out = run_bounded(stream, checkpoint=check, path=path, write=write)
    assert died == [1]
    expected = dedup.dedup_ttl(df, ["k"], "ts", ["seq"], ["seq"], 30)
    assert rows(out, "k", "seq") == rows(expected, "k", "seq")
    # started once more, there is nothing to do
    assert rows(run_bounded(stream, checkpoint=check, path=path, write=write), "k", "seq") == rows(
        expected, "k", "seq"
    )


def test_state_folders_go(spark, tmp_path):
    df, state = hot(spark, 200), str(tmp_path / "state")
    write = timed.dedup_batches(["k"], "us", 30, ["seq"], str(tmp_path / "out"), state)
    by_batches(spark, df, write, 10)
    names = {p.name for p in Path(state).glob("run=*")}
    assert names == {"run=0-8", "run=8-9", "run=9-10"}


def test_slices_are_batches(spark, rows):
    df = spark.createDataFrame([(n, n // 7) for n in range(20)], "n bigint, s bigint")
    out = run_bounded(as_slices(df, "s"))
    assert rows(out, "n", "batch") == sorted(((n, n // 7) for n in range(20)), key=lambda r: [(False, str(x)) for x in r])


def test_slices_of_several_files(spark, rows, monkeypatch):
    """A small slice has as many files as a large one, some of them empty."""
    monkeypatch.setattr("tideline.streaming.run.ROWS_PER_FILE", 10)
    df = spark.createDataFrame([(n, 0 if n == 0 else 1 + n // 40) for n in range(70)], "n bigint, s bigint")
    out = run_bounded(as_slices(df, "s"))
    got = {(r.n, r.batch) for r in out.collect()}
    assert got == {(n, 0 if n == 0 else 1 + n // 40) for n in range(70)}


def test_a_null_key_is_seen_once(spark, tmp_path, rows):
    batches = [[(None, 0), ("a", 1)], [(None, 2), ("b", 3)]]
    seen = SeenKeys(str(tmp_path), ["id"], ["seq"])
    found = [
        rows(seen.first_seen(spark.createDataFrame(b, "id string, seq bigint"), n))
        for n, b in enumerate(batches)
    ]
    assert found == [[("a", 1), (None, 0)], [("b", 3)]]


def longest():
    """An accumulator of the test's own: the longest text and how often it came."""

    class Longest(accumulate.Accumulator):
        state = output = "text string, times bigint"

        def create(self):
            return None, 0

        def add(self, state, row):
            return self.merge(state, (row[0], 0 if row[0] is None else 1))

        def merge(self, one, other):
            best = max((x[0] for x in (one, other) if x[0] is not None), key=lambda t: (len(t), t), default=None)
            return best, sum(x[1] for x in (one, other) if x[0] == best)

        def result(self, state):
            return state

    return Longest()


def test_accumulators_of_a_hot_key(spark, rows):
    draw = random.Random(4)
    made = [("hot" if draw.random() < 0.9 else draw.choice([None, "x"]), "ab" * draw.randrange(4), n % 7 or None)
            for n in range(500)]
    df = spark.createDataFrame(made, "k string, word string, v bigint").repartition(16)
    found = accumulate.aggregated(df, ["k"], ["word"], longest(), fan=2, max_held=1)
    got = {r[0]: (r[1], r[2]) for r in found.collect()}
    for key in ("hot", "x", None):
        words = [w for k, w, _ in made if k == key]
        best = max(words, key=lambda t: (len(t), t))
        assert got[key] == (best, words.count(best))
    mean = {r.k: r.mean for r in accumulate.aggregated(df, ["k"], ["v"], accumulate.Mean()).collect()}
    values = [v for k, _, v in made if k == "hot" and v is not None]
    assert mean["hot"] == sum(values) / len(values)
    assert accumulate.aggregated(df.limit(0), ["k"], ["v"], accumulate.Mean()).count() == 0
    nothing = df.withColumn("v", F.lit(None).cast("bigint"))
    assert {r.mean for r in accumulate.aggregated(nothing, ["k"], ["v"], accumulate.Mean()).collect()} == {None}


def test_no_bound_and_no_lateness(spark):
    """With a bound of zero a row that is not the newest can be late at once."""
    df = spark.createDataFrame([(0, 10), (1, 21), (2, 9), (3, 20), (4, 19)], "n bigint, us bigint")
    df = df.withColumn("ts", F.timestamp_micros("us"))
    got = {r.n: r.fate for r in lateness.replay(df, ["n"], "ts", 10, 0).collect()}
    assert got == {0: "on time", 1: "on time", 2: "too late", 3: "on time", 4: "too late"}


def test_a_source_that_is_idle(spark):
    """The slow source holds the watermark back until it has been quiet for long enough."""
    made = [(0, "a", 0, 10), (1, "b", 1, 3), (2, "a", 2, 20), (3, "a", 5, 30), (4, "a", 8, 40), (5, "b", 9, 12),
            (6, "c", 10, 99), (7, None, 10, 99), (8, "a", 10, None)]
    df = spark.createDataFrame(made, "n bigint, s string, at bigint, us bigint").select(
        "n", "s", F.timestamp_micros("at").alias("at"), F.timestamp_micros("us").alias("ts")
    )
    seen = lateness.merged_watermarks(df, ["n"], "at", "ts", "s", ["a", "b"], 0, 4)
    got = {r.n: (r.before_us, r.after_us) for r in seen.collect()}
    assert got == {
        0: (None, None), 1: (None, 3), 2: (3, 3), 3: (3, 3), 4: (3, 40), 5: (40, 40), 6: (40, 40),
        7: (40, 40), 8: (40, 40),
    }


def test_ticks(spark):
    made = [(0, 1, 50), (1, 9, 70), (2, 12, 10), (3, 19, 90), (4, 35, 20), (5, None, 500)]
    df = spark.createDataFrame(made, "n bigint, at bigint, us bigint").select(
        "n", F.timestamp_micros("at").alias("at"), F.timestamp_micros("us").alias("ts")
    )
    seen = lateness.periodic_watermarks(df, "at", "ts", 10, 5)
    got = {r.n: (r.before_us, r.after_us) for r in seen.collect()}
    assert got == {0: (None, 65), 1: (None, 65), 2: (65, 85), 3: (65, 85), 4: (85, 85), 5: (None, None)}
