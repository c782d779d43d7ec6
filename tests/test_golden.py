"""Small traces with known results."""

import pytest
from pyspark.sql import functions as F

from tideline.functions.time import SECOND, event_time
from tideline.operators import changelog, lateness, parse, rolling, windows

BASE = 1599990000


def lines(*groups):
    """("sensor_1", (1, 1.1), 791) -> lines `sensor_1,1599990791000,1` and so on."""
    return [f"{k},{BASE + at}000,{v}" for k, values, at in groups for v in values]


TIPS = lines(
    ("sensor_1", (1, 1.1, 1.2), 791), ("sensor_2", (2, 2.1, 2.2), 791),
    ("sensor_2a", (2.1, 2.1, 2.2), 791), ("sensor_3", (3, 3.1, 3.2), 795),
    ("sensor_4", (4, 4.1, 4.2), 796), ("sensor_5", (5,), 797), ("sensor_6", (6,), 798),
    ("sensor_7", (7,), 799), ("sensor_8", (8,), 801), ("sensor_9", (9,), 802),
    ("sensor_10", (10,), 803), ("sensor_11", (11,), 804),
)


@pytest.fixture(scope="module")
def totals(spark):
    fares = parse.parse_fare(spark.createDataFrame([(line,) for line in TIPS], "value string"))
    timed = fares.withColumn("ts", event_time(F.col("timeStamp")))
    return windows.window_total(timed, ["driverId"], "ts", "5 seconds", "fares")


def end_of(column="window_end"):
    return (F.unix_seconds(F.col(column)) - BASE).alias("end")


def test_totals_per_driver(totals):
    found = {
        (r.driverId, r.end): r.total
        for r in totals.select("driverId", "total", end_of("window.end")).collect()
    }
    assert dict(totals.dtypes)["total"] == "float"
    assert found == {
        ("sensor_1", 795): pytest.approx(3.3), ("sensor_2", 795): pytest.approx(6.3),
        ("sensor_2a", 795): pytest.approx(6.3999996, abs=1e-7),
        ("sensor_3", 800): pytest.approx(9.3), ("sensor_4", 800): pytest.approx(12.3),
        ("sensor_5", 800): 5.0, ("sensor_6", 800): 6.0, ("sensor_7", 800): 7.0,
        ("sensor_8", 805): 8.0, ("sensor_9", 805): 9.0, ("sensor_10", 805): 10.0,
        ("sensor_11", 805): 11.0,
    }


def test_float_total_is_the_float32_one(totals):
    best = totals.filter("driverId = 'sensor_2a'").select(F.col("total").cast("string"))
    assert best.first()[0] == "6.3999996"


def test_winner_per_window(totals, rows):
    found = windows.window_winner(totals, "driverId", "5 seconds")
    assert rows(found.select("driverId", F.round("total", 4).cast("string"), end_of())) == [
        ("sensor_11", "11.0", 805), ("sensor_2a", "6.4", 795), ("sensor_4", "12.3", 800),
    ]


def test_running_winner(totals, rows):
    timed = totals.withColumn("total", F.col("total").cast("double"))
    found = windows.running_winner(timed, "driverId", 5 * SECOND)
    picked = found.select(
        "driverId", F.round("total", 4), F.unix_seconds(F.col("window_end").cast("timestamp")) - BASE
    )
    assert rows(picked) == [
        ("sensor_2a", 6.4, 795), ("sensor_4", 12.3, 800), ("sensor_4", 12.3, 805),
    ]


def test_running_winner_with_falling_sums(spark, rows):
    made = [("a", 5, 0), ("b", 3, 0), ("a", -4, 10), ("b", 1, 20), ("c", 9, 40)]
    df = spark.createDataFrame(made, "k string, v bigint, s bigint").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    sums = windows.window_total(df, ["k"], "ts", "10 seconds", "v")
    for limit in (2, 1000):
        found = windows.running_winner(sums, "k", 10 * SECOND, max_rows=limit)
        ends = F.unix_seconds(F.col("window_end").cast("timestamp"))
        # a holds 5, then falls to 1; b holds 3, then 4; the window without rows gives nothing
        assert rows(found.select(ends, "k", "total")) == [
            (10, "a", 5), (20, "b", 3), (30, "b", 4), (50, "c", 9),
        ]


def arrivals(spark, *groups):
    made = [
        (n, k, BASE * 1000 + at * 1000, float(v))
        for n, (k, v, at) in enumerate((k, v, at) for k, values, at in groups for v in values)
    ]
    df = spark.createDataFrame(made, "seq bigint, id string, timestamp bigint, temperature double")
    return df.withColumn("ts", event_time(F.col("timestamp")))


FIRST = [
    ("sensor_1", (1, 1.1, 1.2), 791), ("sensor_2", (2, 2.1, 2.2), 791),
    ("sensor_3", (3, 3.1, 3.2), 795),
]
LATE = [
    *FIRST, *FIRST, ("sensor_4", (4,), 796), ("sensor_1", (-1,), 790), ("sensor_5", (5,), 797),
    ("sensor_2", (-2,), 790), ("sensor_6", (6,), 798), ("sensor_3", (-3,), 790),
]


def test_allowed_lateness(spark, rows):
    df = arrivals(spark, *LATE)
    replayed = lateness.replay(df, ["seq"], "ts", 5 * SECOND, SECOND, 2 * SECOND)
    fired = lateness.lowest_firings(
        replayed, ["id"], ["seq"], "temperature", 5 * SECOND, ["temperature"]
    )
    closed = fired.filter(F.col("end_us") == (BASE + 795) * SECOND).select(
        "id", "firing", "record.temperature",
        F.floor(F.col("watermark_us") / 1000) - BASE * 1000,
        F.concat_ws("$$$", (F.col("start_us") / 1000).cast("bigint"),
                    (F.col("end_us") / 1000).cast("bigint")),
    )
    span = "1599990790000$$$1599990795000"
    assert rows(closed) == sorted(
        [
            ("sensor_1", "first", 1.0, 794999, span), ("sensor_2", "first", 2.0, 794999, span),
            ("sensor_1", "update", -1.0, 794999, span),
            ("sensor_2", "update", -2.0, 795999, span),
        ],
        key=lambda r: [(x is None, str(x)) for x in r],
    )
    assert rows(lateness.late_rows(replayed), "id", "temperature") == [("sensor_3", -3.0)]


def test_late_side_output(spark, rows):
    df = arrivals(
        spark, *FIRST, ("sensor_4", (4, 4.1, 4.2), 796), ("sensor_5", (5,), 797),
        ("sensor_1", (0,), 791), ("sensor_1", (1,), 790),
    )
    replayed = lateness.replay(df, ["seq"], "ts", 5 * SECOND, 2 * SECOND)
    assert rows(lateness.late_rows(replayed), "id", "temperature") == [
        ("sensor_1", 0.0), ("sensor_1", 1.0),
    ]
    fired = lateness.lowest_firings(
        replayed, ["id"], ["seq"], "temperature", 5 * SECOND, ["temperature"]
    ).filter(F.col("end_us") == (BASE + 795) * SECOND)
    assert rows(
        fired, "id", "firing", "record.temperature",
        F.floor(F.col("watermark_us") / 1000) - BASE * 1000,
    ) == [("sensor_1", "first", 1.0, 794999), ("sensor_2", "first", 2.0, 794999)]


@pytest.mark.parametrize(
    "starts", [(790_000, 790_000, 790_000), (790_000, 790_000, 791_000),
               (790_001, 790_002, 790_003)],
)
def test_process_window(spark, rows, starts):
    made = [("sensor_1", v, t) for v, t in zip((1.0, 1.1, 1.2), starts)]
    made += [("sensor_2", v, 791_000) for v in (2.0, 2.1, 2.2)]
    made += [("sensor_3", v, 795_000) for v in (3.0, 3.1, 3.2)]
    made += [("sensor_4", 4.0, 796_000), ("sensor_5", 5.0, 797_000)]
    df = spark.createDataFrame(
        [(n, k, BASE * 1000 + at, v) for n, (k, v, at) in enumerate(made)],
        "seq bigint, id string, timestamp bigint, temperature double",
    ).withColumn("ts", event_time(F.col("timestamp")))
    replayed = lateness.replay(df, ["seq"], "ts", 5 * SECOND, 2 * SECOND)
    sums = replayed.groupBy("id", "start_us", "end_us").agg(F.sum("temperature").alias("total"))
    ms = lambda c: F.floor(F.col(c) / 1000) - BASE * 1000
    found = sums.join(lateness.closing_watermarks(replayed, 5 * SECOND), "end_us").select(
        "id", ms("closed_at") - 1, ms("start_us"), ms("end_us"), F.round("total", 6)
    )
    assert [r for r in rows(found) if r[3] == 795000] == [
        ("sensor_1", 794999, 790000, 795000, 3.3), ("sensor_2", 794999, 790000, 795000, 6.3),
    ]
    # the input ends before the other windows close
    assert all(r[1] is None for r in rows(found) if r[3] > 795000)


def test_retract_pairs(spark):
    df = spark.createDataFrame(
        [(0, "sensor_1", 35.8), (1, "sensor_1", 36.3)], "seq bigint, id string, temp double"
    )
    log = changelog.retract_changelog(df, ["id"], ["seq"], "temp")
    found = log.orderBy("seq", "op").select("op", "id", "cnt", F.round(F.col("total") / F.col("cnt"), 4))
    assert [tuple(r) for r in found.collect()] == [
        (True, "sensor_1", 1, 35.8), (False, "sensor_1", 1, 35.8), (True, "sensor_1", 2, 36.05),
    ]


def test_event_time_units(spark):
    one = spark.range(1).select(
        event_time(F.lit(1547718199), "s").cast("string").alias("s"),
        event_time(F.lit(1547718199000)).cast("string").alias("ms"),
    )
    assert one.first() == ("2019-01-17 09:43:19", "2019-01-17 09:43:19")
    with pytest.raises(ValueError):
        event_time(F.lit(1), "h")


def test_running_sum_by_parity(spark, rows):
    made = list(enumerate((1, 34, 4, 657, 23)))
    df = spark.createDataFrame(made, "seq bigint, value bigint").withColumn(
        "parity", F.col("value") % 2
    )
    found = rolling.rolling_sum(df, ["parity"], ["seq"], "value", "total").orderBy("seq")
    assert [r.total for r in found.collect()] == [1, 34, 38, 658, 681]


def test_rolling_maximum_keeps_the_first_of_equals(spark):
    df = spark.createDataFrame(
        [(0, "a", 5, "x"), (1, "a", 5, "y"), (2, "a", 4, "z"), (3, "a", 6, "w"), (4, "a", None, "n")],
        "seq bigint, id string, v int, tag string",
    )
    found = rolling.rolling_max_by(df, ["id"], ["seq"], "v").orderBy("at_seq")
    assert [r.tag for r in found.collect()] == ["x", "x", "x", "w", "w"]
