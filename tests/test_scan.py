"""Hot keys: cut into segments, the results must be those of a plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import (
    chain,
    changelog,
    dedup,
    detect,
    lateness,
    rolling,
    runs,
    scan,
    windows,
)

SMALL = 40


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a null key, repeated and missing values."""
    rng = random.Random(3)
    made = []
    for seq in range(900):
        key = "hot" if seq % 3 == 0 else rng.choice(["a", "b", "c", "d", "e", None])
        value = None if rng.random() < 0.1 else rng.randrange(50)
        made.append((seq, key, value, rng.randrange(30)))
    rng.shuffle(made)
    return spark.createDataFrame(made, "seq bigint, key string, value bigint, tie bigint").cache()


def all_measures(order):
    value = F.col("value")
    return [
        scan.running_sum("s", value),
        scan.running_sum("s_before", value, inclusive=False),
        scan.running_count("n"),
        scan.running_count("n_values", value, inclusive=False),
        scan.running_max("hi", value),
        scan.running_min("lo", value, inclusive=False),
        scan.previous("last", value, order),
    ]


@pytest.mark.parametrize("key", [["key"], []])
@pytest.mark.parametrize("order", [["seq"], ["tie", "seq"]])
def test_running_over_segments(skewed, rows, key, order):
    measures = all_measures(order)
    assert scan.segment(skewed, key, order, SMALL) is not None
    assert scan.segment(skewed, key, order, 10_000) is None
    cut = scan.running(skewed, key, order, measures, SMALL)
    assert rows(cut) == rows(scan.running(skewed, key, order, measures, 10_000))


def test_segments_stay_small(skewed):
    cut = scan.segment(skewed, ["key"], ["seq"], SMALL)
    largest = cut.groupBy("_segment").count().agg(F.max("count"))
    assert largest.first()[0] <= SMALL


def test_one_arrival_value_for_a_third_of_the_rows(spark, rows):
    made = [(0 if i % 3 == 0 else i, i, "k", i % 7) for i in range(600)]
    df = spark.createDataFrame(made, "arrived bigint, seq bigint, key string, value bigint")
    order = ["arrived", "seq"]
    cut = scan.segment(df, ["key"], order, SMALL)
    assert cut.groupBy("_segment").count().agg(F.max("count")).first()[0] <= SMALL
    total = [scan.running_sum("s", F.col("value"))]
    assert rows(scan.running(df, ["key"], order, total, SMALL)) == rows(
        scan.running(df, ["key"], order, total)
    )


ORDERS = {
    "timestamp": "cast(timestamp_seconds(seq) as timestamp_ntz)",
    "date": "date_add(date '2024-01-01', cast(seq as int))",
    "text": "lpad(cast(seq as string), 6, '0')",
    "null": "case when seq > 100 then cast(seq as double) end",
    "nan": "case when seq < 700 then cast(seq as double) else double('nan') end",
    "struct": "struct(tie, 'x' as x)",
}


@pytest.mark.parametrize("kind", sorted(ORDERS))
def test_orders_of_any_type(skewed, rows, kind):
    """The same result whatever the limit; ties, nulls and NaN go on to the next order column."""
    df = skewed.withColumn("at", F.expr(ORDERS[kind]))
    for key in (["key"], []):
        measures = all_measures(["at", "seq"])
        found = [scan.running(df, key, ["at", "seq"], measures, m) for m in (60, 200, 10_000)]
        wanted = rows(found[2], "seq", *[m.name for m in measures])
        for f in found[:2]:
            assert rows(f, "seq", *[m.name for m in measures]) == wanted


@pytest.mark.parametrize("preceding", [0, 2, 9, 100])
def test_frames_over_blocks(skewed, rows, preceding):
    values = {"n": lambda w: F.count("value").over(w), "s": lambda w: F.sum("value").over(w)}
    cut = scan.framed(skewed, ["key"], ["seq"], preceding, values, "nth", SMALL)
    plain = scan.framed(skewed, ["key"], ["seq"], preceding, values, "nth")
    assert rows(cut, *plain.columns[:4], "nth", "n", "s") == rows(
        plain, *plain.columns[:4], "nth", "n", "s"
    )


def test_blocks_for_sql(skewed, rows):
    for limit in (SMALL, 10_000):
        scan.in_blocks(skewed, ["key"], ["seq"], 2, limit).createOrReplaceTempView("cut")
        cut = skewed.sparkSession.sql(
            """select seq, s from (select seq, home, block, sum(value) over (
                 partition by key, block order by seq rows between 2 preceding and current row) s
               from cut) where home = block"""
        )
        w = Window.partitionBy("key").orderBy("seq").rowsBetween(-2, 0)
        assert rows(cut) == rows(skewed.select("seq", F.sum("value").over(w)))


def test_operators_agree_when_cut(skewed, rows):
    df = skewed.filter("key is not null").withColumn("ts", F.timestamp_seconds(F.col("seq") * 60))
    for operator in [
        lambda m: rolling.rolling_max_by(df, ["key"], ["seq"], "value", m),
        lambda m: rolling.rolling_reduce(df, ["key"], ["seq"], "value", m),
        lambda m: rolling.count_window(df, ["key"], ["seq"], 10, 2, "value", max_rows=m),
        lambda m: changelog.retract_changelog(df, ["key"], ["seq"], "value", m),
        lambda m: detect.jumps(df, ["key"], ["seq"], "value", 10, m),
        lambda m: detect.lasting_rises(
            df.filter("value is not null"), ["key"], "tie", "seq", "value", 3, m
        ),
        lambda m: windows.sessions(df, ["key"], "ts", 120_000_000, m),
        lambda m: dedup.dedup_ttl(df, ["key"], "ts", ["seq"], ["seq", "value"], 150_000_000, m),
    ]:
        assert rows(operator(SMALL)) == rows(operator(100_000))


def test_lateness_agrees_when_cut(skewed, rows):
    df = skewed.filter("key is not null and value is not null").withColumn(
        "ts", F.timestamp_seconds(F.col("seq") - F.col("tie"))
    )
    replayed = [
        lateness.replay(df, ["seq"], "ts", 20_000_000, 3_000_000, 8_000_000, m)
        for m in (SMALL, 100_000)
    ]
    assert rows(replayed[0]) == rows(replayed[1])
    assert {r.fate for r in replayed[0].select("fate").distinct().collect()} == {
        lateness.ON_TIME, lateness.LATE, lateness.TOO_LATE,
    }
    fired = [
        lateness.lowest_firings(r, ["key"], ["seq"], "value", 20_000_000, ["seq", "value"], m)
        for r, m in zip(replayed, (4, 100_000))
    ]
    assert rows(fired[0]) == rows(fired[1])


def greedy(times, reach):
    chosen, bar = [], None
    for t in sorted(times):
        if bar is None or t >= bar:
            chosen.append(t)
            bar = t + reach
    return chosen


@pytest.mark.parametrize("strict, limit", [(False, 5), (True, 60), (False, 10_000), (True, 10_000)])
def test_chain_against_a_loop(spark, rows, strict, limit):
    """Walked, cut into runs and walked, and jumped."""
    rng = random.Random(11)
    groups = {
        ("dense", 1): list(range(0, 400)),
        ("dense", 2): sorted(rng.sample(range(1000), 200)),
        ("sparse", 1): sorted(rng.sample(range(100_000), 80)),
        ("bursts", 1): [b * 500 + i for b in range(8) for i in range(0, 40, 3)],
        ("one", 1): [7],
        ("pair", 1): [0, 10],
        ("pair", 2): [0, 11],
    }
    made = [(g, i, t, f"p{t}") for (g, i), times in groups.items() for t in times]
    made += [(g, i, t, f"q{t}") for g, i, t, _ in made if t % 3 == 0]  # later rows at one time
    rng.shuffle(made)
    df = spark.createDataFrame(made, "g string, i int, at bigint, payload string")
    found = chain.greedy_chain(df, ["g", "i"], "at", 10, strict, ["payload"], limit)
    expected = [
        (g, i, t, f"p{t}")
        for (g, i), times in groups.items()
        for t in greedy(times, 11 if strict else 10)
    ]
    assert rows(found) == sorted(expected, key=lambda r: [(x is None, str(x)) for x in r])


def test_runs_touching_or_not(spark, rows):
    df = spark.createDataFrame([(t,) for t in (0, 5, 15, 25, 36, 37)], "at bigint")
    found = lambda touching: rows(
        runs.gap_slots(df, [], "at", 10, touching).select("run").distinct()
    )
    assert found(True) == [(0,), (36,)]
    assert found(False) == sorted([(0,), (15,), (25,), (36,)], key=str)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "seq bigint, key string, value bigint, ts timestamp")
    assert rolling.rolling_sum(empty, ["key"], ["seq"], "value", "s").count() == 0
    assert lateness.replay(empty, ["seq"], "ts", 1000, 0).count() == 0
    assert dedup.dedup_ttl(empty, ["key"], "ts", ["seq"], ["value"], 1000).count() == 0
