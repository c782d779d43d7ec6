"""Strings, parsing, functions, splits, connects and rules on edge cases."""

import pytest
from pyspark.sql import functions as F

from tideline.functions import udf
from tideline.functions.strings import split_line, string_hash, utf16_length
from tideline.operators import basic, dedup, detect, parse

TEXTS = ["", ",", ",,", "a", "a,", "a,,", ",a", "a,b,,c", "a,b,,", ",,a,,", None, "smile 😀,x"]


def java_split(text, sep=","):
    if text is None:
        return None
    parts = text.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts if parts or text != "" else [""]


def java_hash(text):
    h = 0
    raw = text.encode("utf-16-be")
    for i in range(0, len(raw), 2):
        h = (31 * h + raw[i] * 256 + raw[i + 1]) & 0xFFFFFFFF
    return h


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "value string")


@pytest.mark.parametrize("separator", [",", "[,]"])
def test_split(texts, separator):
    found = texts.select("value", split_line(F.col("value"), separator)).collect()
    assert [list(p) if p is not None else None for _, p in found] == [java_split(t) for t in TEXTS]


def test_flat_map_and_lateral(texts, rows):
    words = [w for t in TEXTS if t is not None for w in java_split(t)]
    assert rows(basic.flat_map_split(texts, "value")) == sorted((w,) for w in words)
    pairs = [
        (t, w, len(w.encode("utf-16-be")) // 2)
        for t in TEXTS if t is not None for w in java_split(t)
    ]
    key = lambda r: [(x is None, str(x)) for x in r]
    assert rows(basic.lateral_split(texts, "value")) == sorted(pairs, key=key)


def test_split_function_in_sql(spark, texts, rows):
    udf.register_split(spark, "cut", ",")
    texts.createOrReplaceTempView("texts")
    found = spark.sql("select value, word, length from texts, lateral cut(value)")
    assert rows(found) == rows(basic.lateral_split(texts, "value"))


def test_length_and_hash(spark):
    made = ["", "a", "sensor_1", "Äpfel", "😀 smile", "x" * 500]
    df = spark.createDataFrame([(t,) for t in made], "t string")
    udf.register_string_hash(spark, "hash_code", 23)
    df.createOrReplaceTempView("texts")
    wrap = lambda h: h - 2**32 if h >= 2**31 else h
    expected = [
        (t, len(t.encode("utf-16-be")) // 2, wrap(java_hash(t)), wrap(java_hash(t) * 23 % 2**32))
        for t in made
    ]
    t = F.col("t")
    found = df.select("t", utf16_length(t), string_hash(t), string_hash(t, 23))
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    in_sql = spark.sql("select t, hash_code(t) from texts")
    assert sorted(map(tuple, in_sql.collect())) == sorted((e[0], e[3]) for e in expected)


def test_average_of_accumulators(spark):
    udf.register_average(spark, "avg_temp")
    found = spark.sql(
        """select k, avg_temp(sum(s), sum(n)) a from values ('a', 3.0D, 2L), ('a', 6.0D, 1L),
             ('b', null, 0L) t(k, s, n) group by k"""
    )
    assert dict(map(tuple, found.collect())) == {"a": 3.0, "b": None}


SENSOR_LINES = [
    "sensor_1,1547718199000,35.8", "", "sensor_3, 1599990795000,3", "sensor_4,12,1.5,extra",
    "sensor_5,1", "sensor_6,x,1", "sensor_7,1,", "sensor_8,1,abc", ",1,2", None,
    "sensor_9,9223372036854775808,1",
]


def test_sensor_lines(spark, rows):
    df = spark.createDataFrame([(line,) for line in SENSOR_LINES], "value string")
    assert rows(parse.parse_sensor(df)) == [
        ("", 1, 2.0), ("sensor_1", 1547718199000, 35.8), ("sensor_4", 12, 1.5),
    ]
    good = parse.parse_sensor(df).count()
    assert good + parse.malformed_sensor(df).count() == len(SENSOR_LINES)


def test_fare_and_pair_lines(spark, rows):
    made = ["d1,5,1.5", "d1,5", "d1,5,x", "d1,5,1,9", "", "a,b", None]
    df = spark.createDataFrame([(line,) for line in made], "value string")
    assert rows(parse.parse_fare(df)) == [("d1", 5, 1.5)]
    names = ("userId", "action")
    assert rows(parse.flat_map_pair(df, names)) == [("a", "b"), ("d1", "5")]
    mapped = rows(parse.map_pair(df, names))
    assert len(mapped) == len(made) and mapped.count((None, None)) == len(made) - 2
    assert rows(parse.first_two(df, names)).count(("d1", "5")) == 4


def test_split_and_side_output_keep_every_row(spark, rows):
    df = spark.createDataFrame([(1.0,), (30.0,), (30.5,), (None,)], "v double")
    tagged = basic.with_tag(df, "v", 30.0)
    assert rows(basic.select_tags(tagged, ["high"])) == [(30.5, "high")]
    assert basic.select_tags(tagged, ["high", "low"]).count() == 4
    main, side = basic.side_output(df, F.col("v") > 30)
    assert rows(main) == [(30.5,)] and side.count() == 3


def test_union_of_different_types_is_refused(spark):
    with pytest.raises(ValueError):
        basic.union_all(spark.range(1), spark.createDataFrame([("a",)], "id string"))


def test_control_words(spark, rows):
    words = spark.createDataFrame(
        [("a", 1), ("a", 5), ("a", 6), ("b", 2), (None, 3)], "word string, at bigint"
    )
    control = spark.createDataFrame([("a", 5), ("a", 9)], "word string, at bigint")
    kept = [("a", 1), ("a", 5), ("b", 2), (None, 3)]
    assert rows(detect.control_filter(words, control, "word", "at")) == kept
    passed = detect.constant_filter(words, control, "word", "a")
    assert rows(passed) == [("a",), ("a",), ("b",), (None,)]


def test_patterns(spark, rows):
    actions = spark.createDataFrame(
        [("u", "login", 1), ("u", "pay", 2), ("u", "look", 3), ("u", None, 4), ("u", "pay", 5),
         ("v", "pay", 6), ("v", "pay", 7), ("w", "login", 0), ("w", "pay", 8)],
        "user string, action string, at bigint",
    )
    rules = spark.createDataFrame(
        [("login", "pay", 1), ("login", "pay", 6), ("pay", "pay", 3)],
        "action1 string, action2 string, at bigint",
    )
    find = lambda mode: rows(detect.patterns(actions, rules, "user", "action", "at", mode))
    assert find("strict") == [
        ("u", 2, "login", "pay"), ("v", 7, "pay", "pay"), ("w", 8, "login", "pay"),
    ]
    assert find("reference") == [
        ("u", 2, "login", "pay"), ("u", 5, "login", "pay"), ("u", 5, "pay", "pay"),
        ("v", 7, "login", "pay"), ("v", 7, "pay", "pay"),
        ("w", 8, "login", "pay"), ("w", 8, "pay", "pay"),
    ]
    with pytest.raises(ValueError):
        detect.patterns(actions, rules, "user", "action", "at", "loose")


def test_rises(spark, rows):
    made = [
        # rises at 0, not below until 12: alert at 10; re-armed by the rise at 11, falls at 12
        ("a", 0, 1.0), ("a", 5, 1.0), ("a", 11, 2.0), ("a", 12, 1.0),
        # fall exactly at the alert's time
        ("b", 0, 1.0), ("b", 10, 0.5),
        # a rise exactly at the alert's time does not arm again
        ("c", 0, 1.0), ("c", 10, 2.0), ("c", 15, 1.0),
        # never positive: no rise from the smallest positive value
        ("d", 0, 0.0), ("d", 5, -1.0), ("d", 6, -0.5),
    ]
    df = spark.createDataFrame(
        [(k, at, n, v) for n, (k, at, v) in enumerate(made)],
        "k string, at bigint, n bigint, v double",
    )
    assert rows(detect.lasting_rises(df, ["k"], "at", "n", "v", 10)) == [
        ("a", 0, 10), ("c", 0, 10), ("d", 6, 16),
    ]


def test_jump_threshold_is_inclusive(spark, rows):
    df = spark.createDataFrame(
        [("s", 0, 1.0), ("s", 1, 11.0), ("s", 2, 20.9), ("s", 3, 10.0)],
        "id string, seq bigint, v double",
    )
    assert rows(detect.jumps(df, ["id"], ["seq"], "v", 10.0)) == [
        ("s", 1, 1.0, 11.0), ("s", 3, 20.9, 10.0),
    ]


def test_dedup(spark, rows):
    df = spark.createDataFrame(
        [("k", 0, 0, "a"), ("k", 1, 2, "b"), ("k", 2, 3, "c"), ("k", 3, 5, "d"), ("k", 4, 6, "e"),
         ("l", 5, 6, "f"), ("l", 6, 6, "g")],
        "k string, seq bigint, s bigint, v string",
    ).withColumn("ts", F.timestamp_seconds("s"))
    assert rows(dedup.dedup_forever(df, ["k"], ["seq"], ["v"])) == [("k", "a"), ("l", "f")]
    # suppressed rows do not prolong the wait
    assert rows(dedup.dedup_ttl(df, ["k"], "ts", ["seq"], ["v"], 3_000_000)) == [
        ("k", "a"), ("k", "c"), ("k", "e"), ("l", "f"),
    ]


def test_lifecycle_runs_once_per_task(spark, tmp_path):
    import pyarrow as pa

    folder = str(tmp_path)

    def begin():
        import os
        import uuid

        name = os.path.join(folder, uuid.uuid4().hex)
        open(name + ".open", "w").close()
        return name

    def finish(name):
        open(name + ".close", "w").close()

    df = spark.range(0, 100, 1, 4)
    mapped = basic.rich_map(df, "id bigint", begin, lambda _, batch: batch, finish)
    assert mapped.count() == 100
    ends = [p.suffix for p in tmp_path.iterdir()]
    assert ends.count(".open") == 4 and ends.count(".close") == 4
    assert pa is not None


def test_exchanges(spark, rows):
    df = spark.range(100)
    expected = rows(df)
    for moved, n in [
        (basic.shuffled(df, 7), 7), (basic.rebalanced(df, 5), 5), (basic.in_one_task(df), 1),
        (basic.key_by(df, F.col("id") % 2, partitions=3), 3),
    ]:
        assert rows(moved) == expected and moved.rdd.getNumPartitions() == n
