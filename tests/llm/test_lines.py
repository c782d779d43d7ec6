"""Line deduplication against plain dictionaries."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tideline.llm import lines, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(texts, ids, min_chars=40, min_docs=5):
    split = [(t or "").split("\n") for t in texts]
    keys = [[x.strip(" \t\n\x0b\f\r").translate(LOWER) for x in s] for s in split]
    # no id comes before all others
    name = [float("-inf") if i is None else i for i in ids]
    holders = defaultdict(set)
    for doc, row in zip(name, keys, strict=True):
        for k in row:
            if len(k) >= min_chars:
                holders[k].add(doc)
    out = []
    for i, doc, row, key in zip(ids, name, split, keys, strict=True):
        kept = [
            x for x, k in zip(row, key, strict=True)
            if len(holders[k]) < min_docs or doc == max(holders[k])
        ]
        out.append((i, "\n".join(kept), len(row), len(row) - len(kept)))
    return out


def found(df):
    got = df.select("row.doc_id", "text", "n_lines", "n_dropped").collect()
    return sorted(map(tuple, got), key=str)


LONG = "This line is long enough to be counted among the frequent ones"


def test_shared_lines(make):
    texts = [f"first {i}\n  {LONG.upper() if i % 2 else LONG}\t\nlast {i}" for i in range(6)]
    texts += [LONG[:39] + "\n" + LONG[:39]] * 6  # too short, in six documents
    texts += [f"{LONG}\n{LONG}\n\n{LONG} and more", "\n".join([LONG] * 3)]
    ids = list(range(len(texts)))
    df = lines.deduplicated(make(texts, ids))
    assert found(df) == sorted(plain(texts, ids), key=str)
    kept = {r.doc_id: r.text for r in df.select("row.doc_id", "text").collect()}
    assert kept[0] == "first 0\nlast 0" and kept[12] == f"\n{LONG} and more"
    assert kept[13] == texts[13]


def test_limits_are_met_exactly(make):
    exact, short = "x" * 40, "é" * 39
    texts = [f"{exact}\n{short}"] * 5 + ["y" * 40] * 4
    ids = list(range(9))
    assert found(lines.deduplicated(make(texts, ids))) == sorted(plain(texts, ids), key=str)


def test_odd_rows(make, odd):
    texts, ids = odd
    df = lines.deduplicated(make(texts, ids))
    assert found(df) == sorted(plain(texts, ids), key=str)
    assert {r.row.row for r in df.collect()} == {"r"}  # columns of any name stay


def test_repeated_ids_and_no_ids(make):
    """Rows of one id are one document; rows without an id are one too, before all others."""
    texts = [f"{LONG}\n{i}" for i in range(5)] + [f"other {LONG}"] * 4
    for ids in ([1, 1, 1, 2, 3, 4, 5, 6, 7], [1, 2, 3, 4, None, None, None, 5, 6], [None] * 9):
        assert found(lines.deduplicated(make(texts, ids))) == sorted(plain(texts, ids), key=str)


def test_all_lines_lost(make):
    texts = ["\n".join([LONG] * 2)] * 5
    got = {r.doc_id: (r.text, r.n_dropped) for r in lines.deduplicated(make(texts)).select(
        "row.doc_id", "text", "n_dropped").collect()}
    assert got[0] == ("", 2) and got[4] == (texts[4], 0)


def test_no_documents(make, spark):
    empty = make(["a"]).limit(0)
    assert lines.deduplicated(empty).count() == 0


def test_a_hot_line_has_salts(make, monkeypatch):
    """A line in most documents is dealt out, with the same result."""
    monkeypatch.setattr(lines, "LEAST_ROWS", 8)
    texts = [f"{LONG}\nown {i}\n{'z' * 30} {i // 7:012}" for i in range(300)]
    docs = make(texts)
    hot = lines.salts(lines.hashed(docs.select("doc_id", "text"), 40)).collect()
    assert max(r.salts for r in hot) >= 30
    assert found(lines.deduplicated(docs)) == sorted(plain(texts, range(300)), key=str)


def test_left_over(spark):
    for gone in ([0], [3], [0, 1, 2, 3], [1, 2], [0, 3]):
        df = spark.createDataFrame([(list("abcd"), gone)], "lines array<string>, gone array<int>")
        got = df.select(lines.left_over(F.col("lines"), F.col("gone"))).first()[0]
        assert got == [x for i, x in enumerate("abcd") if i not in gone]


@pytest.mark.parametrize("name", ["op12_line_dedup"])
def test_query_on_an_empty_table(spark, tmp_path, make, name):
    make(["a"]).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0
