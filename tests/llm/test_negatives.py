"""Hard negatives against all pairs."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tideline.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id long, g int, x string, windows string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, 0, 1, "x", "w") for i, v, lab in rows], SCHEMA)


def mined(df, **how):
    out = negatives.mined(df, F.col("label"), F.col("id") % 10 == 0, **how)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.select(*names).collect()))


def plain(rows, k=5, m=10):
    whole = lambda v: [math.floor(256 * float(np.float32(x))) for x in v]
    known = {i: (lab, whole(v)) for i, v, lab in rows}
    width = max(len(v) for _, v in known.values())
    vec = {i: np.array(v + [0] * (width - len(v)), np.int64) for i, (_, v) in known.items()}
    out = []
    for a in (i for i in known if i % 10 == 0):
        score = {b: int(vec[a] @ vec[b]) for b in known if b != a}
        best = sorted(score, key=lambda b: (-score[b], b))
        near = [b for b in best if known[b][0] == known[a][0]][:k]
        for p in near:
            far = [b for b in best if known[b][0] != known[a][0]
                   and 30 * score[p] <= 100 * score[b] <= 90 * score[p]][:m]
            out += [(a, p, r, b, score[p], score[b]) for r, b in enumerate(far, 1)]
    return sorted(out)


def drawn(n, dims, labels, seed=1):
    draw = random.Random(seed)
    centre = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(3)]
    return [
        (i, [draw.gauss(0, 0.7) + c for c in centre[draw.randrange(3)]], draw.randrange(labels))
        for i in range(n)
    ]


def test_all_pairs(spark):
    for rows in (drawn(300, 12, 3), drawn(200, 9, 2, 7), drawn(60, 3, 30)):
        assert mined(table(spark, rows)) == plain(rows)


def test_groups_do_not_matter(spark):
    rows = drawn(150, 20, 4, 3)
    assert mined(table(spark, rows), group_rows=7) == plain(rows)


def test_one_label_holds_most_rows_and_ties(spark):
    rows = [(i, [0.5, 0.25 * (i % 3), -1.0], 1 if i % 9 else 2) for i in range(200)]
    assert mined(table(spark, rows)) == plain(rows)


def test_scores_of_zero_and_below(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.5], 1), (2, [0.0, 1.0], 1), (3, [0.0, 2.0], 2),
            (4, [-0.4, 0.0], 2), (5, [0.0, 0.0], 3)]
    assert mined(table(spark, rows)) == plain(rows)


def test_rows_that_take_no_part(spark):
    good = drawn(40, 4, 3, 5)
    bad = [(50, None, 1), (51, [1.0, None, 0.0, 0.0], 1), (52, [float("nan")] * 4, 1),
           (53, [float("inf"), 0.0, 0.0, 0.0], 2), (54, [1.0] * 4, None), (None, [1.0] * 4, 1),
           (60, [1e30, 0.0, 0.0, 0.0], 1)]
    assert mined(table(spark, good + bad)) == plain(good)


def test_short_empty_and_repeated_vectors(spark):
    rows = drawn(30, 4, 2, 6) + [(30, [1.0], 0), (31, [], 1), (40, [], 0)]
    assert mined(table(spark, rows + rows[:10])) == plain(rows)


def test_nothing_to_find(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(1, [1.0], 1), (2, [1.0], 2)])) == []  # no anchor
    assert mined(table(spark, [(0, [1.0], 1), (2, [1.0], 2)])) == []  # no positive
    assert mined(table(spark, [(0, [], 1), (2, [], 1), (3, [], 2)])) == plain(
        [(0, [], 1), (2, [], 1), (3, [], 2)]
    )


def test_the_bitmap_shrinks():
    """Rows that cannot be among the best are left out before their last column is read."""
    draw = np.random.default_rng(2)
    x = draw.integers(-20, 20, (5000, 64))
    x[:50, :8] += 300
    columns = negatives.Columns(np.arange(5000), np.zeros(5000, np.int64), x)
    anchor = np.r_[np.full(8, 200), np.full(56, 3)]
    seen = []

    def live(lower, upper):
        seen.append(len(lower))
        return upper >= negatives.kth(lower, 5)

    rows, score = columns.scan(anchor, np.arange(5000), live)
    assert seen[0] == 5000 and seen[1] <= 60
    exact = columns.x.T @ anchor
    best = np.argsort(-exact, kind="stable")[:5]
    assert set(best) <= set(rows) and (score == exact[rows]).all()
