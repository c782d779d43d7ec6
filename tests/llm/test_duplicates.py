"""Near-duplicates against all pairs."""

import random

import numpy as np

from tideline.llm import forest
from tideline.llm.components import components


def sets_of(texts, width):
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        k = min(width, len(words))
        out.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    return out


def brute(texts, ids, width, percent):
    sets = sets_of(texts, width)
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(sets)):
        groups.setdefault(find(i), []).append(i)
    least = {}
    for members in groups.values():
        known = [ids[m] for m in members if ids[m] is not None]
        for m in members:
            least[m] = min(known) if known else None
    return sorted(
        ((ids[i], len(sets[i]), least[i], ids[i] == least[i]) for i in range(len(sets))), key=str
    )


def run(df, width, percent=80):
    rows = forest.near_duplicates(df, width, percent).drop("text_key").collect()
    return sorted(map(tuple, rows), key=str)


def variants(prose):
    """Families with a hub, chains, copies, and texts that only share much of their wording."""
    draw, texts = random.Random(1), []
    for family in range(12):
        words = prose(family, 120).split()
        texts.append(" ".join(words))
        for _ in range(9):
            changed = list(words)
            for _ in range(draw.randint(0, 9)):
                changed[draw.randrange(len(changed))] = f"w{draw.randint(0, 10**6)}"
            texts.append(" ".join(changed))
    texts += texts[:5] * 3 + [prose(900 + i, draw.randint(1, 12), 6) for i in range(60)]
    draw.shuffle(texts)
    return texts


def test_all_pairs(make, prose):
    texts = variants(prose)
    ids = list(range(1000, 1000 + len(texts)))
    for width in (2, 5):
        assert run(make(texts, ids), width) == brute(texts, ids, width, 80)


def test_crowds_are_searched_again(make, prose, monkeypatch):
    texts = variants(prose)
    ids = list(range(len(texts)))
    monkeypatch.setattr(forest, "WINDOW", 2)
    monkeypatch.setattr(forest, "BEST", 1)
    monkeypatch.setattr(forest, "ROWS_PER_PART", 160)  # ten classes to a partition
    monkeypatch.setattr(forest, "WIDE_ROWS_PER_PART", 160)
    assert run(make(texts, ids), 2) == brute(texts, ids, 2, 80)


def test_odd_rows(make, odd):
    texts, ids = odd
    got = run(make(texts, ids), 2)
    assert got == brute(texts, ids, 2, 80)
    assert (None, 14, 5, False) in got


def test_empty_table(make):
    assert run(make([]), 2) == []


def test_one_document_of_a_group_stays(make, prose):
    texts = [prose(1, 80), prose(1, 80) + " end", prose(2, 80), None, ""]
    left = forest.without_duplicates(make(texts))
    assert left.columns == make([]).columns
    assert sorted(r.doc_id for r in left.collect()) == [0, 2, 3, 4]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(1, 41)}, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def template_texts(prose, n=240):
    """Texts of one template, less alike than the limit, some of them with a partner just above it."""
    draw, words, texts = random.Random(7), prose(77, 120).split(), []
    for k in range(n):
        changed = list(words)
        for at in draw.sample(range(120), 5):
            changed[at] = f"w{draw.randint(0, 10**9)}"
        texts.append(" ".join(changed))
        if k % 4 == 0:
            for at in draw.sample(range(120), 6):
                changed[at] = f"w{draw.randint(0, 10**9)}"
            texts.append(" ".join(changed))
    draw.shuffle(texts)
    return texts


def test_regions_beyond_the_wide_window(make, prose, monkeypatch):
    texts = template_texts(prose)
    ids = list(range(len(texts)))
    monkeypatch.setattr(forest, "WINDOW", 1)
    monkeypatch.setattr(forest, "BEST", 1)
    monkeypatch.setattr(forest, "WIDE_WINDOW", 1)
    monkeypatch.setattr(forest, "SALT_ROWS", 50)
    expected = brute(texts, ids, 2, 80)
    assert run(make(texts, ids), 2) == expected
    monkeypatch.setattr(forest, "ROWS_PER_PART", 160)
    monkeypatch.setattr(forest, "WIDE_ROWS_PER_PART", 6)  # parts shorter than the window
    assert run(make(texts, ids), 2) == expected


def test_sketches_drop_no_pairs_at_the_limit():
    draw = np.random.default_rng(2)
    hashes = draw.integers(0, 2**63, (20_000, 10), dtype=np.uint64)
    left, right = forest.signatures(list(hashes[:, 1:])), forest.signatures(list(hashes[:, :-1]))
    alike = ((left & 15) == (right & 15)).sum(1)
    need = forest.VALUES * ((0.8 - forest.SLACK) * 15 / 16 + 1 / 16)
    assert need == forest.least_alike(80)
    assert (alike < need).sum() == 0
