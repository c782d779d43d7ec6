import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, row string, "
    "words int, fp string, c0 int, label int, at string"
)


@pytest.fixture
def make(spark):
    """Documents with columns whose names the operators use themselves."""

    def build(texts, ids=None, langs=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        sources = sources or ["a"] * len(texts)
        rows = [
            (i, t, x, s, 0, 0.5, "r", 1, "f", 2, 3, "z")
            for i, t, x, s in zip(ids, texts, langs, sources, strict=True)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture
def odd():
    """Null, empty, blank, tiny, repeated and very long texts, with ids that repeat or are null."""
    draw = random.Random(5)
    long = " ".join(draw.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(40_000))
    plain = "The quick brown fox jumps over the lazy dog near the old river bank today"
    texts = [None, "", " \n\t ", "one", plain, plain, plain.upper(), long, "x" * 100_000, "é 😀   z"]
    ids = [1, 2, 3, 4, 5, 5, None, 8, 9, 10]
    return texts, ids


@pytest.fixture
def prose():
    """Random sentences from a small vocabulary, the same for the same seed."""

    def write(seed, n, size=400):
        draw = random.Random(seed)
        vocabulary = ["".join(draw.choice("aeioulnrst") for _ in range(draw.randint(2, 8)))
                      for _ in range(size)]
        words = [draw.choice(vocabulary) for _ in range(n)]
        for i in range(0, n, 9):
            words[i] = words[i].capitalize()
        return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))

    return write
