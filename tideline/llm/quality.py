"""Quality of a text: a Gaussian-kernel ridge classifier over document statistics.

Twelve statistics of a text are standardised and mapped to random Fourier features, whose inner
products approximate a Gaussian kernel. The normal equations of ridge regression on them are sums
over rows: each partition adds up its own and Spark sums them cell by cell, so that all labelled rows
of the training fold count and only one small matrix comes to the driver. The regression's answers
are then calibrated: labels are counted by answer in narrow cells, over all training rows, and pooled
until the share of good texts never falls as the answer grows (isotonic regression).

Null and empty texts have statistics of zero and are scored like any other. Repeated rows are scored
each time; a null id is in the fold of the empty text. Labels that are null or neither 0 nor 1 teach
nothing, repeated labels count once, contradicting ones once each. Without labels every score is 0.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import arrow_rows, stored, texts

STATISTICS = (
    "log_words", "word_length", "distinct", "top_word", "repeated_triples", "symbols", "upper",
    "exclamations", "digits", "dup_lines", "line_words", "stutter",
)
FEATURES = 160
WIDTH = 3.0
RIDGE = 1e-4
SEED = 20
CELLS = 500
BYTES = np.zeros((256, 4))
BYTES[[ord(c) for c in "#*$%&|<>"], 0] = 1
BYTES[ord("A") : ord("Z") + 1, 1] = 1
BYTES[ord("!"), 2] = 1
BYTES[ord("0") : ord("9") + 1, 3] = 1


def statistics(text: bytes) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ BYTES / len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    counts = Counter(words)
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        len(counts) / n,
        max(counts.values()) / n,
        1 - triples / (n - 2) if n > 2 else 0.0,
        *kinds,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        sum(map(bytes.__eq__, words, words[1:])) / n,
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([statistics(t) for t in texts(batch)]).reshape(-1, len(STATISTICS))
        columns = [pa.array(values[:, i]) for i in range(len(STATISTICS))]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *columns], names=["doc_id", *STATISTICS]
        )

    schema = "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS)
    return docs.select("doc_id", "text").mapInArrow(arrow_rows(step, 500), schema)


@dataclass
class Kernel:
    """Standardisation and random directions; the features of equal seeds are equal everywhere."""

    mean: np.ndarray
    scale: np.ndarray

    def __post_init__(self) -> None:
        draw = np.random.default_rng(SEED)
        self.directions = draw.normal(0, 1 / WIDTH, (len(STATISTICS), FEATURES))
        self.phases = draw.uniform(0, 2 * np.pi, FEATURES)

    def features(self, batch: pa.RecordBatch) -> np.ndarray:
        raw = np.column_stack([batch.column(s).to_numpy(zero_copy_only=False) for s in STATISTICS])
        x = np.clip((raw - self.mean) / self.scale, -5, 5)
        waves = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.column_stack([np.ones(len(x)), waves])


def kernel(rows: DataFrame) -> Kernel | None:
    moments = rows.agg(
        *[F.avg(s).alias(f"m_{s}") for s in STATISTICS],
        *[F.stddev_pop(s).alias(f"d_{s}") for s in STATISTICS],
    ).first()
    if moments[0] is None:
        return None
    mean = np.array([moments[f"m_{s}"] for s in STATISTICS])
    scale = np.array([moments[f"d_{s}"] for s in STATISTICS])
    return Kernel(mean, np.where(scale > 1e-9, scale, 1.0))


def regression(rows: DataFrame, maps: Kernel) -> np.ndarray:
    """Ridge weights from statistics and label: sums of the upper triangle, by partition and then all."""
    size = FEATURES + 1
    upper = np.triu_indices(size)

    def summed(batches):
        total, answer, n = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            z = maps.features(batch)
            total += z.T @ z
            answer += z.T @ batch.column("label").to_numpy(zero_copy_only=False)
            n += len(z)
        if n:
            cells = np.concatenate([total[upper], answer])
            yield pa.RecordBatch.from_pydict(
                {"cell": pa.array(np.arange(len(cells)), pa.int32()), "value": pa.array(cells)}
            )

    cells = rows.mapInArrow(summed, "cell int, value double").groupBy("cell").agg(
        F.sum("value").alias("value")
    )
    got = cells.toArrow()  # one number for each cell of the matrix
    flat = np.zeros(len(upper[0]) + size)
    flat[got.column("cell").to_numpy()] = got.column("value").to_numpy()
    matrix = np.zeros((size, size))
    matrix[upper] = flat[: len(upper[0])]
    matrix += np.triu(matrix, 1).T
    n = max(matrix[0, 0], 1.0)
    penalty = RIDGE * n * np.eye(size)
    penalty[0, 0] = 1e-9 * n
    return np.linalg.solve(matrix + penalty, flat[len(upper[0]) :])


def pooled(share: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nearest shares that never fall: neighbours that do are pooled."""
    blocks: list[list[float]] = []
    for value, w in zip(share, weight, strict=True):
        blocks.append([value, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, u, k = blocks.pop()
            blocks[-1] = [
                (blocks[-1][0] * blocks[-1][1] + v * u) / (blocks[-1][1] + u),
                blocks[-1][1] + u,
                blocks[-1][2] + k,
            ]
    return np.concatenate([np.full(k, v) for v, _, k in blocks])


def answers(rows: DataFrame, maps: Kernel, weights: np.ndarray, keep: str, schema: str) -> DataFrame:
    """The column `keep` and the regression's answer of each row."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(keep), pa.array(maps.features(batch) @ weights)], names=[keep, "answer"]
        )

    return rows.select(keep, *STATISTICS).mapInArrow(arrow_rows(step, 10_000), f"{schema}, answer double")


def calibration(marked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Answers and the shares of good texts that belong to them, from label and answer."""
    cell = F.greatest(F.lit(-CELLS), F.least(F.lit(2 * CELLS), F.floor(F.col("answer") * CELLS)))
    counted = marked.groupBy(cell.alias("cell")).agg(
        F.count("*").alias("n"), F.sum("label").alias("good")
    )
    got = counted.toArrow().sort_by("cell")  # at most 3 * CELLS + 1 rows
    n, good = got.column("n").to_numpy().astype(float), got.column("good").to_numpy().astype(float)
    middles = (got.column("cell").to_numpy() + 0.5) / CELLS
    return middles, pooled((good + 0.02) / (n + 0.04), n)


def scored(docs: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """doc_id and score; `train` says of a document whether its label may be learned."""
    rows = stored(measured(docs), "statistics")
    marks = labels.select(
        F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("label")
    )
    marks = marks.where(F.col("label_id").isNotNull() & F.col("label").isin(0.0, 1.0)).distinct()
    taught = rows.where(train).join(marks, F.col("doc_id") == F.col("label_id"))
    taught = stored(taught.select("label", *STATISTICS), "taught")
    maps = kernel(taught)
    if maps is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    weights = regression(taught, maps)
    at, share = calibration(answers(taught, maps, weights, "label", "label double"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = np.interp(maps.features(batch) @ weights, at, share)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.clip(score, 0, 1))], names=["doc_id", "score"]
        )

    return rows.mapInArrow(arrow_rows(step, 10_000), "doc_id long, score double")
