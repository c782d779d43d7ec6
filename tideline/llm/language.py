"""Language of a text: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, and every run of other characters than letters is one blank, so that n-grams
are those of words and word ends. The n-grams of one to three characters are hashed into a fixed
number of slots with whole-array arithmetic. Training adds up one slots by languages matrix per
partition; the matrices are summed in Spark, cell by cell, over all training texts. The matrix of log
probabilities is built and broadcast in blocks of `BLOCK` languages, so neither the driver nor a task
holds more than one block, whatever the number of languages; a batch is scored block by block, by
taking the matrix rows of its n-grams and adding them up per text. Log probabilities are multiples of
2**-16, whose sums are exact: batches and blocks do not change a result.

The score is the probability of the chosen language after tempering: evidence grows with the root of
the number of n-grams, since neighbouring n-grams are not independent. Ties go to the language that
comes first by name. Null texts and texts without a letter are `und` with score 0, as are all texts
when nothing was learned. Rows are scored one by one, so repeated rows give repeated results; a null
id belongs to the fold of the empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import arrow_rows, stored

BITS = 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: languages in a block of the matrix, which has 2**BITS x BLOCK cells of four bytes
BLOCK = 256
#: matrix cells that a task adds up at a time
CELLS = 1 << 23
GRID = 1 << 16
UNKNOWN = "und"
OTHER = regex.compile(r"[^\p{L}]+")
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def slots(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams of all texts, and for each n-gram the number of its text.

    Texts have a blank at either end, and no n-gram goes over the end of a text.
    """
    clean = [f" {OTHER.sub(' ', t.lower()).strip()} " for t in texts]
    sizes = np.fromiter(map(len, clean), np.int64, len(clean))
    chars = np.frombuffer("".join(clean).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    found, owners, code = [], [], np.zeros(len(chars), np.uint32)
    for k in ORDERS:
        n = len(chars) - k + 1
        if n <= 0:
            break
        code = code[:n] * MULTIPLIERS[3] + (chars[k - 1 :] + np.uint32(1)) * MULTIPLIERS[0]
        mixed = (code ^ (code >> np.uint32(15))) * MULTIPLIERS[1] + MULTIPLIERS[k % 3]
        inside = owner[:n] == owner[k - 1 :]
        found.append((mixed >> np.uint32(32 - bits))[inside])
        owners.append(owner[:n][inside])
    if not found:
        return np.empty(0, np.uint32), np.empty(0, np.int32)
    return np.concatenate(found), np.concatenate(owners)


@dataclass
class Model:
    """A block of languages."""

    languages: list[str]
    weights: np.ndarray  # slots x languages, float32 log probabilities
    prior: np.ndarray


@dataclass
class Learned:
    """The languages in order, how many texts each was learned from, and the stored counts."""

    languages: list[str]
    texts: np.ndarray
    counts: DataFrame  # lang, slot, n
    bits: int

    def blocks(self) -> Iterator[Model]:
        """The model in blocks, each made when it is asked for."""
        prior = np.log((self.texts + 1) / (self.texts.sum() + max(len(self.texts), 1)))
        for start in range(0, len(self.languages), BLOCK):
            names = self.languages[start : start + BLOCK]
            # at most slots x BLOCK cells come to the driver
            cells = self.counts.where(
                F.col("lang").between(names[0], names[-1]) & (F.col("slot") >= 0)
            ).toArrow()
            place = {x: i for i, x in enumerate(names)}
            column = np.array([place[x] for x in cells.column("lang").to_pylist()], np.int64)
            table = np.zeros((1 << self.bits, len(names)))
            table[cells.column("slot").to_numpy(), column] = cells.column("n").to_numpy()
            logs = np.log(table + SMOOTHING) - np.log(table.sum(0) + SMOOTHING * len(table))
            weights = (np.round(logs * GRID) / GRID).astype(np.float32)
            yield Model(names, weights, prior[start : start + BLOCK])


def counter(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Slot counts of a partition by language, passed on whenever `BLOCK` languages have come up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, counts in total.items():
                at = np.flatnonzero(counts)
                # slot -1 counts documents
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([name] * (len(at) + 1)),
                        "slot": pa.array(np.append(at, -1), pa.int32()),
                        "n": pa.array(np.append(counts[at], docs[name]), pa.int64()),
                    }
                )
            total.clear()
            docs.clear()

        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                langs = batch.column("lang").to_pylist()
                names = sorted(set(langs))
                place = np.array([names.index(x) for x in langs], np.int64)
                slot, owner = slots([t or "" for t in batch.column("text").to_pylist()], bits)
                counts = np.bincount(
                    (place[owner] << bits) + slot.astype(np.int64), minlength=len(names) << bits
                ).reshape(len(names), -1)
                for i, name in enumerate(names):
                    total[name] = total.get(name, 0) + counts[i]
                    docs[name] = docs.get(name, 0) + int((place == i).sum())
            if len(total) >= BLOCK:
                yield from out()
        yield from out()

    return run


def learn(labelled: DataFrame, bits: int = BITS) -> Learned:
    """A model from text and lang; rows whose lang is null teach nothing."""
    counts = (
        labelled.where(F.col("lang").isNotNull())
        .select("text", "lang")
        .mapInArrow(counter(bits), "lang string, slot int, n long")
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
    )
    counts = stored(counts, "slots")
    texts = {r["lang"]: r["n"] for r in counts.where("slot < 0").collect()}  # a row for each language
    languages = sorted(texts)
    return Learned(languages, np.array([texts[x] for x in languages], float), counts, bits)


def sums_of(slot: np.ndarray, owner: np.ndarray, n: int, model: Model) -> np.ndarray:
    """Log probabilities by text and language; `owner`, the texts of the slots, is in order."""
    sums = np.zeros((n, len(model.languages)))
    step = max(1, CELLS // len(model.languages))
    for start in range(0, len(slot), step):
        mine = owner[start : start + step]
        first = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
        rows = model.weights[slot[start : start + step]]
        sums[mine[first]] += np.add.reduceat(rows, first, axis=0, dtype=np.float64)
    return sums + model.prior


def classify(texts: list[str], *models: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text by a model in one block or several."""
    return classified(texts, iter(models))


def classified(texts: list[str], models: Iterator[Model]) -> tuple[list[str], np.ndarray]:
    lettered = np.array([any(map(str.isalpha, t)) for t in texts], bool)
    n = len(texts)
    names = np.full(n, UNKNOWN, object)
    best, odds = np.full(n, -np.inf), np.zeros(n)
    slot = None
    for model in models:
        if not n or not model.languages:
            continue
        if slot is None:
            slot, owner = slots(texts, len(model.weights).bit_length() - 1)
            # n-grams come order by order; one sort by text, then sums over runs
            order = np.argsort(owner, kind="stable")
            slot, owner = slot[order], owner[order]
            scale = 1 / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))
        sums = sums_of(slot, owner, n, model)
        top = sums.max(1)
        more = top > best  # a tie stays with the earlier block
        names[more] = np.array(model.languages, object)[sums.argmax(1)[more]]
        new = np.maximum(best, top)
        here = np.exp((sums - new[:, None]) * scale[:, None]).sum(1)
        odds = odds * np.exp((best - new) * scale) + here
        best = new
    known = lettered & (odds > 0)
    score = np.divide(1.0, odds, out=np.zeros(n), where=known)
    return np.where(known, names, UNKNOWN).tolist(), score


def predict(docs: DataFrame, model: Learned, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per document."""
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast(block) for block in model.blocks()]

    def blocks() -> Iterator[Model]:
        for one in shared:
            yield one.value
            if len(shared) > 1 and getattr(one, "_path", None):
                one.__dict__.pop("_value", None)  # read from its file again when needed

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = classified([t or "" for t in batch.column("text").to_pylist()], blocks())
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(score, pa.float64()),
            }
        )

    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        arrow_rows(step, 200), "doc_id long, held_out boolean, lang_pred string, score double"
    )
