"""Log-likelihood of whole documents under a gated recurrent language model, beside a unigram base.

Words are counted over all training documents, one partial table per partition. The most frequent
ones, at most `hot` of them, go to every task; of those the first `GROUPS * GROUP_SIZE` have a softmax
of their own in the network and the others belong to classes by frequency. All other words, and words
never seen, are the last class. Their counts stay in a table: scoring leaves the cold words of each
document beside its sums, and one join brings their counts, so no vocabulary has to fit anywhere.

The network is trained where the data is, on all training documents. In each round every partition
trains a copy on its part of a share of them, dealt by a hash of their ids, by truncated
backpropagation; the copies are averaged in Spark, weighed by their tokens. The shares of the rounds
make up the whole; small inputs are gone through more than once. Class sizes and shares in classes
come from all training documents too.

A text is lower-cased words (A-Z) and one end token; a null text is the end token alone. Rows that
repeat a document are scored each time. A null id is in the fold of the empty text. Without training
documents every score is 0; a word that training doesn't know has the probability of half an
occurrence. Columns other than doc_id and text do not matter.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import arrow_rows, stored, words
from tideline.llm.recurrent import Network, Texts, score, train

HOT = 100_000
#: rarer words are never hot, so that the last class is learned from words as rare as unknown ones
LEAST_COUNT = 4
GROUPS, GROUP_SIZE = 32, 64
ROUNDS = 3
PLACES = 1 << 20
LEAST_TOKENS = 1_500_000
BLOCKS = 64
#: texts at a time; lanes of few texts would stay half empty
TEXTS = 4000
END = b""


def tokens(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The tokens of a batch's texts, one text after the other, and where each text begins.

    Arrow's functions for ASCII know A-Z and the six blanks of ASCII only, in bytes of any kind.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column("text"), "")))
    found = lists.flatten().cast(pa.binary())
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    word = pc.binary_length(found).to_numpy(zero_copy_only=False) > 0  # blanks at an end leave an empty one
    before = np.concatenate([[0], np.cumsum(word)])[ends]
    starts = np.concatenate([[0], before + np.arange(1, len(ends) + 1)])
    take = np.full(starts[-1], len(found), np.int64)
    inner = np.ones(len(take), bool)
    inner[starts[1:] - 1] = False
    take[inner] = np.flatnonzero(word)
    return pa.concat_arrays([found, pa.array([END], pa.binary())]).take(pa.array(take)), starts


# --- counts -------------------------------------------------------------------------------------


def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """word, n of a batch."""
    table = tokens(batch)[0].value_counts()
    return pa.RecordBatch.from_arrays([table.field(0), table.field(1)], ["word", "n"])


def vocabulary(training: DataFrame) -> DataFrame:
    """word, c: how often each token stands in the training texts."""
    counts = training.select("text").mapInArrow(arrow_rows(counted, TEXTS), "word binary, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Lexicon:
    """The hot words and what the model needs of them, and the sums that the cold ones need."""

    words: list[bytes]  # by falling count
    counts: np.ndarray
    total: int  # N
    distinct: int  # V

    def __post_init__(self) -> None:
        n, k = len(self.words), GROUPS * GROUP_SIZE
        self.known = pa.array(self.words, pa.binary())
        rank = np.arange(n)
        own = rank < k
        band = np.floor(np.log2(np.maximum(self.counts, 1))).astype(int)
        bands = {b: i for i, b in enumerate(sorted(set(band[~own].tolist()), reverse=True))}
        tail = np.array([bands.get(b, 0) for b in band.tolist()], int)
        self.classes = GROUPS + len(bands) + 1
        self.cold = self.classes - 1
        group = np.where(own, rank // GROUP_SIZE, GROUPS + tail)
        symbol = np.where(own, rank, k + tail)
        weight = self.counts + 0.5
        mass = np.bincount(group, weights=weight, minlength=self.classes)
        # all types that are not hot, and one for what was never seen
        self.cold_mass = (
            self.total - float(self.counts.sum()) + 0.5 * (self.distinct - n) + 0.5
        )
        mass[self.cold] = self.cold_mass
        mass = np.maximum(mass, 1e-9)
        self.class_log = np.log(mass / mass.sum())
        self.word_log = np.full((GROUPS, GROUP_SIZE), -30.0)
        at = np.flatnonzero(own)
        self.word_log[group[at], at % GROUP_SIZE] = np.log(weight[at] / mass[group[at]])
        # one more entry for a cold word
        self.symbol = np.append(symbol, k + len(bands)).astype(np.int32)
        self.group = np.append(group, self.cold).astype(np.int32)
        self.word = np.append(np.where(own, rank % GROUP_SIZE, -1), -1).astype(np.int32)
        inner = np.where(own, 0.0, np.log(weight / mass[group]))
        self.inner = np.append(inner, 0.0)
        self.base_mass = self.total + 0.5 * (self.distinct + 1)
        self.base = np.append(np.log10(weight / self.base_mass), 0.0)
        self.symbols = k + len(bands) + 1

    def places(self, found: pa.Array) -> np.ndarray:
        """Numbers of words; cold ones have the last."""
        return pc.index_in(found, value_set=self.known).fill_null(len(self.words)).to_numpy()

    def laid(self, flat: np.ndarray, starts: np.ndarray) -> Texts:
        return Texts(self.symbol[flat], self.group[flat], self.word[flat], starts)


def lexicon(vocab: DataFrame, hot: int) -> Lexicon:
    """At most `hot` words come to the driver: those above a count that so many words reach."""
    bucket = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    buckets = vocab.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("words"), F.sum("c").alias("total"), F.min("c").alias("least")
    )
    rows = sorted(buckets.collect(), key=lambda r: -r["bucket"])  # at most 8 * 63
    total, distinct = sum(r["total"] for r in rows), sum(r["words"] for r in rows)
    taken, floor = 0, None
    for r in rows:
        if taken + r["words"] > hot or r["least"] < LEAST_COUNT:
            break
        taken, floor = taken + r["words"], r["least"]
    if floor is None:
        return Lexicon([], np.empty(0), total, distinct)
    got = vocab.where(F.col("c") >= floor).toArrow()
    words, counts = got.column("word").to_pylist(), got.column("c").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    return Lexicon([words[i] for i in order], counts[order].astype(float), total, distinct)


# --- training -----------------------------------------------------------------------------------

_kept: dict[str, tuple] = {}


def unpacked(name: str, shared) -> tuple:
    """What was broadcast under a name, unpacked once per process."""
    if name not in _kept:
        _kept.clear()
        joined, counts, total, distinct, weights = shared.value
        hot = joined.split(b"\n") if len(counts) else []
        _kept[name] = Lexicon(hot, counts, total, distinct), weights
    return _kept[name]


def packed(lex: Lexicon, net: Network) -> tuple:
    # words have no line ends; the end token is the empty word
    return b"\n".join(lex.words), lex.counts, lex.total, lex.distinct, net.weights


def trained(training: DataFrame, lex: Lexicon, net: Network) -> Network:
    """The average of copies that each trained on the texts of one partition."""
    name = uuid.uuid4().hex
    shared = training.sparkSession.sparkContext.broadcast(packed(lex, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lexical, weights = unpacked(name, shared)
        copy, seen = Network({k: v.copy() for k, v in weights.items()}), 0
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                found, starts = tokens(batch.slice(start, TEXTS))
                seen += train(copy, lexical.laid(lexical.places(found), starts))[1]
        if not seen:
            return
        flat = np.concatenate([v.ravel() for v in copy.weights.values()]).astype(np.float64) * seen
        parts = np.array_split(flat, BLOCKS)
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(range(BLOCKS), pa.int32()),
                "some": pa.array([TaskContext.get().partitionId() // 64] * BLOCKS, pa.int32()),
                "n": pa.array([float(seen)] * BLOCKS),
                "sums": pa.array([p.tobytes() for p in parts], pa.binary()),
            }
        )

    def added(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in rows["sums"].to_pylist())
        return pa.table(
            {
                "block": rows["block"].slice(0, 1),
                "some": rows["some"].slice(0, 1),
                "n": pa.array([float(np.sum(rows["n"].to_numpy()))]),
                "sums": pa.array([total.tobytes()], pa.binary()),
            }
        )

    schema = "block int, some int, n double, sums binary"
    copies = training.select("text").mapInArrow(run, schema)
    few = copies.groupBy("block", "some").applyInArrow(added, schema)  # 64 copies at the most
    rows = few.groupBy("block").applyInArrow(added, schema).collect()
    if not rows:
        return net
    flat = np.concatenate(
        [np.frombuffer(r["sums"], np.float64) / r["n"] for r in sorted(rows, key=lambda r: r["block"])]
    )
    out, at = {}, 0
    for k, v in net.weights.items():
        out[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
        at += v.size
    return Network(out)


def shares(tokens: int) -> list[Column]:
    """Which documents each round learns from; every document is in one of them at least.

    A round has `LEAST_TOKENS` or its part of the whole, whichever is more.
    """
    width = -(-PLACES // ROUNDS)
    if tokens * width < LEAST_TOKENS * PLACES:
        width = min(PLACES, -(-LEAST_TOKENS * PLACES // max(tokens, 1)))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("train")), F.lit(PLACES))
    return [F.pmod(draw - k * width, F.lit(PLACES)) < width for k in range(ROUNDS)]


def learned(training: DataFrame, lex: Lexicon) -> Network:
    net = Network.new(lex.class_log, lex.word_log, lex.symbols)
    for share in shares(lex.total):
        net = trained(training.where(share), lex, net)
    return net


# --- scores -------------------------------------------------------------------------------------

SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
    "cold array<struct<word: binary, n: int>>"
)


def cold_words(found: pa.Array, starts: np.ndarray, places: np.ndarray) -> pa.Array:
    """For each text, those of its words that stand at the places, with their counts."""
    rare = found.take(pa.array(places)).dictionary_encode()
    text = np.searchsorted(starts, places, side="right") - 1
    distinct = max(len(rare.dictionary), 1)
    pairs, n = np.unique(text * distinct + rare.indices.to_numpy(), return_counts=True)
    words = rare.dictionary.take(pa.array(pairs % distinct))
    of_text = np.bincount(pairs // distinct, minlength=len(starts) - 1)
    both = pa.StructArray.from_arrays([words, pa.array(n.astype(np.int32))], ["word", "n"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(of_text)]), pa.int32()), both)


def hot_sums(docs: DataFrame, lex: Lexicon, net: Network) -> DataFrame:
    """Sums over the hot tokens of each document, and its cold words with their counts.

    `row` names a row of the stored table; a document may stand in several.
    """
    name = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(packed(lex, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lexical, weights = unpacked(name, shared)
        network, number = Network(weights), TaskContext.get().partitionId() << 40
        last = len(lexical.words)
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(start, TEXTS)
                found, starts = tokens(batch)
                flat = lexical.places(found)
                logs = (score(network, lexical.laid(flat, starts)) + lexical.inner[flat]) / math.log(10)
                first, n = starts[:-1], batch.num_rows
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(np.arange(number, number + n)),
                        "doc_id": batch.column("doc_id"),
                        "held_out": batch.column("held_out"),
                        "n_tokens": pa.array(np.diff(starts)),
                        "n_known": pa.array(np.add.reduceat((flat < last).astype(np.int64), first)),
                        "base": pa.array(np.add.reduceat(lexical.base[flat], first)),
                        "model": pa.array(np.add.reduceat(logs, first)),
                        "cold": cold_words(found, starts, np.flatnonzero(flat == last)),
                    }
                )
                number += n

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, SCORED)


def scored(docs: DataFrame, held_out: Column, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document."""
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    training = docs.where(~F.col("held_out"))
    vocab = stored(vocabulary(training), "vocabulary")
    lex = lexicon(vocab, hot)
    if not lex.total:
        return docs.select(
            "doc_id", "held_out", (F.size(words(F.col("text"))) + 1).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_known"),
            F.lit(0).cast("long").alias("train_tokens"), F.lit(0.0).alias("base_score"),
            F.lit(0.0).alias("score"),
        )
    net = learned(training, lex)
    rows = stored(hot_sums(docs, lex, net), "scored")
    # cold words only: a word that many documents share is hot and does not take part
    floor = lex.counts[-1] if len(lex.words) else math.inf
    rare = vocab.where(F.col("c") < floor) if len(lex.words) else vocab
    listed = rows.select("row", F.explode("cold").alias("x")).select("row", "x.word", "x.n")
    met = listed.join(rare, "word", "left")
    count = F.coalesce(F.col("c"), F.lit(0))
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("cold_known"),
        F.sum(F.col("n") * F.log10(count + 0.5)).alias("cold_logs"),
        F.sum("n").alias("cold_n"),
    )
    both = rows.drop("cold").join(sums, "row", "left")
    n = F.coalesce(F.col("cold_n"), F.lit(0))
    logs = F.coalesce(F.col("cold_logs"), F.lit(0.0))
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("cold_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - n * math.log10(lex.base_mass)).alias("base_score"),
        (F.col("model") + logs - n * math.log10(lex.cold_mass)).alias("score"),
    )
