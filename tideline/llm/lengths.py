"""Documents by encoded length: one exact histogram answers every question about context limits.

Texts are encoded whole inside their partitions, and a partition passes on one count per length. The
histogram has at most as many rows as there are lengths. With suffix sums, a row for limit L says
how many documents are longer, how many tokens are kept when every document is cut at L, and which
share of documents fits: totals, quantiles and truncated totals for every limit, without a second
look at the texts.

Null and empty texts have length 0. Repeated rows count each time. Without documents there are no
rows.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import stored, texts

#: how a public byte-level vocabulary cuts text before its merges (fixed value)
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
BLOCK = 64


@cache
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("lengths", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counted(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of encoded lengths of a partition, for `mapInArrow`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(path).encode_ordinary, Counter()
        for batch in batches:
            for text in texts(batch):
                seen[len(encode(text.decode()))] += 1
        keys = sorted(seen)
        yield pa.RecordBatch.from_pydict(
            {"length": pa.array(keys, pa.int64()), "n": pa.array([seen[k] for k in keys], pa.int64())}
        )

    return run


def histogram(docs: DataFrame, vocabulary: str) -> DataFrame:
    """length, n_docs of all documents; `vocabulary` is a rank file that every executor can read."""
    counts = docs.select("text").mapInArrow(counted(vocabulary), "length long, n long")
    return counts.groupBy("length").agg(F.sum("n").alias("n_docs"))


def limits(hist: DataFrame, wanted: tuple[int, ...] = ()) -> DataFrame:
    """The histogram with its suffix sums, one row per length that occurs or is `wanted`.

    length, n_docs, n_tokens (of these documents), docs_longer, tokens_longer, tokens_at_limit
    (tokens left when documents are cut at this length), total_docs, total_tokens and fitting_share
    (documents of this length or less). Sums run inside blocks of lengths and over one row per block.
    """
    if wanted:
        spark = hist.sparkSession
        asked = spark.createDataFrame([(x, 0) for x in wanted], "length long, n_docs long")
        both = hist.select("length", "n_docs").unionByName(asked)
        hist = both.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))
    hist = stored(hist.withColumn("block", F.floor(F.col("length") / BLOCK)), "lengths")
    tokens = F.col("n_docs") * F.col("length")
    docs, total = hist.agg(F.sum("n_docs"), F.sum(tokens)).first()
    blocks = hist.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum(tokens).alias("block_tokens")
    )
    # one row per 64 lengths: the window has as many rows as the longest text has such blocks
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    later = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(after), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(after), F.lit(0)).alias("later_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length"))
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    sums = hist.select(
        "block",
        "length",
        "n_docs",
        tokens.alias("n_tokens"),
        F.coalesce(F.sum("n_docs").over(inside), F.lit(0)).alias("docs_in"),
        F.coalesce(F.sum(tokens).over(inside), F.lit(0)).alias("tokens_in"),
    )
    longer = F.col("docs_in") + F.col("later_docs")
    tokens_longer = F.col("tokens_in") + F.col("later_tokens")
    docs, total = F.lit(docs or 0).cast("long"), F.lit(total or 0).cast("long")
    return sums.join(later, "block").select(
        "length",
        "n_docs",
        "n_tokens",
        longer.alias("docs_longer"),
        tokens_longer.alias("tokens_longer"),
        (total - tokens_longer + longer * F.col("length")).alias("tokens_at_limit"),
        docs.alias("total_docs"),
        total.alias("total_tokens"),
        F.try_divide(docs - longer, docs).alias("fitting_share"),
    )


def quantile(answers: DataFrame, share: float) -> int | None:
    """The smallest length that at least this share of the documents doesn't exceed."""
    return answers.where(F.col("fitting_share") >= share).agg(F.min("length")).first()[0]
