"""What the operators share: words, folds of documents, Arrow steps, rows kept in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import stored, table

__all__ = ["GAP", "arrow_rows", "documents", "fold", "size_hint", "stored", "table", "text_key",
           "texts", "without", "words"]

#: what stands between words, as a Java regular expression
GAP = "[\\x20\\x09-\\x0D]+"


def text_key(text: Column) -> Column:
    """A 64-bit hash of a text; with the id it names a document whose id may be null or repeated."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """`docs` without the documents in `gone` (doc_id, text_key, each once)."""
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"))
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (text_key(docs["text"]) == gone["gone_key"])
    return docs.join(gone, same, "left_anti")


def words(text: Column) -> Column:
    """The words of a text, an empty array for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo `n`. A null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A column of texts as UTF-8; a null is the empty text.

    `bytes.lower` and `bytes.split` know A-Z and the six blanks of ASCII only, which is what the
    words here are made of.
    """
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def arrow_rows(
    step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch | None],
    rows: int = 2000,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for `mapInArrow` that applies `step` to slices of at most `rows` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                made = step(batch.slice(start, rows))
                if isinstance(made, pa.RecordBatch):
                    yield made
                elif made is not None:
                    yield from made

    return run


def size_hint(df: DataFrame, rows_per_part: int, at_least: int = 1) -> int:
    """A number of partitions that follows the number of rows."""
    return max(at_least, -(-df.count() // rows_per_part))
