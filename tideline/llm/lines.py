"""Lines that many documents share are dropped everywhere but in one document.

Normalised lines are exploded and hashed to 128 bits, the distinct documents of each hash are counted,
lines over the threshold are dropped, and what is left is put together again by position. Only SQL
functions are used.

A text is split at line feeds; a null or empty text is one empty line. The key of a line is the line
without blanks at its ends, with A-Z in lower case. Keys that are shorter than `min_chars` never lose
a line. A key that `min_docs` documents hold loses all its lines but those of the largest document id
that holds it. Rows that repeat an id are one document. Rows without an id are one document too, which
comes before all others. Without documents there are no rows.

A line may stand in a third of all documents. Its rows are counted with partial aggregates, and meet
its verdict under as many salts as its slot of the hash has times the rows of an average one.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stored

#: what is stripped from the ends of a line
BLANKS = " \t\n\x0b\f\r"
SLOT_BITS = 16  # of a hash: 65,536 slots whatever the number of lines
HOT = 4  # times an average slot
LEAST_ROWS = 64


def split(text: Column) -> Column:
    """The lines of a text, at least one."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key(line: Column) -> Column:
    """A line without blanks at its ends, in lower case as far as A-Z go."""
    return F.translate(F.trim(line, F.lit(BLANKS)), ascii_uppercase, ascii_lowercase)


def text_keys(text: Column) -> list[Column]:
    """128 bits that stand for a text, as two numbers."""
    known = F.coalesce(text, F.lit(""))
    return [F.xxhash64(known).alias("t1"), F.xxhash64(F.lit(1), known).alias("t2")]


def hashed(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, t1, t2, at, h1, h2, slot: each line that is long enough, by the hash of its key."""
    line = F.posexplode(split(F.col("text"))).alias("at", "line")
    # most short lines go by their bytes, before they are stripped
    long = docs.select("doc_id", *text_keys(F.col("text")), line).where(
        F.octet_length("line") >= min_chars
    )
    keyed = long.select("doc_id", "t1", "t2", "at", F.trim("line", F.lit(BLANKS)).alias("line")).where(
        F.char_length("line") >= min_chars
    )
    named = keyed.withColumn("line", key(F.col("line")))
    h1, h2 = F.xxhash64("line"), F.xxhash64(F.lit(1), "line")
    return named.select("doc_id", "t1", "t2", "at", h1.alias("h1"), h2.alias("h2")).withColumn(
        "slot", F.shiftrightunsigned("h1", 64 - SLOT_BITS).cast("int")
    )


def common(found: DataFrame, min_docs: int) -> DataFrame:
    """h1, h2, slot, keeper: the keys that lose lines, and the document that keeps them."""
    # rows of one document and key first, so that a frequent key is dealt to many tasks
    once = found.select("h1", "h2", "slot", F.struct("doc_id").alias("doc")).distinct()
    counted = once.groupBy("h1", "h2", "slot").agg(F.count("*").alias("n"), F.max("doc").alias("keeper"))
    return counted.where(F.col("n") >= min_docs).drop("n")


def salts(found: DataFrame) -> DataFrame:
    """hot_slot, salts: the slots with several times the rows of an average one; few, by the sum of rows."""
    fair = max(LEAST_ROWS, HOT * found.count() >> SLOT_BITS)
    counted = found.groupBy(F.col("slot").alias("hot_slot")).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > fair).select(
        "hot_slot", F.ceil(F.col("n") / fair).cast("int").alias("salts")
    )


def dropped(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """g_id, g1, g2, gone: per document the positions of the lines it loses, in order."""
    found = stored(hashed(docs, min_chars), "lines")
    hot = stored(salts(found), "slots")  # at most 2 ** SLOT_BITS / HOT rows of two numbers
    number = F.coalesce("salts", F.lit(1))
    salted = found.join(F.broadcast(hot), F.col("slot") == F.col("hot_slot"), "left").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "t1"), number).cast("int")
    )
    keys = common(found, min_docs).join(
        F.broadcast(hot), F.col("slot") == F.col("hot_slot"), "left"
    ).select("h1", "h2", "keeper", F.explode(F.sequence(F.lit(0), number - 1)).alias("salt"))
    lost = salted.join(keys, ["h1", "h2", "salt"]).where(
        ~F.col("doc_id").eqNullSafe(F.col("keeper.doc_id"))
    )
    # rows that repeat a document bring every position as often
    return lost.groupBy("doc_id", "t1", "t2").agg(
        F.array_sort(F.collect_set("at")).alias("gone")
    ).select(F.col("doc_id").alias("g_id"), F.col("t1").alias("g1"), F.col("t2").alias("g2"), "gone")


def left_over(lines: Column, gone: Column) -> Column:
    """The lines but those at the positions `gone`, which are sorted: the runs between them."""
    bounds = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    runs = F.transform(
        F.sequence(F.lit(1), F.size(gone) + 1),
        lambda i: F.slice(
            lines, F.element_at(bounds, i) + 2,
            F.element_at(bounds, i + 1) - F.element_at(bounds, i) - 1,
        ),
    )
    return F.flatten(runs)


def deduplicated(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """row (a struct of all columns), text (what is left of it), n_lines and n_dropped of each document."""
    gone = dropped(docs.select("doc_id", "text"), min_chars, min_docs)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = docs.select(row, F.col("doc_id").alias("k_id"), *text_keys(F.col("text")))
    same = (
        F.col("k_id").eqNullSafe(F.col("g_id"))
        & (F.col("t1") == F.col("g1")) & (F.col("t2") == F.col("g2"))
    )
    lines = split(F.col("row.text"))
    kept = F.when(F.col("gone").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(
        F.array_join(left_over(F.col("lines"), F.col("gone")), "\n")
    )
    joined = whole.join(gone, same, "left").select("row", "gone", lines.alias("lines"))
    return joined.select(
        "row", kept.alias("text"), F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
