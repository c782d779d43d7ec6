"""Quality rules whose thresholds adapt to each language and source.

Every document is measured with SQL functions alone. Each measure is an integer per mille, and its
distribution in a language and source is kept as a sketch: counts by cell, where a cell is the value
with all but its seven leading bits cleared. Sketches of sources add up to that of their language
and those to the whole corpus, exactly and in any order. A threshold stands a number of quartile
distances from its group's median, and at least a set distance, so that a group of equal documents
rejects none of them; a group with few documents takes the quartiles of its language, or of all
documents. The distance is that of the first quartile to the median: junk has high values, and up to
half of a group it only moves the median within the good documents. Thresholds meet documents in a join on language and source, in which Spark may broadcast the thresholds by their size and may
split a hot source.

Null and empty texts have no words, all counts zero, and fail the base rule. A null language or
source is a group of its own. Repeated rows are measured and judged each time. Columns of the input
travel in one struct, so none can clash. Without documents there are no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import stored, words

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
MIN_GROUP = 50
SPREAD = 8


@dataclass(frozen=True)
class Measure:
    """1000 * `part` / `whole`. Its limit is at least `floor` and `share` of the median away from it."""

    name: str
    part: str
    whole: str
    floor: int
    share: float = 0.0
    above: bool = True


MEASURES = (
    Measure("symbols", "n_symbols", "n_words", 100),
    Measure("upper", "n_upper", "word_chars", 350),
    Measure("dup_lines", "n_dup_lines", "n_lines", 400),
    Measure("long_words", "word_chars", "n_words", 1000, 0.5),
    Measure("short_words", "word_chars", "n_words", 1000, 0.5, above=False),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def removed(text: Column, pattern: str) -> Column:
    """How many characters of a set a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measured(docs: DataFrame) -> DataFrame:
    """row (all columns of the document as a struct), lang, source and the counts of its text.

    A word is repeated if it lies in an 8-word window that occurs twice or more in its text. Windows
    are compared by a 64-bit hash, inside the row: only texts with a repeated window sort theirs.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    df = df.select(
        "row",
        text.alias("text"),
        words(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    count = F.size("words")
    hashes = F.when(
        count > WINDOW,
        F.transform(
            F.sequence(F.lit(0), count - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)]),
        ),
    )
    df = df.select(
        "row",
        count.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        removed(F.col("text"), "[#*$%&|<>]").cast("long").alias("n_symbols"),
        removed(F.col("text"), "[A-Z]").cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("hashes"),
    )
    rest = ["row", "n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines"]
    ordered = F.sort_array(
        F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    df = df.select(
        *rest,
        F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), ordered).alias("ordered"),
    )

    def twice(x: Column, j: Column) -> Column:
        before = F.get(F.col("ordered"), j - 1)["h"]
        after = F.get(F.col("ordered"), j + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    df = df.select(
        *rest,
        F.sort_array(F.transform(F.filter("ordered", twice), lambda x: x["i"])).alias("at"),
    )
    covered = F.aggregate(
        F.transform(
            "at",
            lambda p, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(F.col("at"), j + 1) - p, F.lit(WINDOW))
            ),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    return df.select(
        F.col("row.lang").alias("lang"),
        F.col("row.source").alias("source"),
        *rest,
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def per_mille(measure: Measure) -> Column:
    whole = F.greatest(F.col(measure.whole), F.lit(1))
    return F.floor(F.lit(1000) * F.col(measure.part) / whole).cast("long")


def cell(value: Column) -> Column:
    """The value with all but its seven leading bits cleared."""
    width = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return value - value % F.call_function("shiftleft", F.lit(1).cast("long"), width)


def sketches(measures: DataFrame) -> DataFrame:
    """lang, source, measure, cell, n over the documents that pass the base rule."""
    cells = F.array(
        *[F.struct(F.lit(m.name).alias("measure"), cell(per_mille(m)).alias("cell")) for m in MEASURES]
    )
    passed = measures.where(~base_failed()).select("lang", "source", F.explode(cells).alias("c"))
    return passed.groupBy("lang", "source", "c.measure", "c.cell").agg(F.count("*").alias("n"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, measure, n, q25, q50, q75: merged sketches and the cells where their quartiles lie."""
    merged = sketch.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))
    # a group has at most as many rows as there are cells
    group = Window.partitionBy(*keys, "measure")
    up = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.select(
        *keys, "measure", "cell", F.sum("n").over(up).alias("up"), F.sum("n").over(group).alias("all")
    )
    return ranked.groupBy(*keys, "measure").agg(
        F.max("all").alias("n"),
        *[
            F.min(F.when(F.col("up") * 4 >= F.col("all") * k, F.col("cell"))).alias(f"q{25 * k}")
            for k in (1, 2, 3)
        ],
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source and a limit for each measure."""
    own = quartiles(sketch, ["lang", "source"]).select(
        "lang", "source", "measure", *[F.col(c).alias(f"s_{c}") for c in ("n", "q25", "q50", "q75")]
    )
    by_lang = quartiles(sketch, ["lang"]).select(
        F.col("lang").alias("l_lang"),
        F.col("measure").alias("l_measure"),
        *[F.col(c).alias(f"l_{c}") for c in ("n", "q25", "q50", "q75")],
    )
    every = quartiles(sketch, []).select(
        F.col("measure").alias("e_measure"),
        *[F.col(c).alias(f"e_{c}") for c in ("n", "q25", "q50", "q75")],
    )
    joined = own.join(
        by_lang,
        F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("measure") == F.col("l_measure")),
    ).join(every, F.col("measure") == F.col("e_measure"))

    def chosen(c: str) -> Column:
        return (
            F.when(F.col("s_n") >= MIN_GROUP, F.col(f"s_{c}"))
            .when(F.col("l_n") >= MIN_GROUP, F.col(f"l_{c}"))
            .otherwise(F.col(f"e_{c}"))
        )

    middle = chosen("q50")

    def limit(m: Measure) -> Column:
        # the half below the median: junk of less than half of a group does not widen it
        spread = middle - chosen("q25")
        least = F.greatest(F.lit(m.floor), F.floor(middle * m.share))
        away = F.greatest(SPREAD * spread, least)
        value = middle + away if m.above else middle - away
        return F.max(F.when(F.col("measure") == m.name, value)).alias(f"{m.name}_limit")

    return joined.groupBy("lang", "source").agg(*[limit(m) for m in MEASURES])


def limits_of(measures: DataFrame) -> DataFrame:
    """t_lang, t_source and the limits, stored; `measures` is read once."""
    sketch = stored(sketches(measures), "sketch")
    return stored(thresholds(sketch), "limits").select(
        F.col("lang").alias("t_lang"), F.col("source").alias("t_source"),
        *[f"{m.name}_limit" for m in MEASURES],
    )


def verdicts(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """`measures` with base_failed, kept and each rule's limit."""
    joined = measures.join(
        limits,
        F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")),
        "left",
    )
    broken = F.lit(False)
    for m in MEASURES:
        value, bound = per_mille(m), F.col(f"{m.name}_limit")
        # a group of which no document passed the base rule has no limits
        broken |= F.coalesce(value > bound if m.above else value < bound, F.lit(False))
    failed = base_failed()
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~broken})


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts of the base rule, base_failed, kept and all limits."""
    narrow = docs.select("doc_id", "text", "lang", "source")
    found = measured(narrow)
    found = stored(found.select(F.col("row.doc_id").alias("doc_id"), *found.drop("row").columns), "measures")
    return verdicts(found, limits_of(found)).drop("t_lang", "t_source")


def settled(measures: DataFrame) -> DataFrame:
    """`measures` out of a generator: no filter on them is pushed below it, where it would measure again."""
    found = F.struct(*[c for c in measures.columns if c != "row"])
    return measures.select("row", F.inline(F.array(found)))


def kept(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns.

    Texts are measured twice, for the limits and for the verdict, so that none is written or shuffled
    on the way: all that is stored are the sketches and the limits.
    """
    limits = limits_of(settled(measured(docs.select("text", "lang", "source"))))
    return verdicts(settled(measured(docs)), limits).where("kept").select("row.*")
