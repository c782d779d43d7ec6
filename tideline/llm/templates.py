"""Benchmark items that leaked into documents, also with other numbers, names or units.

Text becomes a template: words are runs of letters and digits in lower case, and a number, a unit or
a name (a capitalised word inside a sentence) is a placeholder of its type. Windows of eight template
words are hashed, and documents meet items in a hash join on those hashes. Template windows of an item
with fewer than five literal words say too little and are left out. Every item is also looked for by
its windows of eight words as they stand, in lower case and whatever stands between them, since a
copy in another case or wrapped at other columns has other names. Matches on one diagonal (the same
distance between document and item) belong together, and their slots have to be consistent: a value of
the item stands for one value of the document, the one of most of its mentions, and the other way
round. Windows with a mention that says otherwise do not count, nor do those of a tie. An item has
leaked if its consistent diagonals cover a quarter of its windows, or of those that make good templates.

Everything is SQL functions and joins. The items' windows are stored first, so that Spark knows
their size and may broadcast them or not. Only documents with a match are looked at again.

An item of fewer than eight words is one exact window of all its words, wherever it stands, and one of
its template, which only equals a document with as many words and needs three literal words. Null or empty texts and items, and those without letters and digits, match nothing. A document that stands in
several rows with the same id and text is reported once; without an id it is reported with a null
id. Repeated items are reported each under its id. Without items or documents there are no rows.
Columns other than doc_id, text, item_id do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stored, text_key, without

WIDTH = 8
LITERALS = 5
SHORT_LITERALS = 3
SHARE_PERCENT = 25

NUMBER, NAME, UNIT = "", "", ""
UNITS = (
    "km|m|cm|mm|mi|miles|feet|ft|inches|kg|g|mg|lb|lbs|pounds|l|ml|liters|litres|gallons|s|sec|"
    "seconds|min|minutes|h|hours|days|weeks|months|years|usd|eur|dollars|euros|cents|percent|kmh|mph"
)
NOT_WORD = f"[^\\p{{L}}\\p{{N}}{NUMBER}{NAME}{UNIT}]+"
SLOT = f"^[{NUMBER}{NAME}{UNIT}]"


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def template_words(text: Column) -> Column:
    """As many words as `raw_words` has, placeholders where a value may differ.

    A unit is one only after a number, since short units are also ordinary words.
    """
    text = F.coalesce(text, F.lit(""))
    text = F.regexp_replace(text, "(?<=[\\p{L}\\p{N},;] )\\p{Lu}\\p{Ll}+", NAME)
    text = F.regexp_replace(text, "\\p{N}+", NUMBER)
    text = F.regexp_replace(text, f"(?i)(?<={NUMBER} )({UNITS})(?![\\p{{L}}\\p{{N}}])", UNIT)
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def windows(template: Column) -> Column:
    """Hashes of the windows of a template, by position; a short one has one hash of all its words."""
    n = F.size(template)
    return F.when(
        n >= WIDTH,
        F.transform(
            F.sequence(F.lit(0), n - WIDTH),
            lambda i: F.xxhash64(*[F.get(template, i + k) for k in range(WIDTH)]),
        ),
    ).when(n > 0, F.array(F.xxhash64(F.array_join(template, " "), n)))


def exact_windows(raw: Column, width: int) -> Column:
    """Hashes of the windows of `width` words as they stand, by position."""
    n = F.size(raw)
    return F.when(
        n >= width,
        F.transform(
            F.sequence(F.lit(0), n - width),
            lambda i: F.xxhash64(F.lit("exact"), *[F.get(raw, i + k) for k in range(width)]),
        ),
    )


def listed(hashes: Column, width: Column) -> Column:
    """Hashes by position as an array of hash, at, width; none if there are no hashes."""
    rows = F.transform(
        hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"), width.cast("int").alias("width"))
    )
    return F.coalesce(rows, F.array().cast("array<struct<hash:bigint,at:int,width:int>>"))


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, hash, at, width, good, n_windows, n_good: the windows to look for, and how many an item has.

    `width` is 0 for a window of the template and the number of words for an exact one. A place is
    good if its template says enough.
    """
    words = items.select(
        "item_id", template_words(F.col("text")).alias("template"), raw_words(F.col("text")).alias("raw")
    )
    narrow = F.size("template") < WIDTH

    def says_enough(window: Column) -> Column:
        some = F.slice(F.col("template"), window["at"] + 1, WIDTH)
        literal = F.size(F.filter(some, lambda w: ~w.rlike(SLOT)))
        return literal >= F.when(narrow, SHORT_LITERALS).otherwise(LITERALS)

    good = words.select(
        "item_id", "raw",
        F.filter(listed(windows(F.col("template")), F.lit(0)), says_enough).alias("good"),
    )
    exact = F.coalesce(*[
        F.when(F.least(F.size("raw"), F.lit(WIDTH)) == w, listed(exact_windows(F.col("raw"), w), F.lit(w)))
        for w in range(1, WIDTH + 1)
    ], listed(F.lit(None).cast("array<bigint>"), F.lit(0)))
    both = good.select(
        "item_id", F.col("good.at").alias("places"), F.size(exact).alias("n_windows"),
        F.size("good").alias("n_good"), F.explode(F.concat("good", exact)).alias("w"),
    )
    return both.select(
        "item_id", "n_windows", "n_good", "w.*", F.array_contains("places", F.col("w.at")).alias("good")
    )


def probed(docs: DataFrame, widths: list[int]) -> DataFrame:
    """doc_id, text_key, doc_at, hash, width: the windows of the documents, with the hashes that
    `windows` and, for each of `widths`, `exact_windows` give.

    A row for each word brings the words behind it, so that Spark compiles the hashing; functions of
    array elements are not compiled.
    """
    raw = [raw_words(F.col("text")).alias("raw")] * bool(widths)
    split = docs.select(
        "doc_id", text_key(F.col("text")).alias("text_key"), template_words(F.col("text")).alias("t"), *raw
    )
    n = F.size("t")
    behind = {"t": range(WIDTH), **({"raw": range(max(widths))} if widths else {})}
    names = [f"{c}{k}" for c, places in behind.items() for k in places]
    # a slice that starts behind the end is empty
    runs = [F.slice(F.col(c), k + 1, F.greatest(n, F.lit(1))).alias(f"{c}{k}") for c, places in behind.items() for k in places]
    # outer, as a plain one makes a filter of the whole expression and moves it below the split
    placed = split.select(
        "doc_id", "text_key", n.alias("n"),
        F.when((n > 0) & (n < WIDTH), F.xxhash64(F.array_join("t", " "), n)).alias("short"),
        F.posexplode_outer(F.arrays_zip(*runs)).alias("doc_at", "w"),
    ).select("doc_id", "text_key", "n", "short", "doc_at", *[F.col(f"w.{c}").alias(c) for c in names])
    left = F.col("n") - F.col("doc_at")
    hashes = [
        F.struct(
            F.when(left >= WIDTH, F.xxhash64(*[f"t{k}" for k in range(WIDTH)]))
            .when(F.col("doc_at") == 0, F.col("short")).alias("hash"),
            F.lit(0).alias("width"),
        )
    ] + [
        F.struct(
            F.when(left >= w, F.xxhash64(F.lit("exact"), *[f"raw{k}" for k in range(w)])).alias("hash"),
            F.lit(w).alias("width"),
        )
        for w in sorted(widths)
    ]
    listed = placed.select("doc_id", "text_key", "doc_at", F.explode(F.array(*hashes)).alias("w"))
    return listed.select("doc_id", "text_key", "doc_at", "w.hash", "w.width")


def matches(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, text_key, item_id, n_windows, n_good, shift, at, good: the places that match at a shift."""
    # at most as many as a window has words
    widths = [r.width for r in wanted.where("width > 0").select("width").distinct().collect()]
    probes = probed(docs, widths)
    met = probes.join(wanted, ["hash", "width"])
    diagonal = ["doc_id", "text_key", "item_id", "n_windows", "n_good", "shift"]
    return (
        met.withColumn("shift", F.col("doc_at") - F.col("at"))
        .groupBy(*diagonal)
        .agg(  # at most the windows of one item
            F.collect_set("at").alias("at"), F.collect_set(F.when(F.col("good"), F.col("at"))).alias("good")
        )
    )


def reached(share_percent: int, places: Column, good: Column) -> Column:
    """Whether the matched places are enough of all windows, or the good ones of all good ones."""
    return (100 * places >= share_percent * F.col("n_windows")) | (
        (F.col("n_good") > 0) & (100 * good >= share_percent * F.col("n_good"))
    )


def leaks(docs: DataFrame, items: DataFrame, share_percent: int = SHARE_PERCENT) -> DataFrame:
    """doc_id, text_key, item_id, n_windows, n_matched, first_word, n_slots, n_changed, reparameterised.

    One row per document and item. `first_word` is where the match begins in the document, counted
    from 0; `n_changed` counts the slot values of the item that the document has replaced.
    """
    items = items.select("item_id", "text")
    wanted = stored(item_windows(items), "windows")
    found = matches(docs.select("doc_id", "text"), wanted)
    # what can't reach the share even with all diagonals taken together needs no second look
    whole = found.groupBy("doc_id", "text_key", "item_id").agg(
        F.first("n_windows").alias("n_windows"),
        F.first("n_good").alias("n_good"),
        F.collect_list(F.struct("shift", "at", "good")).alias("diagonals"),
    )
    upper = [F.size(F.array_distinct(F.flatten(F.col("diagonals")[c]))) for c in ("at", "good")]
    likely = stored(whole.where(reached(share_percent, *upper)), "likely")
    texts = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text").join(
        likely.select("doc_id", "text_key").distinct().withColumnRenamed("doc_id", "id").alias("l"),
        F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("l.text_key") == text_key(F.col("text"))),
        "left_semi",
    )
    texts = texts.groupBy("doc_id", "text_key").agg(F.first("text").alias("text"))
    left = texts.select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key"), raw_words(F.col("text")).alias("doc")
    )
    right = items.select(
        F.col("item_id").alias("item"),
        raw_words(F.col("text")).alias("item_words"),
        template_words(F.col("text")).alias("template"),
    )
    pairs = likely.join(
        left, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    ).join(right, F.col("item_id").eqNullSafe(F.col("item")))
    one = pairs.select(
        "doc_id", "text_key", "item_id", "n_windows", "n_good", "doc", "item_words", "template",
        F.explode("diagonals").alias("d"),
    )
    covered = F.array_distinct(
        F.flatten(F.transform("d.at", lambda a: F.sequence(a, F.least(
            a + WIDTH - 1, F.size("template") - 1))))
    )
    slots = F.filter(covered, lambda k: F.get(F.col("template"), k).rlike(SLOT))
    one = one.select(
        "doc_id", "text_key", "item_id", "n_windows", "n_good", "d",
        F.transform(slots, lambda k: F.struct(
            k.alias("k"),
            F.struct(
                F.get(F.col("template"), k).alias("kind"),
                F.get(F.col("item_words"), k).alias("item"),
                F.get(F.col("doc"), k + F.col("d.shift")).alias("doc"),
            ).alias("slot"),
        )).alias("mentions"),
    )
    one = one.withColumn("counted", F.transform(
        F.array_distinct(F.transform("mentions", lambda m: m["slot"])),
        lambda s: F.struct(
            s.alias("slot"), F.size(F.filter("mentions", lambda m: m["slot"] == s)).alias("n")
        ),
    ))

    def against(x: Column, y: Column) -> Column:
        """Whether y gives another value for x's with as many mentions."""
        same = (x["slot"]["item"] == y["slot"]["item"]) | (x["slot"]["doc"] == y["slot"]["doc"])
        return (x["slot"] != y["slot"]) & (x["slot"]["kind"] == y["slot"]["kind"]) & same & (y["n"] >= x["n"])

    doubtful = F.transform(
        F.filter("counted", lambda x: F.exists("counted", lambda y: against(x, y))), lambda x: x["slot"]
    )
    one = one.withColumn("doubtful", doubtful)
    one = one.withColumn("bad", F.transform(
        F.filter("mentions", lambda m: F.array_contains(F.col("doubtful"), m["slot"])), lambda m: m["k"]
    ))
    one = one.withColumn("at", F.filter("d.at", lambda a: ~F.exists("bad", lambda k: k.between(a, a + WIDTH - 1))))
    consistent = one.where(F.size("at") > 0).select(
        "doc_id", "text_key", "item_id", "n_windows", "n_good", "at", F.col("d.shift").alias("shift"),
        F.array_intersect("at", F.col("d.good")).alias("good"),
        F.transform(
            F.filter("mentions", lambda m: F.exists("at", lambda a: m["k"].between(a, a + WIDTH - 1))),
            lambda m: m["slot"],
        ).alias("slots"),
    )
    slots = F.array_distinct(F.flatten(F.collect_list("slots")))
    out = consistent.groupBy("doc_id", "text_key", "item_id").agg(
        F.first("n_windows").alias("n_windows"),
        F.first("n_good").alias("n_good"),
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("n_matched"),
        F.size(F.array_distinct(F.flatten(F.collect_list("good")))).alias("n_good_matched"),
        F.min(F.col("shift") + F.array_min("at")).cast("long").alias("first_word"),
        slots.alias("slots"),
    )
    changed = F.size(F.filter("slots", lambda s: ~s["item"].eqNullSafe(s["doc"])))
    return out.where(reached(share_percent, F.col("n_matched"), F.col("n_good_matched"))).select(
        "doc_id", "text_key", "item_id", "n_windows", "n_matched", "first_word",
        F.size("slots").cast("long").alias("n_slots"),
        changed.cast("long").alias("n_changed"),
        (changed > 0).alias("reparameterised"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no item has leaked, with all their columns."""
    return without(docs, stored(leaks(docs, items).select("doc_id", "text_key").distinct(), "leaked"))
