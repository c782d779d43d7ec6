"""Hard negatives of anchors by a vertical scan of their dimensions.

A vector's components become whole numbers, so that scores (inner products) are exact. All vectors
are dealt to groups, one group to a task as columns of numbers, and the anchors stream past every
group in batches. An anchor reads the columns in the descending order of its own components' size.
After some columns a row's score lies between what it has so far and what the remaining columns can
add at the least and at the most, which follows from the least and greatest value of each column. Rows
that cannot come into any window leave the anchor's bitmap of candidates; those that are left at the
end have their exact scores.

The first scan finds the rows with the same label and the highest scores, the positives. The second
looks for the other rows, in one window of scores for each positive. A group passes on the best few of
each anchor and window, so what is shuffled does not depend on how many rows lie in a window.

Rows take part that have an id, a label and a vector without null, NaN, infinite and outsized
components (2**20 or more, whose scores a long could not hold). Shorter vectors have zeros at their
ends. Of rows that repeat an id the one with the least label and vector takes part. Without anchors
there are no rows, and an anchor without another row of its label has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import stored

SCALE, LARGEST = 256, 1 << 20
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
GROUP_ROWS = 200_000
STEP = 8  # columns read between two looks at the bitmap


def vectors(rows: DataFrame, label: Column) -> DataFrame:
    """id, label, x: whole components of the rows that take part, each id once, of one length."""
    number = lambda x: x.cast("double")
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(number(x)) < LARGEST)
    whole = F.transform("embedding", lambda x: F.floor(number(x) * float(SCALE)).cast("int"))
    known = rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: F.coalesce(sound(x), F.lit(False)))
    ).select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("x"))
    single = stored(
        known.groupBy("id").agg(F.min(F.struct("label", "x")).alias("v")).select("id", "v.*"), "vectors"
    )
    width = single.agg(F.max(F.size("x"))).first()[0] or 0
    zeros = F.array_repeat(F.lit(0), F.lit(width) - F.size("x"))
    return single.withColumn("x", F.when(F.size("x") < width, F.concat("x", zeros)).otherwise(F.col("x")))


class Columns:
    """The rows of a group, column by column, in the order of their labels."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.x = ids[order], labels[order], np.ascontiguousarray(x[order].T)
        self.low = self.x.min(1) if len(ids) else np.zeros(len(self.x), np.int64)
        self.high = self.x.max(1) if len(ids) else self.low

    def with_label(self, label: int) -> tuple[int, int]:
        """Where the rows of a label begin and end."""
        begin, end = (int(np.searchsorted(self.labels, label, side)) for side in ("left", "right"))
        return begin, end

    def scan(
        self, anchor: np.ndarray, rows: np.ndarray,
        live: Callable[[np.ndarray, np.ndarray], np.ndarray],
    ) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the rows that `live` keeps, given bounds of the scores."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        a = anchor[order]
        ends = np.stack([a * self.low[order], a * self.high[order]])
        # what the columns from a place on can add
        least, most = (
            np.concatenate([np.cumsum(e[::-1])[::-1], [0]]) for e in (ends.min(0), ends.max(0))
        )
        score = np.zeros(len(rows), np.int64)
        for start in range(0, len(a), STEP):
            some = order[start : start + STEP]
            score += a[start : start + STEP] @ self.x[some][:, rows]
            end = min(start + STEP, len(a))
            keep = live(score + least[end], score + most[end])
            rows, score = rows[keep], score[keep]
        if not len(a):
            keep = live(score, score)
            rows, score = rows[keep], score[keep]
        return rows, score


def kth(values: np.ndarray, k: int) -> int:
    """The k-th highest value, or the least there can be if there are fewer."""
    return int(np.partition(values, -k)[-k]) if len(values) >= k else np.iinfo(np.int64).min


def best(columns: Columns, rows: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The places of the first `k` rows: higher scores first, then smaller ids."""
    return np.lexsort((columns.ids[rows], -score))[:k]


def positives_in(columns: Columns, anchor: dict, k: int) -> list[tuple[int, int, int]]:
    """(0, id, score) of the best rows of the anchor's label."""
    rows = np.arange(*columns.with_label(anchor["label"]))
    rows = rows[columns.ids[rows] != anchor["id"]]

    def live(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= kth(lower, k)

    rows, score = columns.scan(anchor["x"], rows, live)
    top = best(columns, rows, score, k)
    return [(0, int(i), int(s)) for i, s in zip(columns.ids[rows[top]], score[top], strict=True)]


def negatives_in(columns: Columns, anchor: dict, k: int) -> list[tuple[int, int, int]]:
    """(window, id, score) of the best rows of other labels in each of the anchor's windows."""
    begin, end = columns.with_label(anchor["label"])
    rows = np.concatenate([np.arange(begin), np.arange(end, len(columns.ids))])
    spans = [(w, low, high) for w, (low, high) in enumerate(anchor["windows"]) if low <= high]

    def live(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(lower), bool)
        for _, low, high in spans:
            sure = lower[(lower >= low) & (upper <= high)]
            keep |= (upper >= max(low, kth(sure, k))) & (lower <= high)
        return keep

    rows, score = columns.scan(anchor["x"], rows, live)
    found = []
    for w, low, high in spans:
        inside = (score >= low) & (score <= high)
        top = best(columns, rows[inside], score[inside], k)
        found += [
            (w, int(i), int(s))
            for i, s in zip(columns.ids[rows[inside][top]], score[inside][top], strict=True)
        ]
    return found


FOUND = "anchor_id long, label long, x array<int>, found array<struct<w:int,id:long,score:long>>"


def scanned(
    rows: DataFrame, anchors: DataFrame, groups: int,
    look: Callable[[Columns, dict], list[tuple[int, int, int]]],
) -> DataFrame:
    """anchor_id, label, x, found: what `look` finds for each anchor in each group of rows.

    A task has the columns of one group, and one batch of anchors after the other.
    """
    group = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")
    no_window = F.array().cast("array<struct<low:long,high:long>>")
    dealt = rows.select(
        group.alias("g"), F.lit(0).alias("turn"), "id", "label", "x", no_window.alias("windows")
    ).unionByName(
        anchors.select(
            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("turn"),
            "id", "label", "x", "windows",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, columns = None, [], None
        for batch in batches:
            key = np.stack([batch.column("g").to_numpy(), batch.column("turn").to_numpy()])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if begin == end:
                    continue
                some = batch.slice(begin, end - begin)
                g, turn = int(key[0, begin]), int(key[1, begin])
                if g != at:
                    at, parts, columns = g, [], None
                ids, labels = some.column("id").to_numpy(), some.column("label").to_numpy()
                x = some.column("x").flatten().to_numpy().astype(np.int64).reshape(len(ids), -1)
                if turn == 0:
                    parts.append((ids, labels, x))
                    continue
                if columns is None and parts:
                    columns = Columns(*map(np.concatenate, zip(*parts, strict=True)))
                    parts = []
                if columns is None:  # a group without rows
                    continue
                windows = some.column("windows").to_pylist()
                found = []
                for i in range(len(ids)):
                    spans = [(w["low"], w["high"]) for w in windows[i]]
                    anchor = {"id": ids[i], "label": labels[i], "x": x[i], "windows": spans}
                    found.append([
                        {"w": w, "id": row, "score": score} for w, row, score in look(columns, anchor)
                    ])
                kind = pa.list_(pa.struct([("w", pa.int32()), ("id", pa.int64()), ("score", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("label"), some.column("x"), pa.array(found, kind)],
                    names=["anchor_id", "label", "x", "found"],
                )

    ordered = dealt.repartition(groups, "g").sortWithinPartitions("g", "turn")
    return ordered.mapInArrow(run, FOUND)


def ranked(found: DataFrame, key: list[str], k: int) -> DataFrame:
    """The first `k` rows of each key, with their `rank`."""
    order = Window.partitionBy(*key).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(
    rows: DataFrame, label: Column, is_anchor: Column, positives: int = POSITIVES,
    negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` has vec_id, label and embedding; `label` is the label to go by, and `is_anchor` says which
    ids (the column `id`) are anchors. A negative of a positive has between `low` and `high` percent
    of the positive's score.
    """
    known = stored(vectors(rows, label), "rows")
    spark = rows.sparkSession
    groups = max(spark.sparkContext.defaultParallelism, -(-known.count() // group_rows))
    anchors = known.where(is_anchor).withColumn(
        "windows", F.array().cast("array<struct<low:long,high:long>>")
    )
    near = scanned(known, anchors, groups, lambda c, a: positives_in(c, a, positives))
    near = near.select("anchor_id", "label", "x", F.explode("found").alias("f")).select(
        "anchor_id", "label", "x", "f.id", "f.score"
    )
    chosen = ranked(near, ["anchor_id"], positives)
    exact = F.col("score").cast("decimal(20,0)")
    span = F.struct(
        F.ceil(exact * low / 100).cast("long").alias("low"),
        F.floor(exact * high / 100).cast("long").alias("high"),
    )
    listed = chosen.groupBy("anchor_id").agg(
        F.first("label").alias("label"), F.first("x").alias("x"),
        F.array_sort(F.collect_list(F.struct("rank", "id", "score", span.alias("span")))).alias("near"),
    )
    listed = stored(listed, "positives")
    asked = listed.select(
        F.col("anchor_id").alias("id"), "label", "x", F.col("near.span").alias("windows")
    )
    far = scanned(known, asked, groups, lambda c, a: negatives_in(c, a, negatives))
    far = far.select("anchor_id", F.explode("found").alias("f")).select("anchor_id", "f.*")
    last = ranked(far, ["anchor_id", "w"], negatives)
    named = listed.select(F.col("anchor_id").alias("of"), F.posexplode("near").alias("at", "p"))
    return last.join(named, (F.col("anchor_id") == F.col("of")) & (F.col("w") == F.col("at"))).select(
        "anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
