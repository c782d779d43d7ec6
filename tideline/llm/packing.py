"""Best-fit packing of documents into sequences of several permitted lengths.

Lengths are dealt evenly to shards of a bounded number of pieces, whatever their ids. A shard packs
its pieces from the longest to the shortest: a piece goes to the open bin that it fills best, and
otherwise opens a bin. Which size that bin gets is decided jointly for all sizes: from the histogram
of the pieces still to come, less those that bins already open count on, each size is filled on
paper, and the one of least cost per token held is opened. At the end every bin is downsized to the
smallest size that takes its contents. A size costs its tokens plus a fixed overhead for each
sequence. A shard is also packed with each size as the only one to open, and the cheapest packing
stays, so a choice of sizes is never dearer than one size.

A document longer than the largest size is cut into pieces of that size and one rest; nothing is
dropped. A null or empty text still has its end token. Repeated rows are packed each time. Ids may
be null. Without documents there are no rows. Other columns than those named are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import size_hint, stored, words

SIZES = (512, 1024, 2048, 4096)
OVERHEAD = 16
PIECES_PER_SHARD = 20_000
SCHEMA = "doc_id long, piece int, start long, length int, shard int, bin int, capacity int, offset int"


def word_length(text: Column) -> Column:
    """Words and one end token."""
    return F.size(words(text)) + 1


class Ahead:
    """The pieces still to come, by length, without those that an open bin counts on."""

    def __init__(self, lengths: list[int]):
        self.count = Counter(lengths)
        self.promised: Counter[int] = Counter()
        self.sorted = sorted(self.count)

    def taken(self, length: int, opens: bool) -> None:
        """A piece has come; unless it opens a bin, one of its length had been promised, if any was."""
        if not opens and self.promised[length]:
            self.promised[length] -= 1
        else:
            self.remove(length, 1)

    def remove(self, length: int, n: int) -> None:
        left = self.count[length] - n
        if left > 0:
            self.count[length] = left
        elif self.count.pop(length, 0):
            del self.sorted[bisect_left(self.sorted, length)]

    def filling(self, free: int) -> list[tuple[int, int]]:
        """(length, number) of what would fill so much space, always the longest that fits."""
        plan, at = [], bisect_right(self.sorted, free)
        while at:
            length = self.sorted[at - 1]
            n = min(free // length, self.count[length])
            plan.append((length, n))
            free -= n * length
            at = bisect_right(self.sorted, free, 0, at - 1)
        return plan

    def promise(self, plan: list[tuple[int, int]]) -> None:
        for length, n in plan:
            self.remove(length, n)
            self.promised[length] += n


def opened(length: int, ahead: Ahead, sizes: tuple[int, ...], overhead: int) -> int:
    """The size of least cost for each token that a bin starting with `length` will hold.

    What it will hold is planned for every size from the pieces to come that no open bin counts on;
    the plan of the chosen size is promised to the new bin.
    """
    plans = {s: ahead.filling(s - length) for s in sizes if s >= length}

    def price(size: int) -> tuple[float, int]:
        held = length + sum(x * n for x, n in plans[size])
        return (downsized(held, sizes) + overhead) / held, size

    best = min(plans, key=price)
    ahead.promise(plans[best])
    return best


def downsized(used: int, sizes: tuple[int, ...]) -> int:
    return next(s for s in sizes if s >= used)


def placed(lengths: list[int], sizes: tuple[int, ...], overhead: int, least: int = 0):
    """Bin and offset of each piece, and the size that every bin had and has after downsizing.

    With `least`, bins open at that size or the next that takes the piece; else the size is chosen.
    """
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    ahead = None if least else Ahead(lengths)
    spaces: list[tuple[int, int]] = []  # (free tokens, bin), sorted
    size, used = [], []
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for i in order:
        n = lengths[i]
        at = bisect_left(spaces, (n, -1))
        opens = at == len(spaces)
        if ahead:
            ahead.taken(n, opens)
        if opens:
            b = len(size)
            free = opened(n, ahead, sizes, overhead) if ahead else downsized(max(n, least), sizes)
            size.append(free)
            used.append(0)
        else:
            free, b = spaces.pop(at)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        if free > n:
            insort(spaces, (free - n, b))
    return bins, offsets, size, [downsized(u, sizes) for u in used]


def pack(lengths: list[int], sizes: tuple[int, ...] = SIZES, overhead: int = OVERHEAD):
    """Bin, offset and capacity of each piece of one shard.

    Besides the joint choice of sizes, every size is tried as the only one to open; the cheapest
    packing stays, the joint one in a tie.
    """
    tried = [placed(lengths, sizes, overhead, least) for least in (0, *sizes)]
    bins, offsets, _, final = min(tried, key=lambda t: sum(t[3]) + overhead * len(t[3]))
    return bins, offsets, [final[b] for b in bins]


def packed(
    sizes: tuple[int, ...], overhead: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got)
        bins, offsets, capacity = pack(rows["length"].to_pylist(), sizes, overhead)
        shard = np.full(len(bins), TaskContext.get().partitionId(), np.int32)
        whole = pa.table(
            {
                **{c: rows[c] for c in ("doc_id", "piece", "start", "length")},
                "shard": shard,
                "bin": pa.array(bins, pa.int32()),
                "capacity": pa.array(capacity, pa.int32()),
                "offset": pa.array(offsets, pa.int32()),
            }
        )
        yield from whole.to_batches(10_000)

    return run


def pieces(lengths: DataFrame, largest: int) -> DataFrame:
    """doc_id, piece, start, length: documents of `tokens` tokens cut at the largest size."""
    cut = lengths.select("doc_id", F.greatest("tokens", F.lit(1)).alias("tokens"))
    return cut.select(
        "doc_id",
        "tokens",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / largest).cast("int"))).alias("piece"),
    ).select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * largest).alias("start"),
        F.least(F.col("tokens") - F.col("piece") * largest, F.lit(largest)).cast("int").alias("length"),
    )


def best_fit(
    docs: DataFrame,
    length: Column | None = None,
    sizes: tuple[int, ...] = SIZES,
    overhead: int = OVERHEAD,
    pieces_per_shard: int = PIECES_PER_SHARD,
) -> DataFrame:
    """doc_id, piece, start, length and where it goes: shard, bin, capacity, offset.

    `length` is a document's number of tokens, by default its words and an end. A shard and a bin
    name a sequence; its pieces lie at their offsets without gaps.
    """
    sizes = tuple(sorted(sizes))
    length = word_length(F.col("text")) if length is None else length
    lengths = stored(docs.select("doc_id", length.cast("long").alias("tokens")), "lengths")
    cut = pieces(lengths, sizes[-1])
    # dealt in turn, without a key: copies of a row or a hot source don't meet in one shard
    dealt = cut.repartition(size_hint(cut, pieces_per_shard))
    return dealt.mapInArrow(packed(sizes, overhead), SCHEMA)
