"""Near-duplicate documents by an LSH forest of MinHash signatures.

A document is the set of its word shingles, hashed to 64 bits. Documents with equal sets are one
class, so copies never meet each other. A class has 96 MinHash values; a tree of the forest orders
all classes by a run of six of them. Each tree is one sorted order over the whole cluster: rows are
range-partitioned by label, so that a group of any size is spread, and partitions pass on their first
and last rows, so that neighbours meet over the ends of partitions too.

Candidates are neighbours in an order whose labels share a prefix of three values or more. Sorting
makes depth adaptive: where few classes share three values, all of them are compared; in a crowded
region the window takes those that share the longest prefix. Pairs are compared by sketch first
(four bits of each MinHash value) and those that cannot reach the similarity are dropped. In the
first round a class keeps its few best pairs in each tree; these are confirmed on full sets in joins,
the best of some trees first, and then those of the others that are still in different components.
In the second round the classes that had more pairs than they kept are sorted again, at less depth
and in a wider window, first with their sketches only: a class is marked if it meets one of another
component that may be similar. The marked ones are sorted once more, and this time their sets travel
with them: pairs between different components are confirmed where they meet, and a task passes on the
links that connect something new, of which it has fewer than rows. What is left out inside the window is therefore only a pair inside a component, which
changes nothing, and pairs that are no links are never written. Classes of regions that go on beyond
the wide window too meet in an exact join on their rarest shingles, between different components only.

MinHash misses a pair at the threshold itself in about one of 100,000 cases with 16 trees of depth
three; tests compare with all pairs.

Null and empty texts and texts without words have an empty set and are linked with nothing. A text
with fewer words than a shingle has one shingle of all its words. Equal texts, under whatever ids,
belong together; rows that repeat a document get its result each time. A null id never is the
smallest; a component of null ids only has a null id. Without documents there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import arrow_rows, size_hint, stored, text_key, texts, without
from tideline.llm.components import components

TREES, DEPTH, LEAST_DEPTH = 16, 6, 3
VALUES = TREES * DEPTH
BYTES = 3  # of each MinHash value in a label
BEST = 4
FIRST_TREES = 4  # whose best pairs are confirmed before all others
WINDOW, WIDE_WINDOW = 48, 1024
WIDE_TREES, WIDE_DEPTH = 6, 1
SLACK = 0.25  # 5.8 standard deviations of a sketch's estimate at a similarity of 0.8
ROWS_PER_PART, WIDE_ROWS_PER_PART = 20_000, 8_000
FILTER_BITS = 23
COUNT_BITS, SALT_ROWS = 20, 4096
COUNT_MASK = np.uint64((1 << COUNT_BITS) - 1)

MIX = np.uint64(0x9E3779B97F4A7C15)
MULTIPLIERS = np.random.default_rng(3).integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """Hashes of words by word, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()


def shingles(text: bytes, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    k = min(width, len(words))
    code = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        code = mixed(code * MIX + h[j : len(h) - k + 1 + j])
    return np.unique(code)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of non-empty sets, 24 bits each."""
    if not sets:
        return np.empty((0, VALUES), np.uint32)
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), VALUES), np.uint64)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat(flat * MULTIPLIERS[k], starts)
    return (mixed(out) >> np.uint64(40)).astype(np.uint32)


def fixed_binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    rows = np.ascontiguousarray(rows)
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())]
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of equal widths as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def digest(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_shingles, fp (of the set, null if empty), sig."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, width) for t in texts(batch)]
        full = [s for s in sets if len(s)]
        sig = signatures(full).astype("<u4").view(np.uint8).reshape(len(full), VALUES, 4)[:, :, :BYTES]
        sigs = iter(map(bytes, sig.reshape(len(full), VALUES * BYTES)))
        fps = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "text_key": batch.column("text_key"),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "fp": pa.array(fps, pa.binary()),
                "sig": pa.array([next(sigs) if len(s) else None for s in sets], pa.binary()),
            }
        )

    return docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key")).mapInArrow(
        arrow_rows(step, 200), "doc_id long, text_key long, n_shingles long, fp binary, sig binary"
    )


# --- the forest ---------------------------------------------------------------------------------

ROW = "label binary, fp binary, n int, sketch binary"


def planted(classes: DataFrame, trees: int) -> DataFrame:
    """label, fp, n, sketch and, if there are such, root and members: a row for each class and tree."""
    keep = [c for c in ("root", "members") if c in classes.columns]

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sig = matrix(batch.column("sig"), VALUES * BYTES).reshape(-1, VALUES, BYTES)
        low = sig[:, :, 0] & 15
        sketch = fixed_binary(low[:, ::2] | (low[:, 1::2] << 4))
        for tree in range(trees):
            run = sig[:, tree * DEPTH : (tree + 1) * DEPTH].reshape(len(sig), -1)
            label = np.column_stack([np.full(len(sig), tree, np.uint8), run])
            yield pa.RecordBatch.from_arrays(
                [fixed_binary(label), batch.column("fp"), batch.column("n"), sketch]
                + [batch.column(c) for c in keep],
                names=["label", "fp", "n", "sketch", *keep],
            )

    rows = classes.select("fp", F.col("n").cast("int").alias("n"), "sig", *keep)
    return rows.mapInArrow(arrow_rows(step), ROW + "".join(f", {c} binary" for c in keep))


class Confirm:
    """Links between rows of different roots, those only that connect something new."""

    def __init__(self, rows: pa.Table, start: np.ndarray, percent: int) -> None:
        self.start = start
        self.parent = list(range(int(self.start.max()) + 1))
        self.members, self.percent = rows["members"], percent

    def find(self, a: int) -> int:
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def links(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            a, b = self.find(int(self.start[i])), self.find(int(self.start[j]))
            if a != b and similar(self.members[i].as_py(), self.members[j].as_py(), self.percent):
                self.parent[a] = b
                found.append((i, j))
        both = np.array(found, np.int32).reshape(-1, 2)
        return both[:, 0], both[:, 1]


def similar(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two sets of 64-bit hashes, sorted and without repeats, are similar enough."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def least_alike(percent: int) -> float:
    """How many values of two sketches agree at least; 1 of 16 does by chance."""
    return VALUES * ((percent / 100 - SLACK) * 15 / 16 + 1 / 16)


@dataclass(frozen=True)
class Search:
    """Neighbours of one sorted order that share `depth` values, `window` rows apart at the most.

    With `best`, the best pairs of each row are candidates. Without, rows bring their roots, and only
    pairs of different roots count: with `mark` one pair for each row that has any, else the links,
    which are confirmed at once on the sets that the rows bring too.
    """

    percent: int
    window: int
    depth: int
    best: int = 0
    mark: bool = False

    def pairs(self, rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of rows that are candidates, and of rows that may have more, in bounded portions.

        Rows are sorted; those with a column `side` only meet rows of the other side.
        """
        n = rows.num_rows
        none = np.empty(0, np.int32)
        if n < 2:
            return
        label = matrix(rows["label"], 1 + DEPTH * BYTES)
        prefix = np.zeros((n, 16), np.uint8)
        prefix[:, : 1 + self.depth * BYTES] = label[:, : 1 + self.depth * BYTES]
        prefix = prefix.view(np.uint64)
        packed = matrix(rows["sketch"], VALUES // 2)
        sketch = np.empty((n, VALUES), np.uint8)
        sketch[:, ::2], sketch[:, 1::2] = packed & 15, packed >> 4
        size = rows["n"].to_numpy().astype(np.int64)
        side = rows["side"].to_numpy() if "side" in rows.column_names else None
        bound = rows["bound"].to_numpy() if "bound" in rows.column_names else None
        start = None
        if not self.best:
            start = np.unique(matrix(rows["root"], 16), axis=0, return_inverse=True)[1].reshape(-1)
        confirm = None if self.best or self.mark else Confirm(rows, start, self.percent)
        marked = np.zeros(n, bool)
        need = least_alike(self.percent)
        idx, left, right, alike, held = np.arange(n, dtype=np.int32), [], [], [], 0
        for k in range(1, self.window + 1):
            idx = idx[idx >= k]
            idx = idx[(prefix[idx] == prefix[idx - k]).all(1)]
            if bound is not None:
                idx = idx[bound[idx] == bound[idx - k]]
            if not len(idx):
                break
            i, j = idx, idx - np.int32(k)
            ok = 100 * np.minimum(size[i], size[j]) >= self.percent * np.maximum(size[i], size[j])
            if side is not None:
                ok &= side[i] != side[j]
            if start is not None:
                ok &= start[i] != start[j]
            if self.mark:
                ok &= ~(marked[i] & marked[j])
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            same = np.concatenate(
                [(sketch[i[s : s + 10_000]] == sketch[j[s : s + 10_000]]).sum(1, dtype=np.uint8)
                 for s in range(0, len(i), 10_000)]
            )
            good = same >= need
            if self.mark:
                i, j = i[good], j[good]
                marked[i] = marked[j] = True
                if len(i):
                    yield i, j, none
                continue
            if confirm:
                i, j = confirm.links(i[good], j[good])
                if len(i):
                    yield i, j, none
                continue
            left.append(i[good])
            right.append(j[good])
            alike.append(same[good])
            held += len(left[-1])
        else:
            # regions that go on beyond the window
            yield none, none, np.unique(np.concatenate([idx, idx - np.int32(self.window)]))
        if bound is not None:
            # next to a part that is shorter than the window others may lie beyond it
            yield none, none, self.short(side, bound)
        if not held:
            return
        left, right = np.concatenate(left), np.concatenate(right)
        # a pair stays if it is among the best of either end
        end = np.concatenate([left, right])
        key = (end.astype(np.int64) << 8) | (VALUES - np.tile(np.concatenate(alike), 2).astype(np.int64))
        order = np.argsort(key, kind="stable")
        ends = end[order]
        starts = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
        rank = np.arange(len(ends)) - np.repeat(starts, np.diff(np.r_[starts, len(ends)]))
        stays = np.zeros(len(left), bool)
        stays[order[rank < self.best] % len(left)] = True
        top = np.zeros(len(left), bool)
        top[order[rank == 0] % len(left)] = True
        top &= label[left, 0] < FIRST_TREES
        yield left[top], right[top], none, True
        stays &= ~top
        gone = ~(stays | top)
        yield left[stays], right[stays], np.unique(np.concatenate([left[gone], right[gone]]))

    def short(self, side: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Numbers of the rows at bounds of which one side has fewer rows than the window."""
        _, group = np.unique(bound, return_inverse=True)
        rows = np.bincount(2 * group + side, minlength=2 * int(group.max()) + 2).reshape(-1, 2)
        few = (rows.min(1) > 0) & (rows.min(1) < self.window)
        return np.flatnonzero(few[group]).astype(np.int32)

    def run(self, batches: Iterator[pa.RecordBatch], ends: bool) -> Iterator[pa.RecordBatch]:
        """kind 0: a pair a, b; kind 1: a class a in a crowd; kind 2: a row at an end of a partition;
        kind 3: a pair to be looked at first."""
        from pyspark import TaskContext

        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got).combine_chunks()
        fp = rows["fp"].combine_chunks()
        if isinstance(fp, pa.ChunkedArray):
            fp = pa.concat_arrays(fp.chunks)
        for left, right, crowd, *top in self.pairs(rows):
            kind = 3 if top else 0
            yield self.out(kind, a=fp.take(pa.array(left)), b=fp.take(pa.array(right)))
            yield self.out(1, a=fp.take(pa.array(crowd)))
        if ends:
            part, n = TaskContext.get().partitionId(), rows.num_rows
            for side, start in ((1, 0), (0, max(0, n - self.window))):
                some = rows.slice(start, min(self.window, n)).combine_chunks()
                m = some.num_rows
                # the end of a part and the beginning of the next have one number
                yield self.out(
                    2,
                    bound=pa.array(np.full(m, part - side), pa.int32()),
                    side=pa.array(np.full(m, side), pa.int32()),
                    **{c: some[c].combine_chunks() for c in rows.column_names},
                )

    @staticmethod
    def out(kind: int, **columns: pa.Array) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        full = {"kind": pa.array(np.full(n, kind), pa.int32())}
        for name, of in FOUND:
            column = columns.get(name)
            if isinstance(column, pa.ChunkedArray):
                column = pa.concat_arrays(column.chunks)
            full[name] = pa.nulls(n, of) if column is None else column.cast(of)
        return pa.RecordBatch.from_pydict(full)


FOUND = [
    ("a", pa.binary()), ("b", pa.binary()), ("bound", pa.int32()), ("side", pa.int32()),
    ("label", pa.binary()), ("fp", pa.binary()), ("n", pa.int32()), ("sketch", pa.binary()),
    ("root", pa.binary()), ("members", pa.binary()),
]
FOUND_SCHEMA = (
    "kind int, a binary, b binary, bound int, side int, label binary, fp binary, n int, "
    "sketch binary, root binary, members binary"
)


def candidates(
    classes: DataFrame, search: Search, trees: int, rows_per_part: int
) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, first) and classes in a crowd (a), which may stand there more than once."""
    parts = size_hint(classes, max(1, rows_per_part // trees))
    rows = planted(classes, trees).repartitionByRange(parts, "label", "fp").sortWithinPartitions("label", "fp")
    inner = stored(rows.mapInArrow(lambda b: search.run(b, True), FOUND_SCHEMA), "neighbours")
    columns = ["bound", "side", "label", "fp", "n", "sketch"]
    columns += [c for c in ("root", "members") if c in classes.columns]
    ends = inner.where("kind = 2").select(*columns)
    ends = ends.repartition("bound").sortWithinPartitions("bound", "label", "fp")
    over = ends.mapInArrow(lambda b: search.run(b, False), FOUND_SCHEMA)
    found = inner.where("kind <> 2").select("kind", "a", "b").unionByName(over.select("kind", "a", "b"))
    found = stored(found.distinct(), "candidates")
    pairs = found.where("kind in (0, 3)").groupBy(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).agg(F.max(F.col("kind") == 3).alias("first"))
    return pairs, found.where("kind = 1").select("a")


# --- confirming pairs ---------------------------------------------------------------------------


def id_filter(ids: DataFrame) -> np.ndarray:
    """Which hashes of ids occur, as 2**FILTER_BITS bits: a fixed size, whatever the number of ids."""
    mask = F.lit((1 << FILTER_BITS) - 1).cast("long")
    slot = F.xxhash64("doc_id").bitwiseAND(mask)
    bits = ids.select(
        F.floor(slot / 63).cast("int").alias("word"), (slot % 63).cast("int").alias("bit")
    )
    words = bits.groupBy("word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits")
    )
    got = words.toArrow()
    out = np.zeros((1 << FILTER_BITS) // 63 + 1, np.int64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out


def full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """fp, members: the sets of the classes in `wanted` (fp), and perhaps of some others.

    One document of a class gives its set. Texts are filtered by their ids inside the scan and never
    leave it; what the filter lets through in excess finds no partner later.
    """
    ids = classes.join(wanted, "fp", "left_semi").select(F.col("rep").alias("doc_id"))
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(ids))
    mask = F.lit((1 << FILTER_BITS) - 1).cast("long")
    slot = F.xxhash64("doc_id").bitwiseAND(mask).alias("slot")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        at = batch.column("slot").to_numpy()
        hit = (shared.value[at // 63] >> (at % 63)) & 1 == 1
        if not hit.any():
            return None
        sets = [shingles(t, width) for t in texts(batch.filter(pa.array(hit)))]
        sets = [s for s in sets if len(s)]
        return pa.RecordBatch.from_pydict(
            {
                "fp": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                "members": pa.array([s.tobytes() for s in sets], pa.binary()),
            }
        )

    found = docs.select(slot, "text").mapInArrow(arrow_rows(step, 500), "fp binary, members binary")
    return found.groupBy("fp").agg(F.first("members").alias("members"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
        keep = [similar(x, y, percent) for x, y in both]
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("fp").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("fp").alias("b"), F.col("members").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(arrow_rows(step, 1000), "a binary, b binary")


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components, given node and root."""
    for end in ("a", "b"):
        named = roots.select(F.col("node").alias(f"{end}_node"), F.col("root").alias(f"{end}_root"))
        pairs = pairs.join(named, F.col(end) == F.col(f"{end}_node"), "left")
    different = F.coalesce("a_root", "a") != F.coalesce("b_root", "b")
    return pairs.where(different).select("a", "b")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()


# --- what no window covers ----------------------------------------------------------------------


def commonness(sets: DataFrame) -> np.ndarray:
    """About how many sets have a shingle, by its slot: a fixed size, whatever the number of sets."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column("members").to_pylist()), np.uint64)
            counts += np.bincount((flat & COUNT_MASK).astype(np.int64), minlength=len(counts))
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(slots, pa.int64()), "n": pa.array(counts[slots])})

    got = sets.select("members").mapInArrow(step, "slot long, n long").groupBy("slot").agg(
        F.sum("n").alias("n")
    ).toArrow()
    out = np.zeros(1 << COUNT_BITS, np.int64)
    out[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    return out


def rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """shingle, salt, indexed, fp, root, n, at: the rarest shingles of each set, with their positions.

    All sets are ordered by the same order, rare shingles first. Two similar sets have a shingle in
    common among the first n - o + 1 of each, where o is the least overlap: `percent` of n for the
    larger set, which looks up, and more for the smaller one, which is indexed. A common shingle has
    several salts, so that no task meets all its sets: a set looks up under one of them, and is
    indexed under all.
    """
    shared = sets.sparkSession.sparkContext.broadcast(commonness(sets))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        rows = zip(batch.column("fp").to_pylist(), batch.column("members").to_pylist(), strict=True)
        for row, (fp, members) in enumerate(rows):
            x = np.frombuffer(members, np.uint64)
            count = shared.value[(x & COUNT_MASK).astype(np.int64)]
            n = len(x)
            order = np.lexsort((x, count))[: n - -(-percent * n // 100) + 1]
            salts = 1 + count[order] // SALT_ROWS
            first = n - -(-2 * percent * n // (100 + percent)) + 1
            copies = np.repeat(np.arange(min(first, len(order))), salts[:first])
            starts = np.repeat(np.cumsum(salts[:first]) - salts[:first], salts[:first])
            at = np.concatenate([np.arange(len(order)), copies])
            made = (
                x[order][at].view(np.int64),
                np.concatenate([int.from_bytes(fp[:4], "big") % salts, np.arange(len(copies)) - starts]),
                np.arange(len(at)) >= len(order),
                np.full(len(at), row),
                np.full(len(at), n),
                at,
            )
            for column, values in zip(columns, made, strict=True):
                column.append(values)
        shingle, salt, indexed, row, n, at = map(np.concatenate, columns)
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [pa.array(shingle), pa.array(salt.astype(np.int32)), pa.array(indexed),
             batch.column("fp").take(take), batch.column("root").take(take),
             pa.array(n.astype(np.int32)), pa.array(at.astype(np.int32))],
            names=["shingle", "salt", "indexed", "fp", "root", "n", "at"],
        )

    return sets.select("fp", "root", "members").mapInArrow(
        arrow_rows(step, 500),
        "shingle long, salt int, indexed boolean, fp binary, root binary, n int, at int",
    )


def remaining(sets: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """a, b: all links between sets (fp, members) that `links` leaves in different components."""
    roots = components(links).withColumnRenamed("node", "fp")
    sets = sets.select("fp", "members").join(roots, "fp", "left")
    sets = stored(sets.withColumn("root", F.coalesce("root", "fp")), "remaining")
    rare = stored(rare_shingles(sets, percent), "rare")
    # a shingle of one component only links nothing
    several = rare.groupBy("shingle").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.collect_set("salt").alias("salts")
    ).where(F.col("low") != F.col("high"))
    several = several.select("shingle", F.explode("salts").alias("salt"))
    rare = stored(rare.join(several, ["shingle", "salt"], "left_semi"), "met")
    x = rare.where("not indexed").select("shingle", "salt", *[F.col(c).alias(f"x_{c}") for c in ("fp", "root", "n", "at")])
    y = rare.where("indexed").select("shingle", "salt", *[F.col(c).alias(f"y_{c}") for c in ("fp", "root", "n", "at")])
    # the first common shingle and all behind it have to make up the least overlap
    behind = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    met = x.join(y, ["shingle", "salt"]).where(
        (F.col("x_root") != F.col("y_root"))
        & (F.col("y_n") <= F.col("x_n"))
        & (100 * F.col("y_n") >= percent * F.col("x_n"))
        & ((100 + percent) * behind >= percent * (F.col("x_n") + F.col("y_n")))
    )
    pairs = met.select(F.least("x_fp", "y_fp").alias("a"), F.greatest("x_fp", "y_fp").alias("b")).distinct()
    return stored(confirmed(pairs, sets.select("fp", "members"), percent), "last_links")


def linked(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """a, b: confirmed links that connect all classes that belong together."""
    near = Search(percent, WINDOW, LEAST_DEPTH, BEST)
    pairs, crowd = candidates(classes, near, TREES, ROWS_PER_PART)
    pairs = stored(pairs, "pairs")
    sets = stored(full_sets(docs, classes, ends_of(pairs), width), "sets")
    best = stored(confirmed(pairs.where("first").select("a", "b"), sets, percent), "links")
    rest = stored(apart(pairs.where("not first").select("a", "b"), components(best)), "pairs")
    first = stored(best.unionByName(confirmed(rest, sets, percent)), "links")
    crowd = stored(crowd.distinct().withColumnRenamed("a", "fp"), "crowd")
    if crowd.isEmpty():
        return first
    roots = components(first).withColumnRenamed("node", "fp")
    again = classes.join(crowd, "fp", "left_semi").join(roots, "fp", "left")
    again = stored(again.withColumn("root", F.coalesce("root", "fp")), "crowded")
    look = Search(percent, WIDE_WINDOW, WIDE_DEPTH, mark=True)
    pairs, beyond = candidates(again, look, WIDE_TREES, ROWS_PER_PART)
    marked = stored(ends_of(pairs), "marked")
    beyond = stored(beyond.distinct().withColumnRenamed("a", "fp"), "beyond")
    wanted = stored(marked.unionByName(beyond).distinct(), "wanted")
    if wanted.isEmpty():
        return first
    sets = stored(full_sets(docs, again, wanted, width), "sets")
    asked = stored(again.join(marked, "fp", "left_semi").join(sets, "fp"), "asked")
    confirm = Search(percent, WIDE_WINDOW, WIDE_DEPTH)
    links, _ = candidates(asked, confirm, WIDE_TREES, WIDE_ROWS_PER_PART)
    links = stored(first.unionByName(links.select("a", "b")), "links")
    if beyond.isEmpty():
        return links
    rest = again.join(beyond, "fp", "left_semi").join(sets, "fp")
    return links.unionByName(remaining(rest, links, percent))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept of each document.

    Documents are linked if 100 times the intersection of their sets of `width`-word shingles is at
    least `percent` times the union. `component_id` is the smallest id that links lead to, and
    `kept` is true for that document.
    """
    docs = docs.select("doc_id", "text")
    rows = stored(digest(docs, width), "digests")
    classes = rows.where(F.col("fp").isNotNull()).groupBy("fp").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.max("sig").alias("sig")
    )
    classes = stored(classes, "classes")
    roots = components(linked(docs, classes, width, percent))
    # classes of a component of more than one, with the smallest id of all its documents
    members = roots.unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct()
    ).join(classes.select(F.col("fp").alias("node"), "rep"), "node")
    members = stored(members, "members")
    least = members.groupBy("root").agg(F.min("rep").alias("least"))
    far = members.join(least, "root").select(F.col("node").alias("fp"), "least")
    named = classes.select("fp", "rep").join(far, "fp", "left").select(
        F.col("fp").alias("class_fp"), F.coalesce("least", "rep").alias("least")
    )
    joined = rows.select("doc_id", "text_key", "n_shingles", "fp").join(
        named, F.col("fp") == F.col("class_fp"), "left"
    )
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return joined.select(
        "doc_id",
        "text_key",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def without_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The document of each component that is kept, with all columns."""
    judged = near_duplicates(docs, width, percent).where(~F.col("kept"))
    gone = stored(judged.select("doc_id", "text_key").distinct(), "gone")
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(gone))
    slot = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << FILTER_BITS) - 1).cast("long"))

    @F.pandas_udf("boolean")
    def perhaps_gone(slots: pd.Series) -> pd.Series:
        at = slots.to_numpy()
        return pd.Series((shared.value[at // 63] >> (at % 63)) & 1 == 1)

    # texts that the filter knows to stay do not take part in the join
    asked = without(docs.where(perhaps_gone(slot)), gone)
    return docs.where(~perhaps_gone(slot)).unionByName(asked)
