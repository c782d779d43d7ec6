"""Merkle manifest of a dataset: one root digest, and per document the proof that it belongs to it.

Leaves are digests of the documents' fields. The leaves of a group, in order, are a tree of their own;
its subroots, in the order of the groups, are the leaves of the last tree. A parent is the digest of
the digests of up to `arity` consecutive nodes.

A tree is made in rounds. In a round the nodes are cut into blocks of `arity ** depth`, which are whole
subtrees, so a block needs no other. A node stands in the row of its first leaf in the block: at level
l the nodes are `arity ** l` rows apart. Lag and lead columns at these fixed offsets, masked by the
node's slot among its siblings and by the length of the run, give the digests to its left and right;
first children hash them to parents. All levels of a round are windows over one sorting of the rows.
The roots of the blocks are the nodes of the next round, so the number of rounds grows with the
logarithm of the largest group, and no task holds more than blocks. A hot group is many blocks.

A digest is the lowercase hex sha256 of its inputs, one after the other. A leaf hashes doc_id, source,
lang, n_chars and text, each as `-` if it is null, else as the number of its bytes, a colon and the
value. Leaves ascend by doc_id, null first; rows that repeat an id by their digest. The groups are the
languages, null first, then by their bytes. A group with one leaf has that leaf as its subroot, and a
single subroot is the root. Without documents there are no rows. A document without siblings on its
whole path has the digest of nothing as its proof.

`verified` recomputes the root from a leaf and the original siblings. The leaves in `tampered` are
recomputed from a copy of the document with one more in n_chars, unless that is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import stored
from tideline.operators import scan

ARITY, DEPTH = 2, 10
#: rows of one group beyond which they are numbered in several tasks
MAX_ROWS = 10_000


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length before it, so that fields cannot run into each other."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, lang, leaf, probe: the digest of each document, and that of its copy to be verified."""
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    before = [field(F.col(c)) for c in ("doc_id", "source", "lang")]
    made = lambda count: digest(*before, field(count), field(F.col("text")))
    changed = F.coalesce(tampered, F.lit(False)) & n_chars.isNotNull()
    return docs.select("doc_id", "lang", made(n_chars).alias("leaf"), F.when(
        changed, made(n_chars + 1)
    ).alias("probe")).withColumn("probe", F.coalesce("probe", "leaf"))


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], max_rows: int) -> DataFrame:
    """`df` with `pos`, the place of the row in its group from 0 on."""
    placed = scan.running(df, group, order, [scan.running_count("_place")], max_rows)
    return placed.withColumn("pos", F.col("_place") - 1).drop("_place")


def climbed(nodes: DataFrame, group: Sequence[str], arity: int, depth: int) -> DataFrame:
    """`nodes` (*group, pos, node) with `block`; `path`, the digests left and right of the node and of
    its ancestors inside the block; and `top`, the block's root, in the row of its first node."""
    size = arity**depth
    blocked = nodes.withColumn("block", F.floor(F.col("pos") / size).cast("long"))
    whole = Window.partitionBy(*group, "block")
    rows = whole.orderBy("pos")
    # a group of one block has as many nodes as the block; others have every level of the block
    df = blocked.withColumn("_run", F.when(F.col("block") == 0, F.count("*").over(whole)))
    df = df.withColumn("_d0", F.col("node"))
    sides = []
    for level in range(depth):
        stride, d = arity**level, f"_d{level}"
        slot = F.floor(F.col("pos") / stride) % arity
        goes = F.coalesce(F.col("_run") > stride, F.lit(True))
        left = [
            F.when(slot >= j, F.lag(d, j * stride).over(rows)) for j in range(arity - 1, 0, -1)
        ]
        right = [
            F.when(slot + j < arity, F.lead(d, j * stride).over(rows)) for j in range(1, arity)
        ]
        joined = lambda parts: F.concat(*[F.coalesce(p, F.lit("")) for p in parts])
        df = df.withColumns({f"_l{level}": joined(left), f"_r{level}": joined(right)})
        is_node = F.col("pos") % stride == 0
        side = F.struct(F.col(f"_l{level}").alias("left"), F.col(f"_r{level}").alias("right"))
        parent = digest(F.col(d), F.col(f"_r{level}"))
        first_child = F.col("pos") % (stride * arity) == 0
        df = df.withColumns({
            f"_s{level}": F.when(is_node & goes, side),
            f"_d{level + 1}": F.when(~goes, F.col(d)).when(first_child, parent),
        })
        sides.append(f"_s{level}")
    # every node below a row finds it as the last one before itself
    so_far = rows.rowsBetween(Window.unboundedPreceding, 0)
    path = F.array_compact(F.array(*[F.last(s, ignorenulls=True).over(so_far) for s in sides]))
    return df.select(*nodes.columns, "block", path.alias("path"), F.col(f"_d{depth}").alias("top"))


def tree(
    nodes: DataFrame, group: Sequence[str], arity: int, depth: int
) -> tuple[DataFrame, DataFrame]:
    """`nodes` (*group, pos, node) with the `path` to the group's root; and *group, `top`, the roots."""
    size = arity**depth
    up = climbed(nodes, group, arity, depth)
    tops = stored(
        up.where(F.col("pos") % size == 0).select(
            *group, F.col("block").alias("pos"), F.col("top").alias("node")
        ),
        "tops",
    )
    last = tops.agg(F.max("pos")).first()[0]
    if not last:  # every group is one block
        return up.drop("block", "top"), tops.select(*group, F.col("node").alias("top"))
    above, roots = tree(tops, group, arity, depth)
    named = above.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("pos").alias("_block"),
        F.col("path").alias("_above"),
    )
    same = F.col("block") == F.col("_block")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    found = up.join(named, same).select(*nodes.columns, F.concat("path", "_above").alias("path"))
    return found, roots


def folded(start: Column, path: Column) -> Column:
    """The root that a digest comes to with the digests left and right of it."""
    return F.aggregate(path, start, lambda node, x: digest(x["left"], node, x["right"]))


def proof(path: Column) -> Column:
    siblings = F.transform(path, lambda x: F.concat(x["left"], x["right"]))
    return digest(F.array_join(siblings, ""))


def manifest(
    docs: DataFrame, tampered: Column, arity: int = ARITY, depth: int = DEPTH,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """doc_id, lang, leaf, subroot, root, path, probe: the tree seen from each document.

    `path` has the digests left and right of the document and of its ancestors, up to the root;
    `probe` is the digest to be verified, that of a tampered copy where the condition says so.
    """
    made = stored(leaves(docs, tampered), "leaves")
    rows = stored(
        numbered(made.withColumnRenamed("leaf", "node"), ["lang"], ["doc_id", "node"], max_rows), "nodes"
    )
    found, subroots = tree(rows, ["lang"], arity, depth)
    above = numbered(
        subroots.select("lang", F.col("top").alias("node")), [], ["lang"], max_rows
    ).withColumn("all", F.lit(0))
    above, root = tree(stored(above, "subroots"), ["all"], arity, depth)
    root = root.select(F.col("all").alias("r_all"), F.col("top").alias("root"))
    upper = stored(
        above.join(root, F.col("all") == F.col("r_all")).select(
            F.col("lang").alias("u_lang"), F.col("node").alias("subroot"), "root",
            F.col("path").alias("upper"),
        ),
        "upper",
    )
    return found.join(upper, F.col("lang").eqNullSafe(F.col("u_lang"))).select(
        "doc_id", "lang", F.col("node").alias("leaf"), "subroot", "root",
        F.concat("path", "upper").alias("path"), "probe",
    )


def proofs(
    docs: DataFrame, tampered: Column, arity: int = ARITY, depth: int = DEPTH,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each document."""
    seen = manifest(docs, tampered, arity, depth, max_rows)
    found = seen.withColumn("folded_root", folded(F.col("probe"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
