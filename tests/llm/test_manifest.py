"""Merkle manifests against trees built by hand."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tideline.llm import manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    count = None if row.n_chars is None else row.n_chars + more
    return digest(*map(field, (row.doc_id, row.source, row.lang, count, row.text)))


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def plain(rows, arity=2):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    groups = {}
    for row in rows:
        groups.setdefault(row.lang, []).append((row.doc_id is not None, row.doc_id or 0, leaf(row), row))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    members = {g: sorted(groups[g], key=lambda x: x[:3]) for g in order}
    trees = {g: levels([x[2] for x in members[g]], arity) for g in order}
    last = levels([trees[g][-1][0] for g in order], arity)
    out = []
    for at, g in enumerate(order):
        for i, (_, _, own, row) in enumerate(members[g]):
            changed = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 7 == 0
            node, proof = leaf(row, 1) if changed else own, ""
            for tree, k in ((trees[g], i), (last, at)):
                for nodes in tree[:-1]:
                    run = k - k % arity
                    left, right = "".join(nodes[run:k]), "".join(nodes[k + 1 : run + arity])
                    proof, node, k = proof + left + right, digest(left, node, right), k // arity
            root = last[-1][0]
            out.append((row.doc_id, own, trees[g][-1][0], root, digest(proof), node, node == root))
    return sorted(out, key=str)


def marked(docs):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


def found(docs, **how):
    return sorted(map(tuple, manifest.proofs(docs, marked(docs), **how).collect()), key=str)


@pytest.mark.parametrize("how", [{}, {"depth": 2, "max_rows": 7}, {"arity": 3, "depth": 1}])
def test_trees(make, how):
    """Groups of 1 to 40 documents, with one row of blocks or several rounds."""
    langs = ["a"] * 40 + ["b"] * 17 + ["c"] * 8 + ["é"] * 3 + [None] * 4 + ["z"]
    texts = [f"text é {i}" for i in range(len(langs))]
    docs = make(texts, [(i * 31) % 101 for i in range(len(langs))], langs)
    got = found(docs, **how)
    assert got == plain(docs.collect(), how.get("arity", 2))
    # an unchanged copy is verified, a tampered one is not
    assert all(row[-1] == (zlib.crc32(str(row[0]).encode()) % 7 != 0) for row in got)


def test_one_document(make):
    docs = make(["only"], [1])
    row = found(docs)[0]
    assert row[1] == row[2] == row[3] and row[4] == digest("")
    assert found(docs) == plain(docs.collect())


def test_odd_rows(make, odd):
    texts, ids = odd
    docs = make(texts, ids, langs=["en", None] * 5, sources=[None, "s"] * 5)
    docs = docs.withColumn("n_chars", F.when(F.col("doc_id") != 5, F.col("n_chars")))
    assert found(docs, depth=1, max_rows=2) == plain(docs.collect())


def test_repeated_rows(make):
    docs = make(["same"] * 9 + ["other"], [3] * 10)
    assert found(docs, depth=2, max_rows=4) == plain(docs.collect())


def test_no_documents(make):
    assert manifest.proofs(make(["a"]).limit(0), F.lit(False)).count() == 0


def test_any_change_is_seen(make):
    docs = make(["a", "b", "c"])
    root = lambda df: df.select("root").distinct().collect()[0].root
    before = root(manifest.proofs(docs, F.lit(False)))
    for change in (
        docs.withColumn("text", F.when(F.col("doc_id") == 1, "B").otherwise(F.col("text"))),
        docs.withColumn("source", F.when(F.col("doc_id") != 1, F.col("source"))),
        docs.where("doc_id < 2"),
    ):
        assert root(manifest.proofs(change, F.lit(False))) != before


def test_path_leads_to_the_root(make):
    """What the operator gives beside the digests: the siblings themselves."""
    docs = make([f"t{i}" for i in range(11)], langs=["a"] * 6 + ["b"] * 5)
    for row in manifest.manifest(docs, F.lit(False), depth=2).collect():
        node = row.leaf
        for side in row.path:
            node = digest(side.left, node, side.right)
        assert node == row.root
