"""Connected components of a graph of links by star contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, root of every node with a link; the root is the smallest node of its component.

    `links` has columns a and b of one sortable type. Each round hangs the larger neighbours of a
    node below its smallest neighbour, and then its smaller ones; the number of rounds grows with the
    logarithm of the longest path. Edges are stored after each round. Links of a node to itself and
    nulls are ignored; without links there are no rows.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    clean = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = stored(clean.select(b.alias("node"), a.alias("root")).distinct(), "edges")
    before = None
    while True:
        mark = edges.agg(
            F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
        ).first()
        if mark == before:
            return edges
        before = mark
        both = edges.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(
            edges.select(F.col("root").alias("u"), F.col("node").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        least = least.select(F.col("u").alias("of"), F.least("u", "least").alias("least"))
        large = both.join(least, F.col("u") == F.col("of")).where(F.col("v") > F.col("u"))
        large = stored(large.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct(), "edges")
        down = large.groupBy("u").agg(F.min("v").alias("least")).withColumnRenamed("u", "of")
        small = large.join(down, F.col("u") == F.col("of"))
        edges = stored(
            small.select(F.col("v").alias("node"), F.col("least").alias("root"))
            .where(F.col("node") != F.col("root"))
            .unionByName(down.select(F.col("of").alias("node"), F.col("least").alias("root")))
            .distinct(),
            "edges",
        )
