"""The operators as stages of a pipeline: documents in, the documents that stay out, all columns kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import forest, packing, rules, templates, toxicity
from tideline.llm.common import fold, table

#: documents with this score or more are rejected as toxic
TOXIC = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the limits of their language and source."""
    return rules.kept(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the score; the lexicon is learned from the labels of four folds in five."""
    train = fold(F.col("doc_id"), 5) != 0
    return toxicity.kept(docs, table(spark, sf_dir, "labels"), train, TOXIC)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8."""
    return forest.without_duplicates(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item has leaked."""
    return templates.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in sequences of the permitted lengths."""
    return packing.best_fit(docs)
