"""From raw documents to packed sequences: filters, duplicates, leaked benchmark items, packing.

A stage takes the session, what its predecessor kept and the folder of the other tables. All stages
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import stages
from tideline.session import discard, paths_made, prepare, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", stages.quality_rules),
    ("toxicity", stages.toxic_documents),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("packing", stages.packed),
]

#: classifiers and greedy packing are not expressible in SQL; tests use brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder before the next reads it.

    Once a stage is written, what it stored on its way and its predecessor's output are removed, so
    the folder never holds more than two copies of the documents.
    """
    docs, since = table(prepare(spark), sf_dir, "documents"), paths_made()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        discard(spark, since, but_last=True)
    return docs
