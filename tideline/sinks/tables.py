"""Sinks over files in a shared folder. A micro-batch that is run again writes the same result:
each batch owns the folder `batch=<id>` and replaces it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.records import first_record, last_record
from tideline.session import stored


def append_csv(df: DataFrame, path: str, names: Sequence[str]) -> None:
    """Append rows to CSV files; columns are matched by position, as `names`."""
    df.toDF(*names).write.mode("append").csv(path)


def stream_csv(df: DataFrame, path: str, names: Sequence[str], checkpoint: str):
    """Streaming form. Only insertions can be appended: an updating result is refused by Spark."""
    return (
        df.toDF(*names)
        .writeStream.outputMode("append")
        .format("csv")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def documents(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Rows as JSON documents of strings, one per row: {document field: column}."""
    shown = [F.col(column).cast("string").alias(field) for field, column in fields.items()]
    return df.select(F.to_json(F.struct(*shown)).alias("value"))


def append_documents(df: DataFrame, path: str, fields: dict[str, str]) -> None:
    """Append JSON lines without document ids, so that equal rows are kept as often as they come."""
    documents(df, fields).write.mode("append").text(path)


def batch_writer(write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: keeps the batch's rows between several writes of the same batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(batch, batch_id)
        finally:
            batch.unpersist()

    return run


class KeyValueTable:
    """A key-value table with last-write-wins upserts, as parquet below `path`.

    An upsert writes only the newest row per key of its batch. Reading takes the newest row per
    key over all batches. `compact` folds the batches into one.
    """

    def __init__(self, path: str, key: Sequence[str], order: Sequence[str]):
        self.path = path
        self.key = list(key)
        self.order = list(order)

    def _newest(self, df: DataFrame, by: Sequence[str], value: Sequence[str]) -> DataFrame:
        return df.groupBy(*self.key).agg(last_record(by, value, "_newest")).select(
            *self.key, "_newest.*"
        )

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        value = [c for c in batch.columns if c not in self.key]
        self._newest(batch, self.order, value).write.mode("overwrite").parquet(
            f"{self.path}/batch={batch_id}"
        )

    def read(self, spark: SparkSession) -> DataFrame:
        stored = spark.read.option("basePath", self.path).parquet(self.path)
        value = [c for c in stored.columns if c not in [*self.key, "batch"]]
        return self._newest(stored, ["batch", *self.order], value)

    def compact(self, spark: SparkSession, into: str, batch_id: int) -> KeyValueTable:
        """A new table whose one batch stands for all batches up to `batch_id`."""
        stored = spark.read.option("basePath", self.path).parquet(self.path)
        folded = KeyValueTable(into, self.key, self.order)
        value = [c for c in stored.columns if c not in [*self.key, "batch"]]
        upto = stored.filter(F.col("batch") <= batch_id)
        self._newest(upto, ["batch", *self.order], value).write.mode("overwrite").parquet(
            f"{into}/batch={batch_id}"
        )
        return folded


class SeenKeys:
    """Deduplication against every key ever seen, across batches and job runs.

    `run` names the job run, with its own batch numbers; runs with different names share the keys.
    """

    def __init__(
        self, path: str, key: Sequence[str], order: Sequence[str], run: str = "main",
        buckets: int = 32,
    ):
        self.path = path
        self.buckets = buckets
        self.key = list(key)
        self.order = list(order)
        self.run = run

    def _known(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        schema = batch.select(*self.key).schema.add("run", T.StringType())
        schema = schema.add("batch", T.LongType()).add("bucket", T.IntegerType())
        try:
            stored = batch.sparkSession.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        repeated = (F.col("run") == self.run) & (F.col("batch") >= batch_id)
        return stored.filter(~repeated).select(*self.key, "bucket")

    def _bucket(self) -> Column:
        """Which of a fixed number of folders a key's rows lie in."""
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def first_seen(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch's first row per key that no earlier batch has had; remembers the keys.

        The rows are stored under the batch's number and read back, so a batch that is run again
        gives the same rows.
        """
        value = [c for c in batch.columns if c not in self.key]
        first = batch.groupBy(*self.key).agg(first_record(self.order, value, "_first")).select(
            *self.key, "_first.*"
        )
        known = self._known(batch, batch_id)
        if known is not None:
            # a batch has few keys, the table many: only the asked buckets are read, and Spark, which
            # knows the size of a stored table, may look the keys up where the table's rows are
            first = stored(first, "first")
            asked = first.select(
                *[F.col(k).alias(f"_key{i}") for i, k in enumerate(self.key)],
                self._bucket().alias("_bucket"),
            )
            buckets = [r[0] for r in asked.select("_bucket").distinct().collect()]
            same = F.lit(True)
            for i, k in enumerate(self.key):  # a null key is a key like others
                same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
            repeated = known.filter(F.col("bucket").isin(buckets)).join(asked, same, "left_semi")
            repeated = repeated.select(
                *[F.col(k).alias(f"_key{i}") for i, k in enumerate(self.key)]
            ).distinct()
            first = first.join(repeated, same, "left_anti")
        here = f"{self.path}/run={self.run}/batch={batch_id}"
        laid = first.withColumn("bucket", self._bucket()).repartition("bucket")
        laid.write.mode("overwrite").partitionBy("bucket").parquet(here)
        return batch.sparkSession.read.schema(first.schema).parquet(here).select(*first.columns)
