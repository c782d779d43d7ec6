"""Bounded streams: tables fed to a streaming query in order, and its whole output as a table."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, StringType

from tideline.session import shared_path

ROWS_PER_FILE = 1_000_000
ROWS_PER_BATCH = 10_000_000
#: of strings and binaries before compression
BYTES_PER_FILE = 64 << 20


def as_slices(df: DataFrame, slice_of: str) -> DataFrame:
    """`df` without the column `slice_of` as a stream whose micro-batches are the values of that
    column, in their order. Rows of a slice are written in as many files as the largest slice needs.
    """
    spark = df.sparkSession
    largest = df.groupBy(slice_of).count().agg(F.max("count")).first()[0] or 0
    files = max(1, -(-largest // ROWS_PER_FILE))
    path = shared_path(spark, "stream-in")
    rest = [c for c in df.columns if c != slice_of]
    part = F.pmod(F.xxhash64(*rest), F.lit(files))
    dealt = df.withColumns({"_slice": F.col(slice_of), "_part": part}).drop(slice_of)
    dealt.repartition("_slice", "_part").write.partitionBy("_slice", "_part").parquet(path)
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(hadoop)
    slices = {
        int(s.getPath().getName().removeprefix("_slice=")): s.getPath()
        for s in store.listStatus(root) if s.getPath().getName().startswith("_slice=")
    }
    empty = None
    second = 0
    for number in sorted(slices):
        for n in range(files):
            folder = jvm.org.apache.hadoop.fs.Path(slices[number], f"_part={n}")
            if not store.exists(folder):  # every slice has the same number of files
                if empty is None:
                    empty = shared_path(spark, "empty")
                    spark.createDataFrame([], df.drop(slice_of).schema).coalesce(1).write.parquet(empty)
                source = jvm.org.apache.hadoop.fs.Path(empty)
                jvm.org.apache.hadoop.fs.FileUtil.copy(store, source, store, folder, False, hadoop)
            for status in store.listStatus(folder):
                if status.getPath().getName().startswith("part-"):
                    second += 1
                    store.setTimes(status.getPath(), second * 1000, -1)
    schema = df.drop(slice_of).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option(
        "recursiveFileLookup", "true"
    ).parquet(path)


def as_stream(
    df: DataFrame, order: str, batches: int = 3, last: DataFrame | None = None
) -> DataFrame:
    """`df` as a stream of about `batches` or more micro-batches that follow the column `order`.

    One job writes the rows to the shared folder, range-partitioned by `order` into files of a
    bounded size; the files' times are then set to follow each other, which is the order a file
    stream reads them in. `last` is sent after them, such as a row far in the future that closes all
    windows. For replaying tables; a live source bounds its batches itself, by files, bytes or
    offsets per trigger.
    """
    spark = df.sparkSession
    wide = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("bigint")
        for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))
    ]
    rows, size = df.agg(F.count(F.lit(1)), F.sum(sum(wide, F.lit(0)))).first()
    batches = max(batches, -(-rows // ROWS_PER_BATCH))
    files = max(-(-rows // ROWS_PER_FILE), -(-(size or 0) // BYTES_PER_FILE))
    per_batch = max(1, -(-files // batches))
    path = shared_path(spark, "stream-in")
    df.repartitionByRange(batches * per_batch, order).write.parquet(path)
    sent = _in_sequence(spark, path, set())
    if last is not None:
        last.select(*df.columns).write.mode("append").parquet(path)
        _in_sequence(spark, path, sent)
    return (
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(path)
    )


def _in_sequence(spark: SparkSession, path: str, sent: set[str]) -> set[str]:
    """Give the new part files under `path` times that follow their numbers, one second apart, and
    come after those of the files already `sent`; gives the names of all."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(hadoop)
    names = {s.getPath().getName() for s in files.listStatus(folder)}
    names = {n for n in names if n.startswith("part-")}
    for n, name in enumerate(sorted(names - sent), len(sent) + 1):
        files.setTimes(jvm.org.apache.hadoop.fs.Path(folder, name), n * 1000, -1)
    return names


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: each batch replaces its own folder, so running it again adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def settle(
    query: StreamingQuery, rows: int, quiet: int = 3, timeout: float = 300.0
) -> None:
    """Wait until the batches have had `rows` rows of input in all, and then `quiet` batches in a row
    no more.

    For queries with processing-time timers, which run a batch at every trigger, input or not. Batches
    without input alone say nothing: a file may not have been listed yet.
    """
    end = time.monotonic() + timeout
    had: dict[int, int] = {}
    while time.monotonic() < end:
        if query.exception():
            raise query.exception()
        # only the latest batches are kept by Spark, so they are added up on the way
        latest = query.recentProgress
        had.update({p.batchId: max(p.numInputRows, had.get(p.batchId, 0)) for p in latest})
        if sum(had.values()) >= rows and len(latest) >= quiet:
            if all(p.numInputRows == 0 for p in latest[-quiet:]):
                return
        time.sleep(0.2)
    raise TimeoutError(f"the query still had input after {timeout} s")


def run_bounded(
    stream: DataFrame, mode: str = "append", timers: bool = False, wait: float = 0.0,
    checkpoint: str | None = None, path: str | None = None,
    write: Callable[[DataFrame, int], None] | None = None, rows: int = 0,
) -> DataFrame:
    """Run the stream to the end of its input; gives (*columns, batch).

    `write` takes the place of the plain writer of batches; it writes below `path` as well.

    A query with processing-time timers (`timers`) never ends by itself: when its `rows` rows of input
    have come it is given `wait` seconds for timers to fire, and is then stopped.
    """
    spark = stream.sparkSession
    path = path or shared_path(spark, "stream-out")
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or shared_path(spark, "stream-checkpoint"))
        .foreachBatch(write or batch_folder(path))
    )
    if timers:
        started = writer.start()
        try:
            settle(started, rows)
            time.sleep(wait)
        finally:
            started.stop()
    else:
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.option("basePath", path).parquet(path)


def final_rows(output: DataFrame, key: list[str]) -> DataFrame:
    """The last version of each key's row, for a stream in update mode."""
    value = [c for c in output.columns if c not in [*key, "batch"]]
    newest = F.max_by(F.struct(*value), F.col("batch")).alias("_newest")
    return output.groupBy(*key).agg(newest).select(*key, "_newest.*")
