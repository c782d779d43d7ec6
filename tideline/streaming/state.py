"""Keyed state of a stream as a table in the shared folder, of which a batch writes only its changes.

The state holds one row per key. Batch n writes the rows of the keys it changes as a run of its own.
Whenever `fan` runs of a size are complete, they are merged into one run that has the newest row of
each key. So keys that nothing happens to are written again only as often as the logarithm of the
number of batches, and a state is read from a few runs.

Which runs make up the state before batch n follows from n alone. A batch that is run again reads the
same runs as before and replaces what it wrote. Runs that no batch can ask for any more are removed.

A run lies in folders by the first bits of a hash of the key, as many bits as its rows need. A batch
with few keys reads the folders of these keys only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructType

FAN = 8
ROWS_PER_BUCKET = 500_000

_BATCH, _GONE = "_batch", "_gone"


def same_key(key: Sequence[str], other: Sequence[str]) -> Column:
    """Equality of keys in which null equals null."""
    same = F.lit(True)
    for mine, theirs in zip(key, other, strict=True):
        same = same & F.col(mine).eqNullSafe(F.col(theirs))
    return same


def renamed(df: DataFrame, key: Sequence[str], *rest: str) -> tuple[DataFrame, list[str]]:
    """The key under names that no other table has, and `rest`; and these names."""
    names = [f"_key{i}" for i in range(len(key))]
    return df.select(*[F.col(k).alias(n) for k, n in zip(key, names, strict=True)], *rest), names


class KeyedState:
    """State by `key` below `path`; its columns are those of the table that is written."""

    def __init__(
        self, path: str, key: Sequence[str], fan: int = FAN, rows_per_bucket: int = ROWS_PER_BUCKET
    ):
        self.path, self.key = path, list(key)
        self.fan, self.rows_per_bucket = fan, rows_per_bucket

    def runs(self, batches: int) -> list[tuple[int, int]]:
        """The runs, as first batch and batch behind the last, that make up the first `batches`."""
        size, made, start = 1, [], 0
        while size * self.fan <= batches:
            size *= self.fan
        while start < batches:
            while start + size > batches:
                size //= self.fan
            made.append((start, start + size))
            start += size
        return made

    def before(
        self, spark: SparkSession, batch_id: int, schema: StructType, keys: DataFrame | None = None
    ) -> DataFrame:
        """The rows of the state before a batch, in the columns of `schema`; if `keys` is given, those
        of these keys, each of which it has once."""
        runs = self.runs(batch_id)
        if not runs:
            return spark.createDataFrame([], schema)
        rows = self._read(spark, runs, schema)
        if keys is not None:
            asked, names = renamed(keys, self.key)
            touched = self._touched(spark, runs, keys)
            if touched is not None:
                rows = rows.filter(touched)
            rows = rows.join(asked, same_key(self.key, names), "left_semi")
        return self._newest(rows, schema).filter(~F.col(_GONE)).select(*schema.names)

    def write(self, changes: DataFrame, batch_id: int, most: int) -> None:
        """Write the rows of the keys that a batch changes, at most `most` rows, each key once. A row
        with `_gone` takes its key out of the state."""
        spark = changes.sparkSession
        if _GONE not in changes.columns:
            changes = changes.withColumn(_GONE, F.lit(False))
        self._write(changes.withColumn(_BATCH, F.lit(batch_id).cast("long")), batch_id, batch_id + 1, most)
        schema = StructType([f for f in changes.schema.fields if f.name != _GONE])
        size = self.fan
        while (batch_id + 1) % size == 0:
            first, part = batch_id + 1 - size, size // self.fan
            self._merge(spark, [(first + i * part, first + (i + 1) * part) for i in range(self.fan)], schema)
            size *= self.fan

    def prune(self, spark: SparkSession, batch_id: int) -> list[str]:
        """Remove the runs that batch `batch_id` and later ones do not read. Gives their names.

        For the beginning of a batch: by then no earlier batch is run again.
        """
        needed = {self._name(*run) for run in self.runs(batch_id)}
        gone = []
        for name in _children(spark, self.path):
            if name.startswith("run=") and name not in needed:
                if int(name.removeprefix("run=").split("-")[0]) < batch_id:
                    _remove(spark, f"{self.path}/{name}")
                    gone.append(name)
        return gone

    def _name(self, first: int, end: int) -> str:
        return f"run={first}-{end}"

    def _bucket(self, bits: int) -> Column:
        """The first bits of a hash of the key."""
        if not bits:
            return F.lit(0)
        return F.shiftrightunsigned(F.xxhash64(*self.key), 64 - bits).cast("int")

    def _read(
        self, spark: SparkSession, runs: Sequence[tuple[int, int]], schema: StructType
    ) -> DataFrame:
        full = StructType([*schema.fields]).add(_BATCH, LongType()).add(_GONE, BooleanType())
        full = full.add("bits", IntegerType()).add("bucket", IntegerType())
        paths = [f"{self.path}/{self._name(*run)}" for run in runs]
        return spark.read.schema(full).option("basePath", self.path).parquet(*paths)

    def _newest(self, rows: DataFrame, schema: StructType) -> DataFrame:
        rest = [c for c in schema.names if c not in self.key]
        newest = F.max_by(F.struct(*rest, _GONE, _BATCH), F.col(_BATCH)).alias("_newest")
        return rows.groupBy(*self.key).agg(newest).select(*self.key, "_newest.*")

    def _write(self, rows: DataFrame, first: int, end: int, most: int) -> None:
        bits = max(0, (max(most, 1) - 1) // self.rows_per_bucket).bit_length()
        laid = rows.withColumns({"bits": F.lit(bits), "bucket": self._bucket(bits)})
        laid.repartition(1 << bits, "bucket").write.mode("overwrite").partitionBy(
            "bits", "bucket"
        ).parquet(f"{self.path}/{self._name(first, end)}")

    def _merge(
        self, spark: SparkSession, runs: Sequence[tuple[int, int]], schema: StructType
    ) -> None:
        rows = self._read(spark, runs, schema)
        newest = self._newest(rows, schema)
        if runs[0][0] == 0:  # nothing older that a removed key would have to hide
            newest = newest.filter(~F.col(_GONE))
        self._write(newest, runs[0][0], runs[-1][1], rows.count())

    def _touched(
        self, spark: SparkSession, runs: Sequence[tuple[int, int]], keys: DataFrame
    ) -> Column | None:
        """Which folders may have the keys; None if there is only one in each run. The numbers that
        come to the driver are at most those of the folders."""
        depths = {
            int(name.removeprefix("bits="))
            for run in runs
            for name in _children(spark, f"{self.path}/{self._name(*run)}")
            if name.startswith("bits=")
        }
        most = max(depths, default=0)
        if not most:
            return None
        asked = keys.select(self._bucket(most).alias("bucket")).distinct().collect()
        found = F.lit(False)
        for bits in depths:
            folders = sorted({r.bucket >> (most - bits) for r in asked})
            found = found | ((F.col("bits") == bits) & F.col("bucket").isin(folders))
        return found


def _children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return [s.getPath().getName() for s in files.listStatus(folder)]


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Watermarks:
    """The highest event time of all batches so far, less a bound, before and after each batch."""

    def __init__(self, path: str, bound: int):
        self.path, self.bound = path, bound

    def advance(
        self, batch: DataFrame, us: Column, batch_id: int
    ) -> tuple[int | None, int | None]:
        """The watermark before a batch and after it, in microseconds; None without a row in time.

        One number is kept per batch, and only that of the batch before is needed.
        """
        spark = batch.sparkSession
        schema = "highest bigint"
        before = None
        if batch_id > 0:
            before = spark.read.schema(schema).parquet(f"{self.path}/batch={batch_id - 1}").first()[0]
        highest = batch.agg(F.max(us)).first()[0]
        after = max((x for x in (before, highest) if x is not None), default=None)
        kept = spark.range(1).select(F.lit(after).cast("bigint").alias("highest"))
        kept.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        for name in _children(spark, self.path):
            if name.startswith("batch=") and int(name.removeprefix("batch=")) < batch_id - 1:
                _remove(spark, f"{self.path}/{name}")
        low, high = (None if x is None else x - self.bound for x in (before, after))
        return low, high
