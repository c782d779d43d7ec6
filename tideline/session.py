"""Session settings, table loading and the shared folder that jobs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# state on local disk, with only its changes uploaded per micro-batch
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "tideline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tested with. `master` is for local runs only."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STATE,
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on in a session that somebody else built: UTC and the state store."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name, value in STATE.items():
        spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as `spark.checkpoint.dir` names it.

    Only a local session may go without the setting; it gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_made: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses; `discard` removes it."""
    _made.append(f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def paths_made() -> int:
    """How many paths of this process stand in the shared folder, for `discard`."""
    return len(_made)


def discard(spark: SparkSession, since: int = 0, but_last: bool = False) -> int:
    """Remove what this process has put into the shared folder, from the path numbered `since` on.

    For when the results of the queries until now have been written or are no longer needed; a
    DataFrame made of these paths must not be used after. With `but_last` the newest path stays, such
    as the table that has just been written from the others. Gives the number of paths removed.
    """
    old = _made[since : len(_made) - but_last]
    _made[since : len(_made) - but_last] = []
    gone = 0
    for name in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """`df` written once to the shared folder and read back.

    For tables that are read several times. Cuts the lineage, survives the loss of executors, and
    keeps column pruning and size statistics, which a checkpoint does not.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
