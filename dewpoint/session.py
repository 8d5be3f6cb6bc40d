"""Session factory and shared working folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Checkpoints of frames that nothing refers to any more are deleted.
CLEANER = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build(
    app: str = "dewpoint",
    *,
    master: str | None = None,
    checkpoint_root: str | None = None,
    time_zone: str = "UTC",
    log_level: str = "ERROR",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with a fixed time zone and, if given, a streaming checkpoint root.

    Readings carry naive local times, so the zone decides which window they fall
    in; it is set here rather than inherited from the machine. Streaming state is
    kept by RocksDB, outside the heap and saved as changes only, since starting at
    the beginning of a long topic can hold many windows open. Adaptive execution
    keeps Spark's default (on).
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", time_zone)
    for key, value in (STATE_STORE | CLEANER).items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    if checkpoint_root:
        builder = builder.config("spark.sql.streaming.checkpointLocation", checkpoint_root)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir``. Only a local session without that setting
    falls back to a temporary folder; a cluster session without it is refused,
    since executors could not see a folder of the driver's machine.
    """
    return f"{_shared_root(spark).rstrip('/')}/dewpoint/{name}-{uuid.uuid4().hex}"


def _shared_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        # "local-cluster" has executors of its own and is no local session.
        if not context.master.startswith("local") or context.master.startswith("local-"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="dewpoint-")
        context.setCheckpointDir(root)
    return root


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame as a reliable checkpoint in the shared folder.

    Computed once, readable after an executor is lost, and in sessions of ``build``
    deleted when the frame is no longer in use.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(_shared_root(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a work folder and read back.

    For a result that is needed more than once: its inputs are read one time, and
    a lost executor does not bring them back.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
