"""Session construction and cluster-wide settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every ubeat job wants: UTC event time, AQE for runtime re-planning
# (partition coalescing, skew-join splitting, runtime broadcast decisions) and
# Arrow for the few pandas-backed operators.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window expansion (change points, hop windows) turns little shuffle data
    # into many output rows after the exchange; coalescing post-shuffle
    # partitions by shuffle bytes down to the 1 MB default starves those stages.
    # A small floor keeps their parallelism; at scale partitions are far larger.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed stream state on local disk with checkpoints, not on the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # A checkpoint is deleted once nothing refers to it any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "ubeat",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with ubeat's defaults.

    ``master`` is only set when given, so on a cluster the launcher decides.
    A checkpoint directory is configured only when the cluster names none
    (``spark.checkpoint.dir``); then a scratch folder is used, as in tests.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="ubeat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for what is started inside; the earlier ones come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def keyed_state(spark: SparkSession, partitions: int | None = None):
    """Settings under which a stream with state v2 is started in any session: the RocksDB
    store, which writes a micro-batch's changes and not all its files, and ``partitions``
    state partitions if given."""
    values = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    return settings(spark, **values, **({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {}))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of the shared store."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def kept(df: DataFrame, *folders: str) -> DataFrame:
    """``df`` checkpointed, and the folders that it was made from removed."""
    out = checkpointed(df)
    for folder in folders:
        delete(df.sparkSession, folder)
    return out
