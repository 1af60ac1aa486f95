"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes: UTC wall clock (log days come from text, hours
# from timestamps), ANSI on (bad input goes through try_* functions, never a
# silent cast), AQE on for runtime coalescing, skew splitting and broadcast
# conversion of small join sides.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # keyed streaming state (one entry per vehicle) lives off-heap in RocksDB
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "kestrel",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the base configuration."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is; without it this is an error, because executors would write to disks
    of their own. Only a session inside one machine's process (master
    ``local``, ``local[n]``, as in tests) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not is_single_process(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def is_single_process(master: str) -> bool:
    """True for ``local`` and ``local[...]``; a ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any path Spark can read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def materialize(df: DataFrame, label: str = "stage", codec: str | None = None) -> DataFrame:
    """Cut lineage for a frame read more than once: write it, read it back.

    The table goes to a fresh folder under the session's
    ``spark.checkpoint.dir`` (shared storage on a cluster), so a lost
    executor does not send the job back to the source scans, and every
    consumer reads the stored columns instead of recomputing them. A
    parquet write computes the frame once (an eager RDD checkpoint computes
    it twice: once to count, once to write). The folder is removed when the
    application ends, or earlier by ``scratch``. ``codec`` names a parquet
    compression other than the session's.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kestrel-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    for paths in _SCRATCH:
        paths.append(path)
    return spark.read.parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, most: int = 1000):
    """Inside the block Python workers get at most ``most`` rows at a time.

    Batches live outside the heap, in the JVM and in the worker: with whole
    texts, the session's usual 10,000 rows hold tens of megabytes in each of
    them per task. Holds for what is executed inside the block.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Removes the tables materialized inside the block when it ends.

    For jobs that write their own outputs; a frame that outlives the block
    must not depend on them.
    """
    paths: list[str] = []
    _SCRATCH.append(paths)
    try:
        yield
    finally:
        _SCRATCH.remove(paths)
        for path in paths:
            remove_path(spark, path)
