"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every chargeline job relies on. AQE re-plans joins at run time
# (broadcast when a side turns out small, split skewed partitions of a hot
# subscriber, coalesce tiny shuffle partitions); the session time zone is
# pinned so NTZ <-> text conversions never meet a daylight-saving gap.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot subscriber also where an aggregate on msisdn follows the join;
    # the extra shuffle carries partial aggregates only
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": "256MB",
    # streaming de-duplication state (record ids inside the watermark) lives in
    # RocksDB on local disk, not on the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "chargeline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(JOB_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared file system or object
    store). Only where it is unset -- local tests -- a private folder is
    created and registered, so later calls in the session agree.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="chargeline-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        fs = hpath.getFileSystem(conf)
        if fs.exists(hpath):
            total += fs.getContentSummary(hpath).getLength()
    return total


def size_shuffle_partitions(spark: SparkSession, paths: list[str],
                            target_bytes: int = 128 << 20, expansion: float = 3.0,
                            minimum: int = 8) -> int:
    """Set the initial shuffle partition count from the input size.

    AQE only merges small shuffle partitions (and splits skewed join
    partitions); it does not split an oversized aggregate partition. So the
    initial count must be large enough for the biggest shuffle: Parquet input
    expands (``expansion``) when decoded into shuffle rows, and each partition
    should hold about ``target_bytes``. AQE then coalesces the excess.
    """
    n = int(input_bytes(spark, paths) * expansion / target_bytes) + 1
    n = max(minimum, n)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


@contextmanager
def sized_shuffles(spark: SparkSession, paths: list[str]):
    """``size_shuffle_partitions`` for the work inside, the session's settings
    restored afterwards. Without paths, or where ``spark.sql.shuffle.partitions``
    was set for the application (e.g. to a bucket count), nothing is changed."""
    if not paths or spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        yield
        return
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    old = {k: spark.conf.get(k, None) for k in keys}
    size_shuffle_partitions(spark, paths)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
