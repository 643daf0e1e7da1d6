"""Spark session defaults and the shared checkpoint folder.

Every transform in the package is a plain ``DataFrame -> DataFrame`` function;
this module only holds the session settings they are tuned for.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query of the package is written against. They are safe on a
# cluster too: AQE re-plans joins and coalesces small shuffle partitions from
# runtime sizes, and splits skewed shuffle partitions of sort-merge joins.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit a changelog per micro-batch instead of uploading a snapshot
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control of it
    on a cluster.
    """
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
    return spark


ROOT_KEY = "tidemark.checkpoint.root"


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, streaming checkpoints and side tables.

    A cluster names it in ``spark.checkpoint.dir`` and that value always wins.
    Only when it is unset, a folder given with :func:`use_checkpoint_root`
    (job argument) is used, or, in local mode (tests), a fresh temporary
    folder. The choice is recorded in the session, so later calls reuse it.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get(ROOT_KEY, None)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.conf.set(ROOT_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def use_checkpoint_root(spark: SparkSession, path: str) -> None:
    """Use ``path`` unless the cluster set ``spark.checkpoint.dir``."""
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        spark.conf.set(ROOT_KEY, path)


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of :func:`checkpoint_root` (one per query / side table)."""
    return os.path.join(checkpoint_root(spark), *parts)


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create ``path`` on whatever file system it names (local, HDFS, object
    store), so a stream can be started on a folder before its first file."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)
