"""Session construction and shared scratch storage.

Anything a job writes in the middle of a plan (CSV round trips, store tables,
saved models, stream checkpoints) goes below the cluster's shared checkpoint
folder, ``spark.checkpoint.dir``. It is read from the session; only when it is
unset (local runs, tests) do we pick a folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "riskloom",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; set a local one only if none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Spark Connect)
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured
        # the client's folders are not the executors'
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster") from None
    root = sc.getCheckpointDir()
    if root:
        return root
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to the other executors
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        configured = tempfile.mkdtemp(prefix="riskloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (for in-process caches)."""
    return spark.conf.get("spark.app.id")


def data_version(df: DataFrame) -> tuple:
    """Tells versions of a file table apart (for in-process caches).

    A digest of its files' names, sizes and times: one row, whatever their number.
    """
    m = F.col("_metadata")
    files = df.select(m["file_path"].alias("p"), m["file_size"].alias("s"), m["file_modification_time"].alias("t")).distinct()
    return tuple(files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("p", "s", "t").cast("decimal(38,0)"))).first())


def require_shared_warehouse(spark: SparkSession) -> None:
    """On a cluster the catalog's warehouse must have been chosen: its default is a folder of the driver's host."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's setting holds
        return
    conf = sc.getConf()
    if not sc.master.startswith("local") and not conf.get("spark.sql.warehouse.dir", None):
        raise RuntimeError("set spark.sql.warehouse.dir to a folder shared by the whole cluster, or name a store path")


def remove_scratch(spark: SparkSession) -> bool:
    """Delete what this application wrote below the shared folder; frames that read it end with it."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark).rstrip('/')}/riskloom")
    return path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the shared folder (never reused)."""
    return f"{shared_root(spark).rstrip('/')}/riskloom/{label}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so driver-side Python can open a local path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
