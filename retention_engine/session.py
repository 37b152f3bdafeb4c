"""Session construction and cluster-safe scratch locations."""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark 4 records a Python call site on every Column/DataFrame call (extra JVM round trips);
    # the operators build plans programmatically, so keep plan construction cheap.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on, applied to a session created elsewhere (runtime confs
    only; the static call-site setting above can only be chosen when the session is built)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def get_session(master: str | None = None, app: str = "retention_engine",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes (UTC, AQE, no UI)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folders made here for local sessions without a configured one, by application.
_local_folders: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Without that setting a temporary folder is made only for a ``local`` master, where driver and
    executors are one process; any other master must name a folder that all machines share.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors share (master {master})")
        app = spark.sparkContext.applicationId
        if app not in _local_folders:     # a setting of the core: a running session cannot be given it
            _local_folders[app] = tempfile.mkdtemp(prefix="re-ckpt-")
        d = _local_folders[app]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


#: Whether a query's shuffle files go when it ends (else when the driver happens to collect its garbage).
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Used for frozen artefacts (splits, baselines) and to cut long lineages: the returned frame has a
    one-node plan, survives executor loss (the data are on shared storage, not in executor memory) and
    keeps Parquet column pruning / filter pushdown for every later reader. The shuffle files of the write, which nothing
    reads once the table stands, are removed at its end; the setting is for the write alone.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    as_before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    if as_before != "true":
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if as_before != "true":
            spark.conf.set(SHUFFLE_CLEANUP, as_before)
    out = spark.read.parquet(path)
    out._written = path
    return out


def discard(*tables) -> None:
    """Removes tables that ``materialize`` wrote. To be called when all that reads them stands as a table of its own: a frame
    that still reads one of them fails from then on."""
    for t in tables:
        path = t.__dict__.get("_written")
        if path is None:
            raise ValueError("only a frame that materialize returned can be discarded")
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
