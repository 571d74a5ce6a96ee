"""Session settings and scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

#: Settings every job relies on for right results (zone) or scale (adaptive
#: execution).  Adaptive execution is on by default in Spark 4; the skew-join
#: options are repeated so that a cluster default cannot silently disable them.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "sitebooks", **conf: str) -> SparkSession:
    """Create a session with :data:`SESSION_CONF`; extra settings by keyword.

    Keyword names use underscores for dots, e.g. ``spark_ui_enabled="false"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


#: Scratch directories handed out by this process and not yet deleted.
_IN_USE: list[str] = []


@lru_cache(1)
def _own_folder() -> str:
    """The temporary folder of a local session without a shared one; it goes when the process ends."""
    root = tempfile.mkdtemp(prefix="sitebooks-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory under the shared folder named by ``spark.checkpoint.dir``.

    Every executor must see the directory, so a cluster has to name a shared
    folder.  Only a ``local`` master, where driver and executors are one
    process, falls back to one temporary folder of that process.  Directories
    stay until :func:`scratch_space` or the caller deletes them.
    """
    root = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder all executors share before running this job"
            )
        root = _own_folder()
    path = f"{root.rstrip('/')}/sitebooks/{label}-{uuid.uuid4().hex}"
    _IN_USE.append(path)
    return path


@contextmanager
def scratch_space(spark: SparkSession):
    """Delete the scratch directories of the jobs run inside when the block ends, also by an error.

    Write the results inside the block: frames that read a deleted directory
    cannot be computed afterwards.  Blocks may be nested; each deletes its own.
    """
    mark = len(_IN_USE)
    try:
        yield
    finally:
        files = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        while len(_IN_USE) > mark:
            at = files.Path(_IN_USE.pop())
            at.getFileSystem(conf).delete(at, True)


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to scratch space and return a scan of it (runs one job).

    Use it for a frame several later stages read: the written table survives
    the loss of executors and cuts the lineage, unlike cached blocks.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
