"""Session helpers: the shared work folder and the checkpoint that cuts lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or the checkpoint folder the
    application set. Only a local master may go without; it then gets a folder of its own, which
    goes when Python ends.
    """
    context = spark.sparkContext
    base = spark.conf.get(_CONF, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_CONF} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="regiscope-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library wrote, on whatever file system it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.delete(target, True))
