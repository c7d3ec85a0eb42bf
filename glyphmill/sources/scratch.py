"""The shared folder for files that outlive a task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Tasks that write a thin table, at most.
THIN_TASKS_PER_CORE = 4

# Temporary folders of local sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A session whose executors are threads of the driver (master ``local``) may
    leave it unset and gets a temporary folder. Any other session must name it:
    executors would write to their own disks and readers would miss the files.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="glyphmill-")
    return _LOCAL_ROOTS[application]


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/glyphmill/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's own part of the shared folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate files, once no frame that reads them is needed any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def thinned(frame: DataFrame) -> DataFrame:
    """A frame of keys and numbers only, in at most ``THIN_TASKS_PER_CORE`` partitions a core."""
    return frame.coalesce(THIN_TASKS_PER_CORE * frame.sparkSession.sparkContext.defaultParallelism)


def materialize(frame: DataFrame, name: str, thin: bool = False) -> DataFrame:
    """Compute ``frame`` once, store it in the shared folder and read it from there.

    For results that several later steps need: the source is read once, and a
    lost executor does not bring the long lineage back. A ``thin`` table, of keys
    and numbers only, is written by at most ``THIN_TASKS_PER_CORE`` tasks a core,
    each taking several partitions one after the other: a file costs its writer
    buffers outside the heap and, on a local file system, processes that set its mode.
    """
    path = scratch_path(frame.sparkSession, name)
    if thin:
        frame = thinned(frame)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
