"""Shared working storage for jobs of several steps.

Intermediate tables are Parquet below the folder named by
``spark.checkpoint.dir``, which every executor can reach, so a lost executor
never takes a finished step with it.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: Where each working table lies, so that deleting it asks for no list of its files.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def root(spark: SparkSession) -> str:
    """The shared folder; a temporary one only in local mode where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="postlens-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{root(spark)}/postlens/{name}-{uuid.uuid4().hex[:12]}"


def write(df: DataFrame, name: str) -> str:
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    path = write(df, name)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def again(df: DataFrame) -> DataFrame:
    """The same working table read afresh, for plans that hold it twice."""
    out = df.sparkSession.read.schema(df.schema).parquet(_paths[df])
    _paths[out] = _paths[df]
    return out


def drop(spark: SparkSession, *frames_or_paths) -> None:
    """Delete working tables (frames that ``table`` gave, or paths) that no later step reads."""
    for x in frames_or_paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(x if isinstance(x, str) else _paths[x])
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of steps that are over.

    The cleaner acts when the driver's garbage collector finds their handles
    unreachable, which on a quiet driver can take half an hour: as long the disk
    would hold every exchange of a job. Called a few times a job, between its steps.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Texts in an Arrow batch; they may be of any length, and a batch is in memory as a whole.
TEXTS_PER_BATCH = 500


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to TEXTS_PER_BATCH rows, if they are larger."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXTS_PER_BATCH:
        spark.conf.set(name, TEXTS_PER_BATCH)
