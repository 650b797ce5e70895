"""Results that many later steps read, written once and read back with the columns that each step needs."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where none is set, one of its own in local mode, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="postlens-"))


def cut(df: DataFrame) -> DataFrame:
    """``df``, computed once into a Parquet table of the shared folder; its plan ends there.

    What reads it often neither recomputes it nor carries a copy of its plan, and reads only the columns it names.
    """
    path = f"{shared_folder(df.sparkSession)}/postlens/cut-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def drop(*frames: DataFrame) -> None:
    """Delete the tables of frames that ``cut`` gave, once nothing reads them; other frames are left alone."""
    for df in frames:
        if path := _paths.pop(df, None):
            delete(df.sparkSession, path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it names it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    system, p = file_system(spark, path)
    system.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, p = file_system(spark, path)
    return system.exists(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; an error if the target is there already, or the file system refuses."""
    system, a = file_system(spark, source)
    b = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(b.getParent())
    if system.exists(b) or not system.rename(a, b):
        raise OSError(f"{source} could not become {target}")


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's first partition column, from the names of its folders alone, in order."""
    system, p = file_system(spark, path)
    if not system.exists(p):
        return []
    names = [x.getPath().getName() for x in system.listStatus(p) if x.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))
