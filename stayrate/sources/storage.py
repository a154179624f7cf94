"""Shared storage: where checkpoints and intermediate tables go, and path checks.

Paths are resolved by Hadoop's file systems, so local, HDFS and object-store paths all work.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a session whose executor is the driver's own
    process (master ``local`` or ``local[...]``) gets a temporary folder when nothing is set.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="stayrate-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table beside the checkpoints."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def checkpointed(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to reliable storage and cut its lineage there.

    The table is Parquet, so later reads prune columns and the planner knows its size.
    """
    return written(df, name)[0]


def written(df: DataFrame, name: str = "table", *, by: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """``checkpointed``, split into folders ``by`` columns, together with the path."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this session. Frames that read them are then gone too."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path``, which may be a glob pattern, names something."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(location)
    return found is not None and len(found) > 0


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in ``folder``, sorted; none where it does not exist."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(location)) if files.exists(location) else []


def create_marker(spark: SparkSession, path: str) -> None:
    """Create an empty file, in one step; fails if there is one."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(location, False).close()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens where there is none."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def require_path(spark: SparkSession, path: str, what: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{what} not found: {path}")
