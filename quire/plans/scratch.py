"""New paths in the folder that driver and executors share, deleted when the driver ends."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_scratch: list[tuple[SparkSession, str]] = []
_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``. Only where all runs on one machine and none is named, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="quire-"))
    return _own_dir[0]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path under the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/quire/{tag}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Hadoop's file system, so any store works."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, tag: str = "table") -> DataFrame:
    """Cut lineage: the rows written as Parquet in the shared folder and read back."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _remove_all() -> None:
    for spark, path in _scratch:
        try:
            remove(spark, path)
        except Exception:  # the JVM may be gone by now
            return
