"""What Spark's reader and writer cannot do with folders: list, delete and rename, on any file system it knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    where, system = _system(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where))


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _system(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds; nothing happens if there is none."""
    where, system = _system(spark, path)
    system.delete(where, True)


def rename(spark: SparkSession, path: str, new: str) -> None:
    """Give a file or folder another path, whose parents are made."""
    where, system = _system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    system.mkdirs(target.getParent())
    if system.exists(target) or not system.exists(where) or not system.rename(where, target):
        raise OSError(f"cannot rename {path} to {new}")
