"""Folders on the file system that Spark itself reads and writes (any Hadoop scheme)."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def make_folder(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    fs.mkdirs(where)
    return path


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, sorted; none if it does not exist."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory())


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """The whole numbers N of the folders ``column=N`` in ``path``, ascending."""
    head = f"{column}="
    return sorted(int(n.removeprefix(head)) for n in sub_folders(spark, path) if n.startswith(head))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove ``path`` and what is in it; nothing happens if it does not exist."""
    fs, where = _at(spark, path)
    fs.delete(where, True)
