"""Small helpers on the Hadoop file system behind a path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[object, object]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty when it does not exist."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return [status.getPath().getName() for status in fs.listStatus(where)]


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.mkdirs(where)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def copy(spark: SparkSession, path: str, to: str) -> None:
    """Copy a folder's files; what was at ``to`` goes first."""
    (fs, where), (fs_to, there) = _at(spark, path), _at(spark, to)
    fs_to.delete(there, True)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, where, fs_to, there, False, True, conf):
        raise OSError(f"{path} was not copied to {to}")
