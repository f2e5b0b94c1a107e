"""File-system calls that Spark's readers and writers do not offer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, target = _open(spark, path)
    fs.create(target, True).close()


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme."""
    fs, target = _open(spark, path)
    return fs.makeQualified(target).toString()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    fs, target = _open(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(target) or []]


def partition_value(spark: SparkSession, value: str) -> str:
    """``value`` as Spark spells it inside a partition folder name."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.escapePathName(value)
