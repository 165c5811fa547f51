"""Folders on the file system that Spark writes to, local or distributed."""

from __future__ import annotations

from pyspark.sql import SparkSession


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with its content, if it exists."""
    system, folder = _find(spark, path)
    system.delete(folder, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    system, folder = _find(spark, path)
    return [found.getPath().getName() for found in system.listStatus(folder)] if system.exists(folder) else []


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _find(spark, path)
    return system.exists(folder)


def _find(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder
