"""Parquet tables and CSV files."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terrace.sources import folders

_VERSION = re.compile(r"v\d{8}-[0-9a-f]{32}")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan of a Parquet folder, or of the newest version in a folder of versions.

    With a schema no footer is read for planning.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(current_version(spark, path) or path)


def overwrite_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace the rows below ``path`` by ``df``, which may read from it."""
    drop_other_versions(df.sparkSession, path, write_version(df, path, partition_by))


def write_version(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write a new version below ``path``, beside the others, and return its folder.

    A version counts once Spark has marked it complete. Until the older ones are dropped, whatever
    reads them goes on; a load that fails leaves nothing but an incomplete folder.
    """
    spark = df.sparkSession
    numbers = [int(name[1:9]) for name in folders.names(spark, path) if _VERSION.fullmatch(name)]
    fresh = f"{path.rstrip('/')}/v{max(numbers, default=0) + 1:08d}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(fresh)
    return fresh


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete version, or None if there is no version."""
    names = sorted((n for n in folders.names(spark, path) if _VERSION.fullmatch(n)), reverse=True)
    found = (f"{path.rstrip('/')}/{name}" for name in names)
    return next((f for f in found if folders.exists(spark, f"{f}/_SUCCESS")), None)


def drop_other_versions(spark: SparkSession, path: str, keep: str) -> None:
    """Delete the versions older than ``keep``, complete or not."""
    last = keep.rstrip("/").rsplit("/", 1)[1]
    for name in folders.names(spark, path):
        if _VERSION.fullmatch(name) and name[:9] < last[:9]:
            folders.delete(spark, f"{path.rstrip('/')}/{name}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line, in the declared types; a malformed line ends the read."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
