"""Databases, tables and views of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources import files, folders


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION {_literal(location)}")


def register_parquet(
    spark: SparkSession, table: str, path: str, schema: T.StructType, partition_by: tuple[str, ...] = ()
) -> None:
    """Make the Parquet folder known as external table ``database.table``.

    A table of the same columns and without folders is pointed to ``path`` by one catalog change, so a
    reader finds the old rows or the new ones. Any other one is dropped (its files stay) and
    created again, so that new columns become visible, and since folders may have locations of their own, which a
    change of the table's leaves as they are; for a moment a reader finds no table, or one without rows.
    """
    known = spark.catalog.tableExists(table)
    if known and (partition_by or not _matches(spark, table, schema)):
        spark.sql(f"DROP TABLE {table}")
        known = False
    if known:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(path)}")
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING PARQUET {parts} LOCATION {_literal(path)}")
        if partition_by:
            spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables and views of a database."""
    return spark.sql(f"SHOW TABLES IN `{database}`").where(~F.col("isTemporary")).select(
        F.col("tableName").alias("table_name")
    )


def read_or_fallback(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The catalog table, or the Parquet folder if the catalog does not know the table or cannot read it."""
    if spark.catalog.tableExists(table):
        found = spark.table(table)
        location = _location(spark, table)
        if location is None or folders.exists(spark, location):
            return found
    return files.read_parquet(spark, path)


def create_view(spark: SparkSession, view: str, query: str) -> DataFrame:
    """Create or replace a stored view and return its rows."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
    return spark.table(view)


def preview(df: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def _matches(spark: SparkSession, table: str, schema: T.StructType) -> bool:
    """Whether the table has these columns and no folders."""
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        return False
    held = {f.name: f.dataType.simpleString() for f in spark.table(table).schema.fields}
    return held == {f.name: f.dataType.simpleString() for f in schema.fields}


def _location(spark: SparkSession, table: str) -> str | None:
    """Where the files of a table are; None for a view."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return found and found["data_type"]


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
