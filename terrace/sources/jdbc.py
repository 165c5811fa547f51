"""Database tables over JDBC. Connection settings are passed in, never kept here."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class IncompleteWrite(RuntimeError):
    """The database does not hold the rows that were written."""


@dataclass(frozen=True)
class Connection:
    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)

    def options(self) -> dict[str, str]:
        found = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {name: value for name, value in found.items() if value is not None}


def read_table(
    spark: SparkSession,
    connection: Connection,
    table: str,
    partition_column: str | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Scan of a table, in ``partitions`` parallel reads over a numeric, date or timestamp column.

    The limits of the column are asked from the database, one row. Filters and column selection
    on the result are sent to the database. For a column with a few dominating values use
    :func:`read_ranges` with bounds that cut the rows evenly.
    """
    reader = spark.read.format("jdbc").options(**connection.options()).option("fetchsize", fetch_size)
    if partition_column is None or partitions <= 1:
        return reader.option("dbtable", table).load()
    limits = (
        reader.option("query", f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}")
        .load()
        .select(F.col("lo").cast("string"), F.col("hi").cast("string"))
        .first()
    )
    whole = spark.read.format("jdbc").options(**connection.options()).option("fetchsize", fetch_size)
    whole = whole.option("dbtable", table)
    if limits[0] is None:
        return whole.load()
    return (
        whole.option("partitionColumn", partition_column)
        .option("lowerBound", limits[0])
        .option("upperBound", limits[1])
        .option("numPartitions", partitions)
        .load()
    )


def read_ranges(
    spark: SparkSession,
    connection: Connection,
    table: str,
    column: str,
    bounds: Sequence[int | float | str],
    fetch_size: int = 10_000,
) -> DataFrame:
    """Scan of a table with one partition per range between the ascending ``bounds``."""
    properties = connection.options() | {"fetchsize": str(fetch_size)}
    return spark.read.jdbc(
        properties.pop("url"), table, predicates=range_predicates(column, bounds), properties=properties
    )


def range_predicates(column: str, bounds: Sequence[int | float | str]) -> list[str]:
    """Conditions of which every row, NULL included, meets exactly one."""
    if not bounds:
        return ["1 = 1"]
    text = [f"'{b.replace(chr(39), chr(39) * 2)}'" if isinstance(b, str) else str(b) for b in bounds]
    first = f"{column} < {text[0]} OR {column} IS NULL"
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(text, text[1:])]
    return [first, *between, f"{column} >= {text[-1]}"]


def overwrite_table(
    df: DataFrame, connection: Connection, table: str, rows: int, partitions: int = 8, batch_size: int = 10_000
) -> None:
    """Replace the rows of a database table, keeping its definition, and count them afterwards.

    Every partition is one transaction. A task whose executor is lost after its commit runs
    again and leaves its rows twice, so the table is counted and, if the number is not ``rows``,
    written once more. Pass a scan of written files, not a plan that would be computed again.
    """
    writer = (
        df.write.format("jdbc")
        .mode("overwrite")
        .options(**connection.options())
        .option("dbtable", table)
        .option("truncate", True)
        .option("numPartitions", partitions)
        .option("batchsize", batch_size)
    )
    for _ in range(2):
        writer.save()
        query = f"SELECT COUNT(*) AS n FROM {table}"
        counted = df.sparkSession.read.format("jdbc").options(**connection.options()).option("query", query).load()
        found = int(counted.first()[0])
        if found == rows:
            return
    raise IncompleteWrite(f"{table}: {found} rows in the database, {rows} written")
