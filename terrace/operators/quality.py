"""Data-quality rules, one result row per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ["rule", "table_name", "column_name", "checked_rows", "failed_rows"]


@dataclass(frozen=True)
class Check:
    """A rule that looks at single rows; ``failed`` is true for a bad one."""

    rule: str
    column: str
    failed: Column


def not_null(column: str) -> Check:
    return Check("not_null", column, F.col(column).isNull())


def in_range(column: str, low: object, high: object) -> Check:
    """NULL passes: :func:`not_null` is the rule for it."""
    return Check("in_range", column, ~F.col(column).between(F.lit(low), F.lit(high)))


def not_before(column: str, other: str) -> Check:
    """``column`` must not lie before ``other``; NULL passes."""
    return Check("not_before", column, F.col(column) < F.col(other))


def row_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All row rules of one table in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("checked"), *(F.count_if(c.failed).alias(f"failed_{i}") for i, c in enumerate(checks))
    )
    results = [
        F.struct(
            F.lit(c.rule).alias("rule"),
            F.lit(table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.col("checked").alias("checked_rows"),
            F.col(f"failed_{i}").alias("failed_rows"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*results))).select(*COLUMNS)


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Surplus rows of non-null keys: 2 for a key that occurs three times."""
    per_key = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    surplus = F.when(F.col(column).isNotNull(), F.col("n") - 1).otherwise(0)
    return _result(per_key, "unique", table, column, surplus)


def references(df: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null key is absent from the parent table.

    The keys are counted before the join, so each is joined once however often it occurs.
    """
    per_key = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_column).alias("_parent")).distinct()
    matched = per_key.join(known, F.col(column) == F.col("_parent"), "left")
    orphans = F.when(F.col(column).isNotNull() & F.col("_parent").isNull(), F.col("n")).otherwise(0)
    return _result(matched, "references", table, column, orphans)


def report(*results: DataFrame) -> DataFrame:
    """One table of all results."""
    return reduce(DataFrame.unionByName, results)


def _result(per_key: DataFrame, rule: str, table: str, column: str, failed: Column) -> DataFrame:
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(failed), F.lit(0)).alias("failed_rows"),
    ).select(
        F.lit(rule).alias("rule"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        "checked_rows",
        "failed_rows",
    )
