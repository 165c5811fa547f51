"""Reconciliation: which rows two tables do not have equally often."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


def differing_buckets(before: DataFrame, after: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Buckets of row hashes whose counts or sums of hashes differ. At most ``buckets`` numbers, whatever the tables."""
    a, b = (_sums(df, buckets, side) for df, side in ((before, "a"), (after, "b")))
    names = ["rows", "low", "high", "second"]
    apart = F.lit(False)
    for name in names:
        apart = apart | ~F.col(f"{name}_a").eqNullSafe(F.col(f"{name}_b"))
    return sorted(r.bucket for r in a.join(b, "bucket", "full").where(apart).select("bucket").collect())


def differences(before: DataFrame, after: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The distinct rows with ``before_rows``, ``after_rows`` and ``status``: ``lost``, ``added``, ``fewer`` or ``more``.

    Both tables have the same columns in any order. NULLs are equal to each other, and the order of rows does not count.

    Each side is first summed up to counts and order-independent sums of two hashes per bucket, combined before the shuffle. Only rows of
    buckets that differ are then counted, so equal tables shuffle no rows, and few changes few rows. Copies
    of one row are combined before the shuffle too.
    """
    if sorted(before.dtypes) != sorted(after.dtypes):
        raise ValueError("the tables have different columns")
    apart = differing_buckets(before, after.select(*before.columns), buckets)
    counted = [_counted(df.select(*before.columns), side, apart, buckets) for df, side in ((before, 0), (after, 1))]
    rows = counted[0].unionAll(counted[1]).groupBy(*before.columns).agg(
        F.sum(F.when(F.col("_side") == 0, F.col("_rows")).otherwise(0)).alias("before_rows"),
        F.sum(F.when(F.col("_side") == 1, F.col("_rows")).otherwise(0)).alias("after_rows"),
    )
    status = F.when(F.col("after_rows") == 0, "lost").when(F.col("before_rows") == 0, "added").when(F.col("after_rows") > F.col("before_rows"), "more").otherwise("fewer")
    return rows.where("before_rows <> after_rows").withColumn("status", status)


def _bucket(df: DataFrame, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*df.columns), F.lit(buckets)).cast("int")


def _sums(df: DataFrame, buckets: int, side: str) -> DataFrame:
    first, second = F.xxhash64(*df.columns), F.xxhash64(F.lit(1), *df.columns)
    hashed = df.select(_bucket(df, buckets).alias("bucket"), first.alias("first"), second.alias("second"))
    total = lambda c: F.sum(c.cast("decimal(20,0)"))
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias(f"rows_{side}"),
        F.sum(F.col("first").bitwiseAND(F.lit(2**31 - 1))).alias(f"low_{side}"),
        F.sum(F.shiftrightunsigned("first", 33)).alias(f"high_{side}"),
        total(F.col("second")).alias(f"second_{side}"),
    )


def _counted(df: DataFrame, side: int, apart: list[int], buckets: int) -> DataFrame:
    kept = df.where(_bucket(df, buckets).isin(apart) if apart else F.lit(False))
    return kept.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_side", F.lit(side))
