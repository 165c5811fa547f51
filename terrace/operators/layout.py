"""A file layout that serves filters on either of two columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.keys import content_hash


def clustered(df: DataFrame, first: str, second: str, partitions: int, bits: int = 8) -> DataFrame:
    """Order ``df`` for writing, so that files and row groups hold a narrow span of both columns.

    Each value becomes its place among ``2 ** bits`` groups of about equal size, so that a skewed column is cut where its rows
    are; the bits of both places are interleaved, and the rows range-partitioned and sorted by the result. The bounds of the groups are a
    list of ``2 ** bits - 1`` values per column, from an aggregate over all rows. Rows of one place in both are spread by
    a hash of their columns, so a dominating pair of values, or copies of one row, do not end in one task. NULLs come first.
    Columns have to be numbers, days or times.
    """
    bounds = df.agg(_bounds(df, first, bits).alias("_b1"), _bounds(df, second, bits).alias("_b2")).first()
    z = _interleaved(_place(df, first, bounds[0], bits), _place(df, second, bounds[1], bits), bits)
    sort = [F.col("_z"), F.col("_spread")]
    placed = df.withColumns({"_z": z, "_spread": content_hash(df)})
    return placed.repartitionByRange(partitions, *sort).sortWithinPartitions(*sort).drop("_z", "_spread")


def _number(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    if kind == "date":
        return F.unix_date(name).cast("double")
    return F.unix_micros(F.col(name).cast("timestamp")).cast("double") if kind.startswith("timestamp") else F.col(name).cast("double")


def _bounds(df: DataFrame, name: str, bits: int) -> Column:
    cells = 2**bits
    return F.percentile_approx(_number(df, name), [i / cells for i in range(1, cells)], 20 * cells)


def _place(df: DataFrame, name: str, bounds: list[float] | None, bits: int) -> Column:
    """How many of the bounds are at most the value, by halving."""
    if not bounds:
        return F.lit(0)
    value, held = _number(df, name), F.array(*map(F.lit, bounds))
    steps = F.array(*(F.lit(2**i) for i in reversed(range(bits))))
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(value >= F.get(held, at + step - 1), at + step).otherwise(at))
    return F.when(value.isNull(), 0).otherwise(found)


def _interleaved(a: Column, b: Column, bits: int) -> Column:
    z = F.lit(0).cast("bigint")
    for i in range(bits):
        for shift, place in ((2 * i + 1, a), (2 * i, b)):
            z = z + F.shiftleft(F.shiftright(place, i).bitwiseAND(F.lit(1)).cast("bigint"), shift)
    return z
