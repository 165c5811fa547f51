"""Rows in the order of the whole table, shared by ranges: what came before a row, without a task that sees a whole key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators import keys
from terrace.staging import stage

AT, RANGE = "_at", "_range"
_LOW_BITS = 33  # monotonically_increasing_id(): row number in the lower 33 bits, partition above


def in_ranges(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """``df`` written in ranges of the given order, with the range and the place of each row.

    Rows that tie are ordered by their content and then by where they were written, so that a value with a third of all
    rows, and even copies of one row, spread over several ranges.
    """
    rows = stage(df, "rows")
    sort = [c if isinstance(c, Column) else F.col(c) for c in order_by] + [keys.content_hash(rows), F.col(keys.ROW_ID)]
    ranges = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // keys.ROWS_PER_RANGE))
    placed = keys.with_row_id(rows).repartitionByRange(ranges, *sort).sortWithinPartitions(*sort).drop(keys.ROW_ID)
    return stage(placed.withColumn(AT, F.monotonically_increasing_id()), "ranges").withColumn(RANGE, F.shiftright(AT, _LOW_BITS))


def with_earlier(placed: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the last value that is not NULL of the rows before each row, also across the borders of ranges."""
    before = Window.partitionBy(RANGE).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    last = placed.groupBy(RANGE).agg(F.max_by(value, F.when(value.isNotNull(), F.col(AT))).alias("_last"))
    return _with_ranges(placed, last, F.last("_last", True), "_carried").withColumn(
        name, F.coalesce(F.last(value, True).over(before), F.col("_carried"))
    ).drop("_carried")


def with_running_sum(placed: DataFrame, value: str, name: str) -> DataFrame:
    """Add the sum of a column over each row and all rows before it."""
    until = Window.partitionBy(RANGE).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0)
    sums = placed.groupBy(RANGE).agg(F.sum(value).alias("_sum"))
    summed = _with_ranges(placed, sums, F.sum("_sum"), "_carried")
    return summed.withColumn(name, F.sum(value).over(until) + F.coalesce("_carried", F.lit(0))).drop("_carried")


def _with_ranges(placed: DataFrame, per_range: DataFrame, over_earlier: Column, name: str) -> DataFrame:
    """Join what is known of all earlier ranges: one row per range, the only thing that one task sees as a whole."""
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    known = stage(per_range.select(RANGE, over_earlier.over(earlier).alias(name)), "carried")
    return placed.join(F.broadcast(known) if known.count() <= keys.MOST_BROADCAST else known, RANGE)
