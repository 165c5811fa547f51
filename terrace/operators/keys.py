"""Row numbers over a whole table without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.staging import stage

ROW_ID = "_row_id"
ROWS_PER_RANGE = 1_000_000
MOST_BROADCAST = 50_000
_POSITION = "_position"
_RANGE = "_range"
_BEFORE = "_before"
_FIRST = "_first"
_LOW_BITS = 33  # monotonically_increasing_id(): row number in the lower 33 bits, partition above


def with_row_id(scan: DataFrame) -> DataFrame:
    """Add a column that tells the physical rows of a Parquet scan apart, copies included.

    It is derived from file path and row index, so a repeated task finds the same values.
    """
    return scan.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(ROW_ID))


def with_position(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "position", stored: bool = False
) -> DataFrame:
    """Add 1..n in the given order, computed by all tasks, in the same way for every number of rows.

    1. The rows are written once, which gives each of them a stable physical id, and counted
       from the file footers. With ``stored``, ``df`` is a scan of Parquet files already.
    2. They are range-partitioned by ``order_by``, then by a hash of the whole row, then by that id, sorted
       per partition and written with their number inside the partition. Unequal rows that tie
       are thus numbered by their content, however their files are cut; only equal rows are
       interchangeable, and these spread over several partitions too.
    3. The sizes of the partitions are summed up: one row per range, that is per ``ROWS_PER_RANGE``
       rows or per core. These few rows are the only thing that one task sees as a whole; they are
       broadcast up to ``MOST_BROADCAST`` of them, and joined by a shuffle beyond.
    """
    rows = df if stored else stage(df, "rows")
    ranges = _ranges(rows)
    sort = [c if isinstance(c, Column) else F.col(c) for c in order_by] + [_content(rows), F.col(ROW_ID)]
    placed = stage(
        with_row_id(rows)
        .repartitionByRange(ranges, *sort)
        .sortWithinPartitions(*sort)
        .drop(ROW_ID)
        .withColumn(_POSITION, F.monotonically_increasing_id()),
        "ranges",
    ).withColumn(_RANGE, F.shiftright(_POSITION, _LOW_BITS))
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(_RANGE)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(_RANGE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(_BEFORE))
    )
    if ranges <= MOST_BROADCAST:
        offsets = F.broadcast(offsets)
    in_range = F.col(_POSITION) - F.shiftleft(F.col(_RANGE), _LOW_BITS)
    return placed.join(offsets, _RANGE).select(*df.columns, (F.col(_BEFORE) + in_range + 1).alias(name))


def surrogate_key(df: DataFrame, order_by: Sequence[str | Column], name: str, stored: bool = False) -> DataFrame:
    """Put a gap-free integer key 1..n, in the given order, in front of the columns.

    ``stored`` as in :func:`with_position`.
    """
    return with_position(df, order_by, name, stored).select(name, *df.columns)


def rank_in_group(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str | Column], name: str, stored: bool = False
) -> DataFrame:
    """Add 1..n per group in the given order; a group of any size is shared by many tasks.

    The first position of each group is written before it is joined back, so Spark knows its
    size: it is broadcast if small, and joined by a shuffle that splits large groups if not.
    """
    placed = with_position(df, [*group, *order_by], _POSITION, stored)
    keys = [F.col(c).alias(f"_group_{i}") for i, c in enumerate(group)]
    first = stage(placed.groupBy(*keys).agg(F.min(_POSITION).alias(_FIRST)), "groups")
    same = [F.col(c).eqNullSafe(F.col(f"_group_{i}")) for i, c in enumerate(group)]
    return placed.join(first, same).select(*df.columns, (F.col(_POSITION) - F.col(_FIRST) + 1).alias(name))


def content_hash(df: DataFrame, besides: Sequence[str] = ()) -> Column:
    """A hash of all columns that can be hashed, so that unequal rows can be told apart by what they hold."""
    return _content(df.drop(*besides))


def _content(rows: DataFrame) -> Column:
    return F.xxhash64(*(c for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind))


def _ranges(rows: DataFrame) -> int:
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_RANGE))
