"""Version history: validity intervals from start dates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def close_versions(df: DataFrame, key: str, start: str, end: str, tie_break: Sequence[str]) -> DataFrame:
    """Set ``end`` to the day before the next version of the key starts; the last one stays open.

    ``start`` is taken as a date. Versions are ordered by start (NULL first), then ``tie_break``,
    which has to tell the rows of one key and start apart; for Parquet scans with copies add
    :func:`terrace.operators.keys.with_row_id`. Of versions with one start, all but the last end
    the day before that start.

    A window over whole keys would put a key with a third of all rows into one task. Here the
    window runs over the *distinct* starts of a key, which are at most the days of the calendar,
    after a map-side combine; the rows themselves are only joined, and a join can be split.
    """
    if not tie_break:
        raise ValueError("tie_break must name at least one column")
    dated = df.withColumn(start, F.to_date(start))
    starts = _last_version(dated, F.col(key).alias("_key"), F.col(start).alias("_start"), tie_break)
    by_start = Window.partitionBy("_key").orderBy("_start")
    followed = starts.withColumn("_next", F.lead("_start").over(by_start))
    same_start = F.col(key).eqNullSafe(F.col("_key")) & F.col(start).eqNullSafe(F.col("_start"))
    last = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_last_{i}")) for i, c in enumerate(tie_break)))
    following = F.when(last, F.col("_next")).otherwise(F.col("_start"))
    columns = [c for c in df.columns if c != end]
    return dated.join(followed, same_start).select(*columns, F.date_sub(following, 1).alias(end))


def _last_version(dated: DataFrame, key: Column, start: Column, tie_break: Sequence[str]) -> DataFrame:
    """``_key``, ``_start`` and the tie-break columns, as ``_last_<i>``, of the last row of each; NULL comes first.

    The columns are reduced one by one, from the last to the first. For numbers and dates each
    step is an aggregate by hash, combined before the shuffle; a maximum of structs would sort.
    """
    found = dated.select(key, start, *(F.col(c).alias(f"_last_{i}") for i, c in enumerate(tie_break)))
    for i in reversed(range(len(tie_break))):
        by, top = f"_last_{i}", [f"_last_{j}" for j in range(i)]
        # Without any value in the column, max_by finds nothing, and all rows tie.
        rest = [F.coalesce(F.max_by(c, by), F.max(c)).alias(c) for c in (f"_last_{j}" for j in range(i + 1, len(tie_break)))]
        found = found.groupBy("_key", "_start", *top).agg(F.max(by).alias(by), *rest)
    return found


def current_versions(df: DataFrame, end: str) -> DataFrame:
    """The versions that are still open."""
    return df.where(F.col(end).isNull())
