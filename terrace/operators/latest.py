"""Best rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.keys import content_hash, rank_in_group

_RANK = "_rank"


def latest_by_key(df: DataFrame, key: str, newest_by: str, tie_break: Sequence[str | Column]) -> DataFrame:
    """The newest row of each key; rows without a key are dropped."""
    return top_n_per_key(df, key, [F.col(newest_by).desc(), *tie_break], 1)


def top_n_per_key(df: DataFrame, key: str, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of each non-null key in the given order.

    ``order_by`` must hold a tie-break; rows that tie in spite of it are ordered by a hash of the row.

    Spark turns the rank filter into a group limit on both sides of the shuffle: a task sends at
    most ``n`` rows of a key, so a key with a third of all rows costs its reducer ``n`` rows per
    map task. The limit holds below a threshold; a larger ``n`` is ranked by range partitions.
    """
    if len(order_by) < 2:
        raise ValueError("order_by needs a sort column and at least one tie-break")
    keyed = df.where(F.col(key).isNotNull())
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= threshold:
        window = Window.partitionBy(key).orderBy(*order_by, content_hash(df))
        ranked = keyed.withColumn(_RANK, F.row_number().over(window))
    else:
        ranked = rank_in_group(keyed, [key], order_by, _RANK)
    return ranked.where(F.col(_RANK) <= n).drop(_RANK)
