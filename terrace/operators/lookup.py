"""Left outer lookups that stay balanced when a key dominates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SLOT = "_slot"


class DuplicateKeys(ValueError):
    """The looked-up table holds a key more than once."""


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` itself, or :class:`DuplicateKeys` if a non-null key occurs twice."""
    twice = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
    if not twice.isEmpty():
        raise DuplicateKeys(f"{key} is not unique")
    return df


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys, as ``_hot``, with more than ``share`` of the rows with a key, and their ``_share``: fewer than ``1 / share`` of them."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    part = (F.col("_n") / total).alias("_share")
    return counts.select("_hot", part).where(F.col("_share") > share)


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    columns: Sequence[str],
    spread_by: Sequence[str] = (),
    hot_share: float | None = None,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Left outer join on one column pair, adding ``columns`` of ``right``.

    Rows without a match get NULL; a key that is not unique on the right multiplies rows.

    Spark chooses the join by size: it broadcasts only a side that it knows to be small, and
    otherwise splits skewed partitions of a shuffled join at run time. Two additions cover what
    is known beforehand. With ``spread_by``, rows without a key, which never match, go to
    all shuffle partitions by a hash of these columns. With ``hot_share``, keys above this share
    of the left rows are counted first, their left rows spread the same way, and only their
    right rows repeated once per slot, of which it has its share. The count runs over ``count_in``, which spares computing
    a joined ``left`` twice; a key it misses or adds changes the speed and not the result.
    """
    if hot_share is not None and not 0 < hot_share <= 1:
        raise ValueError("hot_share must be above 0 and at most 1")  # at most 1 / hot_share keys are broadcast
    slots = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = right.select(F.col(right_key).alias("_key"), *columns)
    output = [*left.columns, *columns]
    same = F.col(left_key) == F.col("_key")
    if not spread_by:
        return left.join(picked, same, "left").select(*output)

    slot = F.pmod(F.xxhash64(*spread_by), F.lit(slots))
    spread = F.col(left_key).isNull()
    # Always 0, but written so that the optimizer keeps it as a join key.
    home = F.pmod(F.xxhash64("_key"), F.lit(1))
    if hot_share is None:
        picked = picked.withColumn("_home", home)
    else:
        counted = left if count_in is None else count_in
        hot = F.broadcast(hot_keys(counted, left_key, hot_share))  # fewer than 1 / hot_share rows
        left = left.join(hot, F.col(left_key) == F.col("_hot"), "left")
        # As many slots as the key's rows would fill shuffle partitions, so no right row is repeated more often.
        own = F.ceil(F.col("_share") * slots).cast("bigint")
        spread = spread | F.col("_hot").isNotNull()
        slot = F.pmod(F.xxhash64(*spread_by), F.coalesce(own, F.lit(slots)))
        every = F.sequence(F.lit(0).cast("bigint"), own - 1)
        homes = F.when(F.col("_hot").isNotNull(), every).otherwise(F.array(home))
        picked = picked.join(hot, F.col("_key") == F.col("_hot"), "left").select(
            "_key", *columns, F.explode(homes).alias("_home")
        )
    left = left.withColumn(_SLOT, F.when(spread, slot).otherwise(0))
    return left.join(picked, same & (F.col(_SLOT) == F.col("_home")), "left").select(*output)
