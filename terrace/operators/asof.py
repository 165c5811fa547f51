"""Point-in-time lookups: the version that was valid when something happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.operators.ordered import in_ranges, with_earlier


def as_of_lookup(
    left: DataFrame, right: DataFrame, key: str, time: str, right_key: str, valid_from: str, columns: Sequence[str], tie_break: Sequence[str]
) -> DataFrame:
    """``left`` with ``columns`` of the version of its key that starts last, at its time or before.

    Of versions with one start the last by ``tie_break`` counts. Versions without a key or start are never found, and rows
    without a key or time, or before the first version, get NULL.

    Both sides are merged in one order of key and time, cut into ranges. Within a range each row takes the last version before
    it, and at a border the last version of all earlier ranges is carried over. So a key with a third of all rows is
    shared by tasks, however many versions it has, and rows are never multiplied by versions.
    """
    if left.schema[time].dataType != right.schema[valid_from].dataType or left.schema[key].dataType != right.schema[right_key].dataType:
        raise ValueError(f"{key} and {right_key}, and {time} and {valid_from}, have to be of the same types")
    able = F.col(key).isNotNull() & F.col(time).isNotNull()
    picked = F.struct(F.col(right_key).alias("_key"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(columns)))
    versions = right.where(F.col(right_key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(right_key).alias("_key"), F.col(valid_from).alias("_time"), F.lit(0).alias("_side"),
        *(F.col(c).alias(f"_tie_{i}") for i, c in enumerate(tie_break)), picked.alias("_version"),
    )
    rows = left.where(able).select(
        F.col(key).alias("_key"), F.col(time).alias("_time"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row")
    )
    merged = versions.unionByName(rows, allowMissingColumns=True)
    placed = in_ranges(merged, ["_key", "_time", "_side", *(f"_tie_{i}" for i in range(len(tie_break)))])
    found = with_earlier(placed, F.col("_version"), "_found").where("_side = 1")
    same = F.col("_found._key") == F.col("_key")
    matched = found.select("_row.*", *(F.when(same, F.col(f"_found._{i}")).alias(c) for i, c in enumerate(columns)))
    kinds = [right.schema[c].dataType for c in columns]
    never = left.where(~able).select(*left.columns, *(F.lit(None).cast(k).alias(c) for c, k in zip(columns, kinds)))
    return matched.unionAll(never)
