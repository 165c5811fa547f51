"""Column profiles from sketches that are kept per load and merged over loads, without the rows.

Stated bounds: distinct values within ``DISTINCT_ERROR`` of the number (three standard errors of a sketch of 4,096 cells), quantiles
within ``RANK_ERROR`` of the rank, frequent values and their counts within ``COUNT_ERROR`` of the number of values. The first two hold
with a probability above 99 %, the last one always. A row of sketches has some 100 KB at most, whatever the load holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LG_CELLS, _KLL, _TRACKED = 12, 400, 2048
DISTINCT_ERROR = 3 * 1.04 / 2 ** (_LG_CELLS / 2)
RANK_ERROR = 0.01
COUNT_ERROR = 3.5 / _TRACKED


def sketches(df: DataFrame, columns: Sequence[str], load: str) -> DataFrame:
    """One row per column of ``df``, in one pass: ``load``, ``column_name``, ``n_rows``, ``n_nulls`` and three sketches.

    Values count as their text. ``ranks`` is NULL for columns that are not numbers, days or times; these are seconds or days since 1970.
    Partial sketches are combined before the shuffle, so only one row per task and column travels.
    """
    measured, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, name in enumerate(columns):
        value, kind = F.col(name), df.schema[name].dataType
        measured += [F.count(value).alias(f"_n{i}"), F.hll_sketch_agg(value.cast("string"), _LG_CELLS).alias(f"_h{i}")]
        measured.append(F.expr(f"approx_top_k_accumulate(CAST(`{name}` AS string), {_TRACKED})").alias(f"_t{i}"))
        number = as_number(name, kind)
        if number is not None:
            measured.append(F.kll_sketch_agg_double(number, _KLL).alias(f"_k{i}"))
        rows.append(
            F.struct(
                F.lit(load).alias("load"),
                F.lit(name).alias("column_name"),
                F.col("_rows").alias("n_rows"),
                (F.col("_rows") - F.col(f"_n{i}")).alias("n_nulls"),
                F.col(f"_h{i}").alias("distinct"),
                (F.lit(None).cast("binary") if number is None else F.when(F.col(f"_n{i}") > 0, F.col(f"_k{i}"))).alias("ranks"),
                F.col(f"_t{i}").alias("frequent"),
            )
        )
    return df.agg(*measured).select(F.inline(F.array(*rows)))


def profile(held: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), top: int = 10) -> DataFrame:
    """Merge the sketches of any number of loads: per column ``n_rows``, ``n_nulls``, ``n_distinct``, ``quantiles``, ``frequent``.

    ``quantiles`` is NULL without numbers; ``frequent`` is a list of (item, count), the most frequent first.
    """
    merged = held.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.hll_union_agg("distinct").alias("_distinct"),
        F.kll_merge_agg_double(F.col("ranks"), _KLL).alias("_ranks"),
        F.count("ranks").alias("_numbers"),
        F.expr(f"approx_top_k_combine(frequent, {_TRACKED})").alias("_frequent"),
    )
    at = F.when(F.col("_numbers") > 0, F.kll_sketch_get_quantile_double("_ranks", F.array(*map(F.lit, quantiles))))
    # NULL is an item of the sketch too.
    frequent = F.expr(f"slice(filter(approx_top_k_estimate(_frequent, {top + 1}), found -> found.item IS NOT NULL), 1, {top})")
    return merged.select("column_name", "n_rows", "n_nulls", F.hll_sketch_estimate("_distinct").alias("n_distinct"), at.alias("quantiles"), frequent.alias("frequent"))


def as_number(name: str, kind: T.DataType):
    """The column as a double, or None if it has no such form."""
    value = F.col(name)
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")) / 1e6
    return None
