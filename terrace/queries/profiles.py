"""Queries of column profiles, of fitted forecasts and of a layout for two filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators import profile
from terrace.operators.layout import clustered
from terrace.operators.lookup import left_lookup
from terrace.plans import marts, smoothing
from terrace.queries.inputs import table
from terrace.queries.layers import warehouse_of
from terrace.queries.oracle import with_tables
from terrace.queries.reports import _MONTHLY_BY_CATEGORY
from terrace.sources.files import read_parquet
from terrace.staging import scratch_path, stage

_LOADS = 4
_QUANTILES = (0.25, 0.5, 0.75)


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in four loads: the exact profile, and whether that from merged sketches is within its bounds.

    A third of the lines are of one part, and a seventh have no tax.
    """
    key = F.col("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(
        (key % _LOADS).alias("load"),
        F.when(key % 3 == 0, 1).otherwise(F.col("l_partkey")).alias("part"),
        F.when(F.col("l_linenumber") != 7, F.col("l_tax")).alias("tax"),
        F.col("l_returnflag").alias("flag"),
        F.to_date("l_shipdate").alias("day"),
    )
    columns, path = lines.columns[1:], scratch_path(spark, "sketches")
    for load in range(_LOADS):
        profile.sketches(lines.where(F.col("load") == load), columns, f"load {load}").write.mode("append").parquet(path)
    found = profile.profile(spark.read.parquet(path), _QUANTILES, top=100).withColumnsRenamed({"n_rows": "rows_", "n_nulls": "nulls_", "n_distinct": "distinct_"})
    # The exact side: the number of rows of each value, from which all figures follow.
    numbers = {c: profile.as_number(c, lines.schema[c].dataType) for c in columns}
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), (F.lit(None).cast("double") if n is None else n).alias("number"))
        for c, n in numbers.items()
    ]
    counted = lines.select(F.inline(F.array(*pairs))).groupBy("column_name", "value", "number").agg(F.count(F.lit(1)).alias("n"))
    by_column = counted.join(F.broadcast(found), "column_name")  # a row per column
    filled, estimated = F.col("value").isNotNull(), F.map_from_entries("frequent")[F.col("value")]
    bound = profile.COUNT_ERROR * F.col("rows_")
    sums = [F.sum(F.when(F.col("number") < F.get("quantiles", F.lit(i)), F.col("n"))).alias(f"_below{i}") for i in range(len(_QUANTILES))]
    sums += [F.sum(F.when(F.col("number") <= F.get("quantiles", F.lit(i)), F.col("n"))).alias(f"_upto{i}") for i in range(len(_QUANTILES))]
    measured = by_column.groupBy("column_name", "rows_", "nulls_", "distinct_", F.size("frequent").alias("_listed")).agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0)).alias("n_nulls"),
        F.count("value").alias("n_distinct"),
        F.count("number").alias("_numbers"),
        # An item of the list is as frequent as it says; one that is missing is not more frequent than the bound, unless the list is full.
        F.bool_and(F.when(estimated.isNotNull(), F.abs(estimated - F.col("n")) <= bound).otherwise(~filled | (F.col("n") <= bound) | (F.size("frequent") == 100))).alias("_frequent"),
        *sums,
    )
    values = F.col("n_rows") - F.col("n_nulls")
    ranked = [
        (F.coalesce(F.col(f"_below{i}"), F.lit(0)) <= (q + profile.RANK_ERROR) * values) & (F.coalesce(F.col(f"_upto{i}"), F.lit(0)) >= (q - profile.RANK_ERROR) * values)
        for i, q in enumerate(_QUANTILES)
    ]
    return measured.select(
        "column_name",
        "n_rows",
        "n_nulls",
        "n_distinct",
        ((F.col("rows_") == F.col("n_rows")) & (F.col("nulls_") == F.col("n_nulls"))).alias("counts_equal"),
        (F.abs(F.col("distinct_") - F.col("n_distinct")) <= F.greatest(F.lit(1.0), profile.DISTINCT_ERROR * F.col("n_distinct"))).alias("distinct_within"),
        F.when(F.col("_numbers") > 0, ranked[0] & ranked[1] & ranked[2]).alias("quantiles_within"),
        F.col("_frequent").alias("frequent_within"),
    )


def smoothed_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next twelve months per category, by smoothing with shares that fit its sales so far best."""
    warehouse = warehouse_of(spark, sf_dir)
    fact, products = warehouse.read("gold", "fact_sales"), warehouse.read("gold", "dim_products")
    per_product = stage(marts.monthly_sales(fact, "product_key"), "monthly")
    per_category = left_lookup(per_product, products, "product_key", "product_key", ["cat"])
    monthly = per_category.groupBy("cat", "month").agg(F.sum("sales").alias("sales"))
    found = smoothing.smoothed_forecast(monthly, ["cat"], "month", "sales")
    return found.withColumn("forecast", F.round("forecast", 2))


_CUSTOMERS, _DAYS = (100, 149), (dt.date(1996, 3, 1), dt.date(1996, 3, 31))


def clustered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders laid out by customer and day at once, read by either."""
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    path = scratch_path(spark, "clustered")
    clustered(orders, "o_custkey", "o_orderdate", spark.sparkContext.defaultParallelism).write.parquet(path)
    held = read_parquet(spark, path, orders.schema)
    by_customer = held.where(F.col("o_custkey").between(*_CUSTOMERS)).select(F.lit("customer").alias("filter"), *columns)
    first, last = (F.lit(dt.datetime.combine(d, dt.time())).cast(T.TimestampNTZType()) for d in _DAYS)
    return by_customer.unionAll(held.where(F.col("o_orderdate").between(first, last)).select(F.lit("day").alias("filter"), *columns))


_LIST = ", ".join
_GRID = " CROSS JOIN ".join(
    f"(VALUES {_LIST(f'(CAST({x} AS DOUBLE))' for x in values)}) AS {name}({name})"
    for name, values in (("a", smoothing.LEVELS), ("b", smoothing.TRENDS), ("g", smoothing.SEASONS))
)

QUERIES = {
    "column_profile": (
        column_profile,
        """WITH lines AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS part, CASE WHEN l_linenumber <> 7 THEN l_tax END AS tax,
            l_returnflag AS flag, CAST(l_shipdate AS DATE) AS day FROM lineitem)
        """
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct,
            TRUE AS counts_equal, TRUE AS distinct_within, {"CAST(NULL AS BOOLEAN)" if c == "flag" else "TRUE"} AS quantiles_within,
            TRUE AS frequent_within FROM lines"""
            for c in ("part", "tax", "flag", "day")
        ),
    ),
    "smoothed_forecast": (
        smoothed_forecast,
        with_tables(
            f"""SELECT cat, CAST(until + to_months(CAST(k AS INTEGER)) AS DATE) AS month, round(l + CAST(k AS DOUBLE) * tr + s[k], 2) AS forecast,
            a AS level_share, b AS trend_share, g AS season_share
        FROM (WITH RECURSIVE m AS ({_MONTHLY_BY_CATEGORY}),
            months AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM m),
            series AS (SELECT c.cat, list(CAST(coalesce(sales, 0) AS DOUBLE) ORDER BY months.month) AS v, max(months.month) AS until
                FROM (SELECT DISTINCT cat FROM m) AS c CROSS JOIN months
                LEFT JOIN m ON m.cat IS NOT DISTINCT FROM c.cat AND m.month = months.month GROUP BY c.cat),
            begun AS (SELECT *, list_sum(v[1:12]) / 12 AS f1, list_sum(v[13:24]) / 12 AS f2 FROM series WHERE len(v) >= 24),
            fold AS (
                SELECT cat, v, until, a, b, g, 12 AS t, f1 AS l, (f2 - f1) / 12 AS tr, [x - f1 for x in v[1:12]] AS s, CAST(0 AS DOUBLE) AS e
                FROM begun CROSS JOIN {_GRID}
                UNION ALL
                SELECT cat, v, until, a, b, g, t + 1, l + tr + a * (v[t + 1] - (l + tr + s[1])), tr + b * (a * (v[t + 1] - (l + tr + s[1]))),
                    list_concat(s[2:12], [s[1] + g * (v[t + 1] - (l + tr + s[1]))]),
                    e + (v[t + 1] - (l + tr + s[1])) * (v[t + 1] - (l + tr + s[1]))
                FROM fold WHERE t < len(v))
            SELECT * FROM fold WHERE t = len(v) QUALIFY row_number() OVER (PARTITION BY cat ORDER BY e, a, b, g) = 1) AS best
        CROSS JOIN range(1, 13) AS r(k)"""
        ),
    ),
    "clustered_scan": (
        clustered_scan,
        f"""SELECT 'customer' AS filter, o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_custkey BETWEEN {_CUSTOMERS[0]} AND {_CUSTOMERS[1]}
        UNION ALL SELECT 'day', o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '{_DAYS[0]}' AND TIMESTAMP '{_DAYS[1]}'""",
    ),
}
