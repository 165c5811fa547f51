"""Reports on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.keys import rank_in_group
from terrace.operators.lookup import left_lookup
from terrace.staging import stage

_SPREAD_BY = ["order_number", "quantity"]  # columns that the reports read anyway
_CUSTOMER_COLUMNS = [
    "customer_number", "first_name", "last_name", "country", "birthdate", "gender", "marital_status"
]
_PRODUCT_COLUMNS = [
    "product_number", "product_name", "category_id", "cat", "subcat", "maintenance", "cost", "product_line"
]


def flat_sales(fact: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The fact with the attributes of both dimensions in one wide table."""
    joined = left_lookup(fact, products, "product_key", "product_key", _PRODUCT_COLUMNS, _SPREAD_BY)
    return left_lookup(joined, customers, "customer_key", "customer_key", _CUSTOMER_COLUMNS, _SPREAD_BY)


def agg_sales_rollup(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Sales, quantity and orders by category and month, with subtotals.

    ``level`` is 0 for category and month, 1 for a category, 3 for the total. Lines without an order
    number count as no order. The fact is reduced to products, months and orders before the join and
    to categories, months and orders after it; that table is written, and each level read from it.
    """
    sums = [F.sum("sales").alias("sales"), F.sum("quantity").alias("quantity")]
    lines = fact.select("product_key", _month().alias("month"), "order_number", F.col("sales_amount").alias("sales"), "quantity")
    per_product = lines.groupBy("product_key", "month", "order_number").agg(*sums)
    described = left_lookup(per_product, products, "product_key", "product_key", ["cat"], _SPREAD_BY)
    orders = stage(described.groupBy("cat", "month", "order_number").agg(*sums), "orders")
    no_cat, no_month = (F.lit(None).cast(orders.schema[c].dataType).alias(c) for c in ("cat", "month"))
    level = lambda n: F.lit(n).cast("bigint").alias("level")
    counted = [*sums, F.count_distinct("order_number").alias("orders")]
    columns = ["sales", "quantity", "orders"]
    return (
        orders.groupBy("cat", "month").agg(*sums, F.count("order_number").alias("orders")).select("cat", "month", level(0), *columns)
        .union(orders.groupBy("cat").agg(*counted).select("cat", no_month, level(1), *columns))
        .union(orders.agg(*counted).select(no_cat, no_month, level(3), *columns))
    )


def customer_segments(
    fact: DataFrame, customers: DataFrame, vip_sales: int = 5_000_000, loyal_months: int = 12
) -> DataFrame:
    """Orders, spending and activity span per customer, and a segment from thresholds.

    Customers active for ``loyal_months`` or longer are VIP above ``vip_sales``, else Regular;
    the others are New. Lines without a customer make one row without a key, in no segment, so that
    the rows add up to the fact.
    """
    months = F.year("last_order") * 12 + F.month("last_order") - F.year("first_order") * 12 - F.month("first_order")
    per_customer = (
        fact.groupBy("customer_key")
        .agg(
            F.countDistinct("order_number").alias("orders"),
            F.sum("sales_amount").alias("sales"),
            F.sum("quantity").alias("quantity"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
        .withColumn("span_months", months.cast("bigint"))
    )
    loyal = F.col("span_months") >= loyal_months
    known = F.col("customer_key").isNotNull()
    segment = F.when(known & loyal & (F.col("sales") > vip_sales), "VIP").when(known & loyal, "Regular").when(known, "New")
    return left_lookup(
        per_customer.withColumn("segment", segment), customers, "customer_key", "customer_key", ["customer_number"]
    )


def product_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, quantity, profit and rank by revenue within the category, per product.

    Profit is amount minus quantity times cost over the lines that have both amount and quantity.
    Products of equal revenue share a place. Lines without a product make one row without a key, so that the
    rows add up to the fact. The fact is reduced to one row per product before the join.
    """
    known = F.col("sales_amount").isNotNull() & F.col("quantity").isNotNull()
    per_product = (
        fact.groupBy("product_key")
        .agg(
            F.sum("sales_amount").alias("revenue"),
            F.sum("quantity").alias("quantity"),
            F.countDistinct("order_number").alias("orders"),
            F.sum(F.when(known, F.col("sales_amount"))).alias("earned"),
            F.sum(F.when(known, F.col("quantity"))).alias("costed"),
        )
    )
    described = left_lookup(per_product, products, "product_key", "product_key", ["product_number", "cat", "cost"])
    measured = described.select(
        "product_key",
        "product_number",
        "cat",
        "revenue",
        "quantity",
        "orders",
        (F.col("earned") - F.col("costed") * F.col("cost")).alias("profit"),
    )
    numbered = rank_in_group(measured, ["cat"], [F.col("revenue").desc(), F.col("product_key")], "_row")
    places = numbered.groupBy(F.col("cat").alias("_cat"), F.col("revenue").alias("_revenue")).agg(F.min("_row").alias("place"))
    same = F.col("cat").eqNullSafe(F.col("_cat")) & F.col("revenue").eqNullSafe(F.col("_revenue"))
    return numbered.join(places, same).select(*measured.columns, "place")


def sales_trend(fact: DataFrame) -> DataFrame:
    """Sales per month, change against the month before, and running total.

    The change is NULL if the month before has no line. Lines without a date make a last row without a
    month, so that its running total is that of the fact. The windows without a partition see one
    row per month, after the aggregation.
    """
    by_month = Window.orderBy(F.col("month").asc_nulls_last())
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    follows = F.lag("month").over(by_month) == F.add_months("month", -1)
    return monthly_sales(fact, dated=False).select(
        "month",
        "sales",
        F.when(follows, F.col("sales") - F.lag("sales").over(by_month)).alias("change"),
        F.sum("sales").over(so_far).alias("running_sales"),
    )


def seasonal_index(fact: DataFrame) -> DataFrame:
    """Mean sales of each calendar month over the mean of all months."""
    monthly = monthly_sales(fact)
    overall = monthly.agg(F.avg("sales")).scalar()
    return monthly.groupBy(F.month("month").cast("bigint").alias("month_of_year")).agg(
        F.round(F.avg("sales"), 2).alias("mean_sales"),
        F.round(F.avg("sales") / F.nullif(F.first(overall), F.lit(0.0)), 4).alias("seasonal_index"),
    )


def seasonal_forecast(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Next twelve months per category: the sales of the same month one year before, or 0.

    The fact is reduced to products and months once and written; the last month comes from there,
    as do the categories. The months are twelve conditional sums, so that no category is collected or joined
    with itself.
    """
    per_product = stage(monthly_sales(fact, "product_key"), "monthly")
    last = per_product.agg(F.max("month")).scalar()
    per_category = left_lookup(per_product, products, "product_key", "product_key", ["cat"])
    year_ago = {ahead: F.add_months(last, ahead - 12) for ahead in range(1, 13)}
    sums = [
        F.sum(F.when(F.col("month") == month, F.col("sales"))).alias(f"ahead_{ahead}")
        for ahead, month in year_ago.items()
    ]
    forecasts = [
        F.struct(
            F.add_months(month, 12).alias("month"),
            F.coalesce(F.col(f"ahead_{ahead}"), F.lit(0)).alias("forecast_sales"),
        )
        for ahead, month in year_ago.items()
    ]
    return per_category.groupBy("cat").agg(*sums).select("cat", F.inline(F.array(*forecasts)))


def _month() -> Column:
    return F.trunc("order_date", "month")


def monthly_sales(sales: DataFrame, *by: str, dated: bool = True) -> DataFrame:
    """``by``, ``month``, ``sales``."""
    lines = sales.where(F.col("order_date").isNotNull()) if dated else sales
    return lines.groupBy(*by, _month().alias("month")).agg(F.sum("sales_amount").alias("sales"))
