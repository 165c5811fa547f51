"""Queries of the reports on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.plans import marts
from terrace.queries.layers import warehouse_of
from terrace.queries.oracle import with_tables
from terrace.sources.catalog import create_view


def _gold(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    warehouse = warehouse_of(spark, sf_dir)
    fact, products, customers = (warehouse.read("gold", n) for n in ("fact_sales", "dim_products", "dim_customers"))
    return fact, products, customers


def flat_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.flat_sales(*_gold(spark, sf_dir))


def agg_sales_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, products, _ = _gold(spark, sf_dir)
    return marts.agg_sales_rollup(fact, products)


def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _, customers = _gold(spark, sf_dir)
    return marts.customer_segments(fact, customers, vip_sales=1_000_000)


def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, products, _ = _gold(spark, sf_dir)
    return marts.product_performance(fact, products)


def sales_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_trend(_gold(spark, sf_dir)[0])


def seasonal_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.seasonal_index(_gold(spark, sf_dir)[0])


def seasonal_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, products, _ = _gold(spark, sf_dir)
    return marts.seasonal_forecast(fact, products)


def gold_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored view over a gold table."""
    warehouse = warehouse_of(spark, sf_dir)
    return create_view(
        spark,
        warehouse.table("gold", "open_customers"),
        f"""SELECT customer_key, customer_number, country, gender
        FROM {warehouse.table("gold", "dim_customers")} WHERE country <> 'n/a'""",
    )


def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over the registered gold tables."""
    warehouse = warehouse_of(spark, sf_dir)
    return spark.sql(
        f"""SELECT c.country, p.product_line, sum(f.sales_amount) AS sales, count(*) AS lines
        FROM {warehouse.table("gold", "fact_sales")} AS f
        JOIN {warehouse.table("gold", "dim_customers")} AS c ON f.customer_key = c.customer_key
        JOIN {warehouse.table("gold", "dim_products")} AS p ON f.product_key = p.product_key
        GROUP BY c.country, p.product_line"""
    )


_MONTHLY = """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(sum(sales_amount) AS BIGINT) AS sales
    FROM fact_sales WHERE order_date IS NOT NULL GROUP BY 1"""

_MONTHLY_BY_CATEGORY = """SELECT cat, CAST(date_trunc('month', order_date) AS DATE) AS month,
        CAST(sum(sales_amount) AS BIGINT) AS sales
    FROM fact_sales LEFT JOIN dim_products ON fact_sales.product_key = dim_products.product_key
    WHERE order_date IS NOT NULL GROUP BY 1, 2"""

QUERIES = {
    "flat_sales": (
        flat_sales,
        with_tables(
            """SELECT f.*, product_number, product_name, category_id, cat, subcat, maintenance, cost, product_line,
            customer_number, first_name, last_name, country, birthdate, gender, marital_status
        FROM fact_sales AS f LEFT JOIN dim_products AS p ON f.product_key = p.product_key
            LEFT JOIN dim_customers AS c ON f.customer_key = c.customer_key"""
        ),
    ),
    "agg_sales_rollup": (
        agg_sales_rollup,
        with_tables(
            """SELECT cat, month, CAST(grouping_id(cat, month) AS BIGINT) AS level,
            CAST(sum(sales_amount) AS BIGINT) AS sales, CAST(sum(quantity) AS BIGINT) AS quantity,
            count(DISTINCT order_number) AS orders
        FROM (SELECT cat, CAST(date_trunc('month', order_date) AS DATE) AS month, sales_amount, quantity, order_number
            FROM fact_sales LEFT JOIN dim_products ON fact_sales.product_key = dim_products.product_key) AS flat
        GROUP BY ROLLUP (cat, month)"""
        ),
    ),
    "customer_segments": (
        customer_segments,
        with_tables(
            """SELECT per.*, customer_number,
            CASE WHEN per.customer_key IS NULL THEN NULL WHEN span_months >= 12 AND sales > 1000000 THEN 'VIP'
                WHEN span_months >= 12 THEN 'Regular' ELSE 'New' END AS segment
        FROM (SELECT customer_key, count(DISTINCT order_number) AS orders, CAST(sum(sales_amount) AS BIGINT) AS sales,
                CAST(sum(quantity) AS BIGINT) AS quantity, min(order_date) AS first_order, max(order_date) AS last_order,
                date_diff('month', min(order_date), max(order_date)) AS span_months
            FROM fact_sales GROUP BY customer_key) AS per
        LEFT JOIN dim_customers ON per.customer_key = dim_customers.customer_key"""
        ),
    ),
    "product_performance": (
        product_performance,
        with_tables(
            """SELECT *, rank() OVER (PARTITION BY cat ORDER BY revenue DESC NULLS LAST) AS place
        FROM (SELECT f.product_key, product_number, cat, CAST(sum(sales_amount) AS BIGINT) AS revenue,
                CAST(sum(quantity) AS BIGINT) AS quantity, count(DISTINCT order_number) AS orders,
                CAST(sum(sales_amount - quantity * cost) AS BIGINT) AS profit
            FROM fact_sales AS f LEFT JOIN dim_products AS p ON f.product_key = p.product_key
            GROUP BY ALL) AS per"""
        ),
    ),
    "sales_trend": (
        sales_trend,
        with_tables(
            """SELECT month, sales,
            CASE WHEN lag(month) OVER w = CAST(month - INTERVAL 1 MONTH AS DATE) THEN sales - lag(sales) OVER w END AS change,
            CAST(sum(sales) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_sales
        FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(sum(sales_amount) AS BIGINT) AS sales
            FROM fact_sales GROUP BY 1) AS m
        WINDOW w AS (ORDER BY month NULLS LAST)"""
        ),
    ),
    "seasonal_index": (
        seasonal_index,
        with_tables(
            f"""SELECT CAST(month(month) AS BIGINT) AS month_of_year, round(avg(sales), 2) AS mean_sales,
            round(avg(sales) / (SELECT avg(sales) FROM ({_MONTHLY}) AS a), 4) AS seasonal_index
        FROM ({_MONTHLY}) AS m GROUP BY 1"""
        ),
    ),
    "seasonal_forecast": (
        seasonal_forecast,
        with_tables(
            f"""SELECT c.cat, CAST(y.month + INTERVAL 12 MONTH AS DATE) AS month, coalesce(sales, 0) AS forecast_sales
        FROM (SELECT DISTINCT cat FROM ({_MONTHLY_BY_CATEGORY}) AS a) AS c
        CROSS JOIN (SELECT CAST(last - to_months(CAST(back AS INTEGER)) AS DATE) AS month
            FROM (SELECT max(month) AS last FROM ({_MONTHLY}) AS b) AS l, range(0, 12) AS r(back)) AS y
        LEFT JOIN ({_MONTHLY_BY_CATEGORY}) AS m ON m.cat IS NOT DISTINCT FROM c.cat AND m.month = y.month"""
        ),
    ),
    "gold_view": (
        gold_view,
        with_tables(
            "SELECT customer_key, customer_number, country, gender FROM dim_customers WHERE country <> 'n/a'"
        ),
    ),
    "adhoc_sql": (
        adhoc_sql,
        with_tables(
            """SELECT country, product_line, CAST(sum(sales_amount) AS BIGINT) AS sales, count(*) AS lines
        FROM fact_sales AS f JOIN dim_customers AS c ON f.customer_key = c.customer_key
            JOIN dim_products AS p ON f.product_key = p.product_key
        GROUP BY country, product_line"""
        ),
    ),
}
