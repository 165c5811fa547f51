"""Source tables for the registered queries, made from the given tables.

The given tables are clean. Fixed arithmetic rules on their keys put in the defects that the
operators repair; ``oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2020, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def choose(number: Column, *values: Column | str | None) -> Column:
    """The value at position ``number`` modulo the count of values."""
    place = number % len(values)
    result = F.when(place == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        result = result.when(place == i, value)
    return result


def yyyymmdd(date: str) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("int")


def dirty_date(key: str, date: str) -> Column:
    """Integer date; some are 0, too short, or no day of the calendar."""
    return (
        F.when(F.col(key) % 7 == 0, 0)
        .when(F.col(key) % 11 == 0, 2024013)
        .when(F.col(key) % 13 == 0, 20241350)
        .otherwise(yyyymmdd(date))
        .cast("int")
    )


def customer_number(key: str) -> Column:
    return F.concat(F.lit("AW"), F.lpad(F.col(key).cast("string"), 12, "0"))


def product_number(key: str) -> Column:
    return F.concat(F.lit("P"), F.lpad(F.expr(f"cast({key} div 4 as string)"), 12, "0"))


def category_code(separator: str) -> Column:
    return F.concat(F.substring("p_type", 1, 2), F.lit(separator), F.substring("p_type", 3, 2))


def padded(text: Column, key: str) -> Column:
    """Text between as many blanks as the key modulo 3."""
    blanks = F.expr(f"repeat(' ', cast({key} % 3 as int))")
    return F.concat(blanks, text, blanks)


def crm_cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer record per order; ``cst_version`` tells records of one day apart."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.when(key % 17 != 0, F.col("c_custkey")).alias("cst_id"),
        customer_number("c_custkey").alias("cst_key"),
        padded(F.substring("c_name", 1, 8), "o_orderkey").alias("cst_firstname"),
        padded(F.substring("c_name", 10, 100), "c_custkey").alias("cst_lastname"),
        choose(key, "s", " M ", "S", "", None).alias("cst_marital_status"),
        choose(key + F.col("c_custkey"), "f", " M ", "F", "", None).alias("cst_gender"),
        F.to_date("o_orderdate").alias("cst_create_date"),
        key.alias("cst_version"),
    )


def crm_prd_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four versions per product; some without a start date, all with a wrong end date."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("prd_id"),
        F.concat(category_code("-"), F.lit("-"), product_number("p_partkey")).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(key % 5 != 0, F.floor("p_retailprice").cast("bigint")).alias("prd_cost"),
        choose(key, "R ", "m", " T", "S", "", None).alias("prd_line"),
        F.when(key % 41 > 1, F.date_add(F.lit(dt.date(2011, 7, 1)), F.col("p_size") * 30)).alias("prd_start_dt"),
        F.lit(dt.date(2007, 12, 28)).alias("prd_end_dt"),
    )


def crm_sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with bad dates, wrong amounts, and keys that are NULL or unknown."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    part, order, line = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber")
    quantity = F.floor("l_quantity").cast("bigint")
    unit = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("bigint")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat(F.lit("SO"), order.cast("string")).alias("sls_ord_num"),
        F.when(part % 17 == 0, F.concat(F.lit("X"), part.cast("string")))
        .when(part % 19 == 0, None)
        .otherwise(product_number("l_partkey"))
        .alias("sls_prd_key"),
        F.when(order % 13 == 0, None).when(order % 29 == 0, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey"))
        .alias("sls_cust_id"),
        dirty_date("l_orderkey", "o_orderdate").alias("sls_order_dt"),
        dirty_date("l_partkey", "l_shipdate").alias("sls_ship_dt"),
        F.when(F.col("l_suppkey") % 9 != 0, yyyymmdd("l_shipdate")).alias("sls_due_date"),
        F.when(part % 5 == 0, None)
        .when(part % 7 == 0, -quantity * unit)
        .when(part % 11 == 0, 0)
        .when(part % 13 == 0, quantity * unit + 1)
        .otherwise(quantity * unit)
        .alias("sls_sales"),
        quantity.alias("sls_quantity"),
        F.when(line % 4 == 0, None).when(line % 5 == 0, -unit).when(line % 6 == 0, 0).otherwise(unit)
        .alias("sls_price"),
    )


def erp_cust_az12(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    number = customer_number("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 11 == 0, F.concat(F.lit("NONE"), key.cast("string")))
        .when(key % 2 == 0, F.concat(F.lit("NAS"), number))
        .otherwise(number)
        .alias("cid"),
        F.date_add(F.lit(dt.date(1950, 1, 1)), (key * 37 % 30000).cast("int")).alias("bdate"),
        choose(key, "Male", "female", " M ", "F", "", None).alias("gen"),
    )


def erp_loc_a101(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    code = F.lpad(F.col("c_custkey").cast("string"), 12, "0")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.concat(F.when(F.col("c_custkey") % 23 == 0, "ZZ-").otherwise("AW-"), code).alias("cid"),
        choose(
            F.col("n_nationkey"), "DE", " US", "USA ", "  ", None, "us", F.concat(F.lit(" "), "n_name", F.lit(" "))
        ).alias("cntry"),
    )


def erp_px_cat_g1v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category per part type; the id of one type does not fit the product keys."""
    return (
        table(spark, sf_dir, "part")
        .select("p_type")
        .distinct()
        .select(
            F.when(F.col("p_type") == "PROMO", "PR_MO").otherwise(category_code("_")).alias("id"),
            F.concat(F.lit("Group "), F.substring("p_type", 1, 1)).alias("cat"),
            F.lower("p_type").alias("subcat"),
            F.when(F.length("p_type") > 5, "Yes").otherwise("No").alias("maintenance"),
        )
    )


SOURCES = {
    "crm_cust_info": crm_cust_info,
    "crm_prd_info": crm_prd_info,
    "crm_sales_details": crm_sales_details,
    "erp_cust_az12": erp_cust_az12,
    "erp_loc_a101": erp_loc_a101,
    "erp_px_cat_g1v2": erp_px_cat_g1v2,
}
