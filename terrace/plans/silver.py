"""Cleaning of the six source tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import codes
from terrace.functions.amounts import common_number, repair_amount, repair_price
from terrace.functions.dates import date_of, month_and_day, null_future, whole_number
from terrace.functions.text import (
    category_part,
    default_if_null,
    product_part,
    strip_prefix,
    strip_separators,
    trim_text,
)
from terrace.operators.history import close_versions
from terrace.operators.latest import latest_by_key


def silver_customers(bronze: DataFrame, tie_break: Sequence[str | Column]) -> DataFrame:
    """Newest record per customer with trimmed names and readable codes."""
    newest = latest_by_key(bronze, "cst_id", "cst_create_date", tie_break)
    return trim_text(newest, "cst_firstname", "cst_lastname").select(
        "cst_id",
        "cst_key",
        "cst_firstname",
        "cst_lastname",
        codes.decode(F.col("cst_marital_status"), codes.MARITAL_STATUS).alias("cst_marital_status"),
        codes.decode(F.col("cst_gender"), codes.GENDER).alias("cst_gender"),
        "cst_create_date",
    )


def silver_products(bronze: DataFrame, tie_break: Sequence[str]) -> DataFrame:
    """Product versions: split key, default cost, readable line, derived end date."""
    # One withColumns call: every expression still sees the full product key.
    cleaned = bronze.withColumns(
        {
            "cat_id": category_part(F.col("prd_key")),
            "prd_key": product_part(F.col("prd_key")),
            "prd_cost": default_if_null(F.col("prd_cost")),
            "prd_line": codes.decode(F.col("prd_line"), codes.PRODUCT_LINE),
        }
    )
    return close_versions(cleaned, "prd_key", "prd_start_dt", "prd_end_dt", tie_break).select(
        "prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt", "cat_id"
    )


def silver_sales(bronze: DataFrame) -> DataFrame:
    """Order lines with real dates and consistent amounts; the price uses the repaired amount.

    Amounts are whole numbers, decimals or doubles, like the columns they come from.
    """
    number = common_number([bronze.schema[c].dataType for c in ("sls_sales", "sls_quantity", "sls_price")])
    amount = repair_amount(F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price"), number)
    dates = ("sls_order_dt", "sls_ship_dt", "sls_due_date")
    # What is used several times is computed first: one step for all makes a method that is too long to be compiled.
    prepared = bronze.select(
        "sls_ord_num", "sls_prd_key", "sls_cust_id", *(whole_number(F.col(c)).alias(c) for c in dates), amount.alias("_amount"), "sls_quantity", "sls_price"
    )
    split = prepared.withColumns({f"_{c}": month_and_day(F.col(c)) for c in dates})
    return split.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        *(date_of(F.col(c), F.col(f"_{c}")).alias(c) for c in dates),
        F.col("_amount").alias("sls_sales"),
        "sls_quantity",
        repair_price(F.col("sls_price"), F.col("sls_quantity"), F.col("_amount")).alias("sls_price"),
    )


def silver_erp_customers(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Customer attributes under the plain customer number."""
    return bronze.select(
        strip_prefix(F.col("cid"), "NAS").alias("cid"),
        null_future(F.col("bdate"), as_of).alias("bdate"),
        codes.decode(F.col("gen"), codes.GENDER_WORDS).alias("gen"),
    )


def silver_locations(bronze: DataFrame) -> DataFrame:
    """Customer countries under the plain customer number."""
    return bronze.select(
        strip_separators(F.col("cid")).alias("cid"), codes.standardize_country(F.col("cntry")).alias("cntry")
    )


def silver_categories(bronze: DataFrame) -> DataFrame:
    """Product categories, unchanged."""
    return bronze.select(*(F.col(c).alias(c) for c in ("id", "cat", "subcat", "maintenance")))
