"""Star schema: two dimensions and the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.codes import prefer
from terrace.operators.history import current_versions
from terrace.operators.keys import surrogate_key
from terrace.operators.lookup import left_lookup, require_unique
from terrace.operators.project import renamed
from terrace.sources.schemas import CUSTOMER_NAMES, PRODUCT_NAMES, SALES_NAMES


def dim_customers(
    customers: DataFrame, erp: DataFrame, locations: DataFrame, unique_keys: bool = False
) -> DataFrame:
    """Customers with birth date, gender and country, numbered by customer id.

    A customer number that occurs twice in ``erp`` or ``locations`` multiplies the customer;
    ``unique_keys`` makes that an error. Each lookup has a shuffle of its own, which lets Spark
    split a dominating customer number.
    """
    if unique_keys:
        erp, locations = require_unique(erp, "cid"), require_unique(locations, "cid")
    joined = left_lookup(customers, erp, "cst_key", "cid", ["bdate", "gen"], ["cst_id"])
    joined = left_lookup(joined, locations, "cst_key", "cid", ["cntry"], ["cst_id"])
    gender = prefer(F.col("cst_gender"), F.col("gen"))
    return surrogate_key(renamed(joined.withColumn("gender", gender), CUSTOMER_NAMES), ["customer_id"], "customer_key")


def dim_products(products: DataFrame, categories: DataFrame, unique_keys: bool = False) -> DataFrame:
    """Current product versions with their category, numbered by id and start date.

    ``unique_keys`` makes a category id that occurs twice an error.
    """
    if unique_keys:
        categories = require_unique(categories, "id")
    joined = left_lookup(
        current_versions(products, "prd_end_dt"),
        categories,
        "cat_id",
        "id",
        ["cat", "subcat", "maintenance"],
        ["prd_id"],
    )
    return surrogate_key(renamed(joined, PRODUCT_NAMES), ["product_id", "start_date"], "product_key")


def fact_sales(
    sales: DataFrame, products: DataFrame, customers: DataFrame, hot_share: float | None = None
) -> DataFrame:
    """Order lines with the keys of both dimensions; lines without a match keep NULL keys."""
    spread_by = ["sls_ord_num", "sls_ship_dt", "sls_quantity", "sls_price"]
    joined = left_lookup(sales, products, "sls_prd_key", "product_number", ["product_key"], spread_by, hot_share)
    joined = left_lookup(joined, customers, "sls_cust_id", "customer_id", ["customer_key"], spread_by, hot_share, sales)
    return renamed(joined, SALES_NAMES)
