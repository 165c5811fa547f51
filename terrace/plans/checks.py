"""The data-quality report of the warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from terrace.operators.history import current_versions
from terrace.operators.quality import in_range, not_before, not_null, references, report, row_checks, unique
from terrace.plans.load import Warehouse


@dataclass(frozen=True)
class Limits:
    """Smallest and largest good value of what is checked for its range."""

    cost: tuple[int, int] = (1, 1000)
    order_date: tuple[int, int] = (19000101, 20991231)
    price: tuple[int, int] = (1, 1000000)


def warehouse_report(warehouse: Warehouse, limits: Limits = Limits()) -> DataFrame:
    """One row per rule on all six sources and on the star schema.

    Among them the two oddities of derived end dates (versions that end before they start, and
    products with more than one current version), the keys whose copies would multiply rows of a
    dimension or of the fact, and the fact rows without a customer or product.
    """
    customers = warehouse.read("bronze", "crm_cust_info")
    products = warehouse.read("silver", "crm_prd_info")
    sales = warehouse.read("bronze", "crm_sales_details")
    current = current_versions(products, "prd_end_dt")
    attributes, locations, categories = (
        warehouse.read("silver", name) for name in ("erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2")
    )
    dim_customers, dim_products, fact = (
        warehouse.read("gold", name) for name in ("dim_customers", "dim_products", "fact_sales")
    )
    return report(
        row_checks(customers, "crm_cust_info", [not_null("cst_id"), not_null("cst_gender")]),
        unique(customers, "crm_cust_info", "cst_id"),
        row_checks(
            products,
            "crm_prd_info",
            [not_null("prd_start_dt"), in_range("prd_cost", *limits.cost), not_before("prd_end_dt", "prd_start_dt")],
        ),
        unique(current, "current crm_prd_info", "prd_key"),
        row_checks(
            sales,
            "crm_sales_details",
            [not_null("sls_cust_id"), in_range("sls_order_dt", *limits.order_date), in_range("sls_price", *limits.price)],
        ),
        references(sales, "crm_sales_details", "sls_prd_key", products, "prd_key"),
        references(sales, "crm_sales_details", "sls_cust_id", customers, "cst_id"),
        row_checks(attributes, "erp_cust_az12", [not_null("cid"), not_null("bdate")]),
        unique(attributes, "erp_cust_az12", "cid"),
        row_checks(locations, "erp_loc_a101", [not_null("cid")]),
        unique(locations, "erp_loc_a101", "cid"),
        row_checks(categories, "erp_px_cat_g1v2", [not_null("id")]),
        unique(categories, "erp_px_cat_g1v2", "id"),
        references(current, "current crm_prd_info", "cat_id", categories, "id"),
        unique(dim_customers, "dim_customers", "customer_key"),
        unique(dim_customers, "dim_customers", "customer_id"),
        unique(dim_products, "dim_products", "product_key"),
        unique(dim_products, "dim_products", "product_number"),
        row_checks(fact, "fact_sales", [not_null("product_key"), not_null("customer_key"), not_null("order_date")]),
        references(fact, "fact_sales", "product_key", dim_products, "product_key"),
        references(fact, "fact_sales", "customer_key", dim_customers, "customer_key"),
    )
