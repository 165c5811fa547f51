"""Declared schemas of the source and gold tables, and the check against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.dates import parse_yyyymmdd


class SchemaMismatch(ValueError):
    """A table lacks a declared column or holds it in another type."""


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type, ...``, without a running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Table and column names of the source systems. Ids are bigint, which int widens to.
SOURCES = {
    "crm_cust_info": _schema(
        "cst_id bigint, cst_key string, cst_firstname string, cst_lastname string, "
        "cst_marital_status string, cst_gender string, cst_create_date date"
    ),
    "crm_prd_info": _schema(
        "prd_id bigint, prd_key string, prd_nm string, prd_cost bigint, prd_line string, "
        "prd_start_dt date, prd_end_dt date"
    ),
    "crm_sales_details": _schema(
        "sls_ord_num string, sls_prd_key string, sls_cust_id bigint, sls_order_dt int, sls_ship_dt int, "
        "sls_due_date int, sls_sales bigint, sls_quantity bigint, sls_price bigint"
    ),
    "erp_cust_az12": _schema("cid string, bdate date, gen string"),
    "erp_loc_a101": _schema("cid string, cntry string"),
    "erp_px_cat_g1v2": _schema("id string, cat string, subcat string, maintenance string"),
}

# Measures keep the type that the database has for them: whole numbers, decimals or doubles.
MEASURES = ("prd_cost", "sls_sales", "sls_quantity", "sls_price")

# Names of the silver columns in the star schema.
CUSTOMER_NAMES = {
    "cst_id": "customer_id",
    "cst_key": "customer_number",
    "cst_firstname": "first_name",
    "cst_lastname": "last_name",
    "cntry": "country",
    "bdate": "birthdate",
    "gender": "gender",
    "cst_marital_status": "marital_status",
    "cst_create_date": "create_date",
}
PRODUCT_NAMES = {
    "prd_id": "product_id",
    "prd_key": "product_number",
    "prd_nm": "product_name",
    "cat_id": "category_id",
    "cat": "cat",
    "subcat": "subcat",
    "maintenance": "maintenance",
    "prd_cost": "cost",
    "prd_line": "product_line",
    "prd_start_dt": "start_date",
}
SALES_NAMES = {
    "sls_ord_num": "order_number",
    "product_key": "product_key",
    "customer_key": "customer_key",
    "sls_order_dt": "order_date",
    "sls_ship_dt": "shipping_date",
    "sls_due_date": "due_date",
    "sls_sales": "sales_amount",
    "sls_quantity": "quantity",
    "sls_price": "price",
}

# Columns of the star schema.
GOLD = {
    "dim_customers": _schema(
        "customer_key bigint, customer_id bigint, customer_number string, first_name string, last_name string, "
        "country string, birthdate date, gender string, marital_status string, create_date date"
    ),
    "dim_products": _schema(
        "product_key bigint, product_id bigint, product_number string, product_name string, category_id string, "
        "cat string, subcat string, maintenance string, cost bigint, product_line string, start_date date"
    ),
    "fact_sales": _schema(
        "order_number string, product_key bigint, customer_key bigint, order_date date, shipping_date date, "
        "due_date date, sales_amount bigint, quantity bigint, price double"
    ),
}

_WIDENING = {
    "bigint": {"tinyint", "smallint", "int"},
    "int": {"tinyint", "smallint"},
    "double": {"float", "int", "smallint", "tinyint"},
    "date": {"timestamp", "timestamp_ntz"},
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared type, followed by any further columns.

    Names match in any case and come out as declared. Narrower numbers and whole decimals, which
    databases often return for integers, widen, and timestamps become dates. Measures may be
    decimals or doubles, and stay that. Dates may be text; dates declared as whole numbers (``yyyyMMdd``) may be
    text or dates. Text that is no date becomes NULL. A missing column or another type is a
    :class:`SchemaMismatch`.
    """
    found = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        wanted = field.dataType.simpleString()
        actual = found.pop(field.name.lower(), None)
        if actual is None:
            raise SchemaMismatch(f"column {field.name} is missing")
        column = _converted(df[actual.name], actual.dataType, wanted, field.name in MEASURES)
        if column is None:
            raise SchemaMismatch(f"column {field.name} is {actual.dataType.simpleString()}, declared as {wanted}")
        columns.append(column.alias(field.name))
    return df.select(*columns, *(df[f.name] for f in found.values()))


def _converted(column: Column, held: T.DataType, wanted: str, measure: bool) -> Column | None:
    """The column in the declared type, or in its own if it is a measure; None if there is no way."""
    if held.simpleString() == wanted or measure and isinstance(held, T.DecimalType | T.DoubleType):
        return column
    if _widens(held, wanted):
        return column.cast(_TYPES[wanted])
    if isinstance(held, T.StringType) and wanted == "date":
        return F.coalesce(column.try_cast("date"), parse_yyyymmdd(column))
    if isinstance(held, T.StringType) and wanted == "int":
        return F.translate(F.trim(column), "-", "").try_cast("int")
    if held.simpleString() in ("date", "timestamp", "timestamp_ntz") and wanted == "int":
        return F.year(column) * 10_000 + F.month(column) * 100 + F.day(column)
    return None


def _widens(held: T.DataType, wanted: str) -> bool:
    if isinstance(held, T.DecimalType):
        digits = {"int": 9, "bigint": 18}.get(wanted, 0)
        return held.scale == 0 and held.precision <= digits
    return held.simpleString() in _WIDENING.get(wanted, ())
