"""Queries of the sources, sinks, catalog, layers and star schema."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.dates import parse_yyyymmdd
from terrace.plans import gold, medallion, silver
from terrace.plans.checks import warehouse_report
from terrace.plans.load import Audit, Load, Warehouse, audit_table, run_loads
from terrace.queries.inputs import AS_OF, SOURCES, table
from terrace.queries.oracle import with_tables
from terrace.sources import catalog, files
from terrace.sources.schemas import SOURCES as DECLARED
from terrace.sources.schemas import conform
from terrace.staging import scratch_path, stage

_built: dict[tuple[str, str], Warehouse] = {}


def new_warehouse(spark: SparkSession) -> Warehouse:
    """An empty warehouse with database names of its own."""
    return Warehouse(spark, scratch_path(spark, "warehouse"), f"terrace_{uuid.uuid4().hex[:12]}_")


def build_warehouse(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, list[Audit]]:
    warehouse = new_warehouse(spark)
    audits = medallion.run(warehouse, lambda name: SOURCES[name](spark, sf_dir), [F.col("cst_version").desc()], AS_OF)
    return warehouse, audits


def warehouse_of(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of a data folder, loaded by the first query of the application that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build_warehouse(spark, sf_dir)[0]
    return _built[key]


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    files.overwrite_parquet(orders, path)
    return files.read_parquet(spark, path, orders.schema)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as CSV with a header line and read in declared types."""
    parts = table(spark, sf_dir, "part")
    path = scratch_path(spark, "parts")
    parts.write.option("header", True).csv(path)
    return files.read_csv(spark, path, parts.schema)


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of five tables in one run, and the keys of all of them read back."""
    keys = {
        "region": "r_regionkey", "nation": "n_nationkey", "supplier": "s_suppkey", "customer": "c_custkey",
        "orders": "o_orderkey",
    }
    warehouse = new_warehouse(spark)
    run_loads(warehouse, [[Load("bronze", n, lambda _, n=n: table(spark, sf_dir, n)) for n in keys]])
    copies = [
        warehouse.read("bronze", name).select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("key"))
        for name, key in keys.items()
    ]
    return copies[0].union(copies[1]).union(copies[2]).union(copies[3]).union(copies[4])


def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark)
    warehouse.save("silver", "customer", table(spark, sf_dir, "customer"))
    return spark.sql(f"SELECT * FROM {warehouse.table('silver', 'customer')}")


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables found in a database, with the rows that a scan of each finds."""
    warehouse = new_warehouse(spark)
    names = ["customer", "orders", "part"]
    run_loads(warehouse, [[Load("bronze", n, lambda _, n=n: table(spark, sf_dir, n)) for n in names]])
    listed = catalog.tables(spark, f"{warehouse.prefix}bronze")
    counts = [
        warehouse.read("bronze", name)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("name"), "row_count")
        for name in names
    ]
    counted = counts[0].union(counts[1]).union(counts[2])
    return listed.join(counted, F.col("table_name") == F.col("name"), "left").select("table_name", "row_count")


def read_or_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table found in the catalog and one found only as files."""
    warehouse = new_warehouse(spark)
    warehouse.save("silver", "supplier", table(spark, sf_dir, "supplier"))
    files.overwrite_parquet(table(spark, sf_dir, "customer"), warehouse.path("silver", "customer"))
    supplier, customer = warehouse.read("silver", "supplier"), warehouse.read("silver", "customer")
    return supplier.select(F.lit("catalog").alias("origin"), F.col("s_name").alias("name")).union(
        customer.select(F.lit("files").alias("origin"), F.col("c_name").alias("name"))
    )


def range_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated ids 0..n-1, n being the number of orders, each with its order if there is one."""
    orders = table(spark, sf_dir, "orders")
    ids = spark.range(orders.count())
    return ids.join(orders, ids.id == orders.o_orderkey, "left").select("id", "o_orderstatus")


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return catalog.preview(orders, ["o_orderkey"])


def _absent(name: str) -> DataFrame:
    raise LookupError(f"no table {name}")


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads: two good ones, one whose source is absent, one that depends on it."""
    warehouse = new_warehouse(spark)
    steps = [
        [
            Load("bronze", "orders", lambda _: table(spark, sf_dir, "orders")),
            Load("bronze", "lineitem", lambda _: table(spark, sf_dir, "lineitem")),
            Load("bronze", "absent", lambda _: _absent("no_such_table")),
        ],
        [Load("silver", "absent", lambda w: w.read("bronze", "absent"), needs=("bronze.absent",))],
    ]
    audits = run_loads(warehouse, steps)
    return audit_table(spark, audits).select("layer", "table_name", "row_count", "status")


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_customers(SOURCES["crm_cust_info"](spark, sf_dir), [F.col("cst_version").desc()])


def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_products(SOURCES["crm_prd_info"](spark, sf_dir), ["prd_id"])


def silver_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_sales(SOURCES["crm_sales_details"](spark, sf_dir))


def silver_sales_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as another database has them: quarters as decimals, dates as text and as dates."""
    # Written before they are changed, and before they are cleaned, as loads are: all of it at once is a method too long to be compiled.
    sales = stage(SOURCES["crm_sales_details"](spark, sf_dir), "sales")
    money = {c: (F.col(c) / 4).cast("decimal(14,2)") for c in ("sls_sales", "sls_price")}
    shipped, due = parse_yyyymmdd(F.col("sls_ship_dt")), parse_yyyymmdd(F.col("sls_due_date"))
    dates = {"sls_order_dt": F.col("sls_order_dt").cast("string"), "sls_ship_dt": shipped, "sls_due_date": due.cast("string")}
    other = stage(sales.withColumns({**money, **dates}), "other_sales")
    cleaned = silver.silver_sales(conform(other, DECLARED["crm_sales_details"]))
    return cleaned.withColumn("sls_sales", F.col("sls_sales").cast("double"))


def silver_erp_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_erp_customers(SOURCES["erp_cust_az12"](spark, sf_dir), AS_OF)


def silver_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_locations(SOURCES["erp_loc_a101"](spark, sf_dir))


def silver_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_categories(SOURCES["erp_px_cat_g1v2"](spark, sf_dir))


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_customers(
        silver_customers(spark, sf_dir), silver_erp_customers(spark, sf_dir), silver_locations(spark, sf_dir)
    )


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_products(silver_products(spark, sf_dir), silver_categories(spark, sf_dir))


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written order lines looked up in the written dimensions."""
    warehouse = warehouse_of(spark, sf_dir)
    return gold.fact_sales(
        warehouse.read("silver", "crm_sales_details"),
        warehouse.read("gold", "dim_products"),
        warehouse.read("gold", "dim_customers"),
    )


def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run; one row per loaded table."""
    _, audits = build_warehouse(spark, sf_dir)
    return audit_table(spark, audits).select("layer", "table_name", "row_count", "status")


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse_report(warehouse_of(spark, sf_dir))


def _counts(layer: str, names: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, (SELECT count(*) FROM {source}) AS row_count, "
        "'ok' AS status"
        for name, source in names.items()
    )


def _check(rule: str, table_name: str, column: str, failed: str, source: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table_name}' AS table_name, '{column}' AS column_name, "
        f"count(*) AS checked_rows, count(*) FILTER (WHERE {failed}) AS failed_rows FROM {source}"
    )


def _surplus(table_name: str, column: str, source: str) -> str:
    return (
        f"SELECT 'unique' AS rule, '{table_name}' AS table_name, '{column}' AS column_name, "
        f"count(*) AS checked_rows, count({column}) - count(DISTINCT {column}) AS failed_rows FROM {source}"
    )


_BRONZE = {
    "crm_cust_info": "b_cust", "crm_prd_info": "b_prd", "crm_sales_details": "b_sales", "erp_cust_az12": "b_erp",
    "erp_loc_a101": "b_loc", "erp_px_cat_g1v2": "b_cat",
}
_SILVER = {name: "s" + source[1:] for name, source in _BRONZE.items()}
_GOLD = {name: name for name in ("dim_customers", "dim_products", "fact_sales")}

QUERIES = {
    "parquet_roundtrip": (parquet_roundtrip, "SELECT * FROM orders"),
    "csv_roundtrip": (csv_roundtrip, "SELECT * FROM part"),
    "bronze_ingest": (
        bronze_ingest,
        """SELECT 'region' AS table_name, CAST(r_regionkey AS BIGINT) AS key FROM region
        UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT) FROM nation
        UNION ALL SELECT 'supplier', s_suppkey FROM supplier
        UNION ALL SELECT 'customer', c_custkey FROM customer
        UNION ALL SELECT 'orders', o_orderkey FROM orders""",
    ),
    "catalog_scan": (catalog_scan, "SELECT * FROM customer"),
    "catalog_tables": (
        catalog_tables,
        """SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
        UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part""",
    ),
    "read_or_fallback": (
        read_or_fallback,
        """SELECT 'catalog' AS origin, s_name AS name FROM supplier
        UNION ALL SELECT 'files', c_name FROM customer""",
    ),
    "range_rows": (
        range_rows,
        """SELECT id, o_orderstatus FROM (SELECT unnest(range((SELECT count(*) FROM orders))) AS id) AS ids
        LEFT JOIN orders ON id = o_orderkey""",
    ),
    "preview_limit": (
        preview_limit,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
    ),
    "load_audit": (
        load_audit,
        """SELECT 'bronze' AS layer, 'orders' AS table_name, count(*) AS row_count, 'ok' AS status FROM orders
        UNION ALL SELECT 'bronze', 'lineitem', count(*), 'ok' FROM lineitem
        UNION ALL SELECT 'bronze', 'absent', NULL, 'failed'
        UNION ALL SELECT 'silver', 'absent', NULL, 'skipped'""",
    ),
    "silver_customers": (silver_customers, with_tables("SELECT * FROM s_cust")),
    "silver_products": (silver_products, with_tables("SELECT * FROM s_prd")),
    "silver_sales": (silver_sales, with_tables("SELECT * FROM s_sales")),
    "silver_sales_decimal": (
        silver_sales_decimal,
        with_tables("SELECT * REPLACE (CAST(sls_sales AS DOUBLE) / 4 AS sls_sales, sls_price / 4 AS sls_price) FROM s_sales"),
    ),
    "silver_erp_customers": (silver_erp_customers, with_tables("SELECT * FROM s_erp")),
    "silver_locations": (silver_locations, with_tables("SELECT * FROM s_loc")),
    "silver_categories": (silver_categories, with_tables("SELECT * FROM s_cat")),
    "dim_customers": (dim_customers, with_tables("SELECT * FROM dim_customers")),
    "dim_products": (dim_products, with_tables("SELECT * FROM dim_products")),
    "fact_sales": (fact_sales, with_tables("SELECT * FROM fact_sales")),
    "medallion_run": (
        medallion_run,
        with_tables(
            "\nUNION ALL ".join([_counts("bronze", _BRONZE), _counts("silver", _SILVER), _counts("gold", _GOLD)])
        ),
    ),
    "dq_report": (
        dq_report,
        with_tables(
            "\nUNION ALL ".join(
                [
                    _check("not_null", "crm_cust_info", "cst_id", "cst_id IS NULL", "b_cust"),
                    _check("not_null", "crm_cust_info", "cst_gender", "cst_gender IS NULL", "b_cust"),
                    _surplus("crm_cust_info", "cst_id", "b_cust"),
                    _check("not_null", "crm_prd_info", "prd_start_dt", "prd_start_dt IS NULL", "s_prd"),
                    _check("in_range", "crm_prd_info", "prd_cost", "prd_cost < 1 OR prd_cost > 1000", "s_prd"),
                    _check("not_before", "crm_prd_info", "prd_end_dt", "prd_end_dt < prd_start_dt", "s_prd"),
                    _surplus("current crm_prd_info", "prd_key", "s_prd WHERE prd_end_dt IS NULL"),
                    _check("not_null", "crm_sales_details", "sls_cust_id", "sls_cust_id IS NULL", "b_sales"),
                    _check(
                        "in_range", "crm_sales_details", "sls_order_dt",
                        "sls_order_dt < 19000101 OR sls_order_dt > 20991231", "b_sales",
                    ),
                    _check(
                        "in_range", "crm_sales_details", "sls_price", "sls_price < 1 OR sls_price > 1000000", "b_sales"
                    ),
                    _check(
                        "references", "crm_sales_details", "sls_prd_key",
                        "sls_prd_key IS NOT NULL AND sls_prd_key NOT IN (SELECT prd_key FROM s_prd)", "b_sales",
                    ),
                    _check(
                        "references", "crm_sales_details", "sls_cust_id",
                        "sls_cust_id IS NOT NULL AND sls_cust_id NOT IN "
                        "(SELECT cst_id FROM b_cust WHERE cst_id IS NOT NULL)",
                        "b_sales",
                    ),
                    _check("not_null", "erp_cust_az12", "cid", "cid IS NULL", "s_erp"),
                    _check("not_null", "erp_cust_az12", "bdate", "bdate IS NULL", "s_erp"),
                    _surplus("erp_cust_az12", "cid", "s_erp"),
                    _check("not_null", "erp_loc_a101", "cid", "cid IS NULL", "s_loc"),
                    _surplus("erp_loc_a101", "cid", "s_loc"),
                    _check("not_null", "erp_px_cat_g1v2", "id", "id IS NULL", "s_cat"),
                    _surplus("erp_px_cat_g1v2", "id", "s_cat"),
                    _check(
                        "references", "current crm_prd_info", "cat_id",
                        "cat_id IS NOT NULL AND cat_id NOT IN (SELECT id FROM s_cat WHERE id IS NOT NULL)",
                        "s_prd WHERE prd_end_dt IS NULL",
                    ),
                    _surplus("dim_customers", "customer_key", "dim_customers"),
                    _surplus("dim_customers", "customer_id", "dim_customers"),
                    _surplus("dim_products", "product_key", "dim_products"),
                    _surplus("dim_products", "product_number", "dim_products"),
                    *(
                        _check("not_null", "fact_sales", c, f"{c} IS NULL", "fact_sales")
                        for c in ("product_key", "customer_key", "order_date")
                    ),
                    *(
                        _check(
                            "references", "fact_sales", c,
                            f"{c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {parent})", "fact_sales",
                        )
                        for c, parent in (("product_key", "dim_products"), ("customer_key", "dim_customers"))
                    ),
                ]
            )
        ),
    ),
}
