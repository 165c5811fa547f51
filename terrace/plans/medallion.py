"""The three-layer run: copy the sources, clean them, build the star schema."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from terrace.operators.keys import ROW_ID, content_hash, with_row_id
from terrace.plans import gold, marts, silver
from terrace.plans.load import Audit, Load, LoadFailed, Warehouse, run_loads
from terrace.sources.jdbc import Connection, overwrite_table, read_table
from terrace.sources.schemas import GOLD, SOURCES, conform

Source = Callable[[str], DataFrame]
_CONTENT = "_content"


def bronze_loads(source: Source) -> list[Load]:
    """Unchanged copies of the source tables."""
    return [Load("bronze", name, lambda _, name=name: source(name)) for name in SOURCES]


def silver_loads(
    customer_tie_break: Sequence[str | Column] | None = None, as_of: dt.date | None = None
) -> list[Load]:
    """Cleaned tables, each from its bronze copy.

    ``customer_tie_break`` orders customer records of one day; by default it is the rest of the
    columns, so that the choice depends on nothing but the records.
    """
    if customer_tie_break is None:
        declared = SOURCES["crm_cust_info"].fieldNames()
        customer_tie_break = [c for c in declared if c not in ("cst_id", "cst_create_date")]
    rules: dict[str, Callable[[DataFrame], DataFrame]] = {
        "crm_cust_info": lambda df: silver.silver_customers(df, customer_tie_break),
        "crm_prd_info": lambda df: silver.silver_products(df, ["prd_id", _CONTENT, ROW_ID]),
        "crm_sales_details": silver.silver_sales,
        "erp_cust_az12": lambda df: silver.silver_erp_customers(df, as_of),
        "erp_loc_a101": silver.silver_locations,
        "erp_px_cat_g1v2": silver.silver_categories,
    }

    def build(warehouse: Warehouse, name: str) -> DataFrame:
        bronze = warehouse.read("bronze", name)
        if name == "crm_prd_info":
            # Versions that tie are ordered by what they hold, and only equal ones by their place in the files.
            bronze = with_row_id(bronze).withColumn(_CONTENT, content_hash(bronze))
        return rules[name](conform(bronze, SOURCES[name]))

    return [
        Load("silver", name, lambda warehouse, name=name: build(warehouse, name), (f"bronze.{name}",))
        for name in SOURCES
    ]


def gold_loads(
    fact_partition_by: tuple[str, ...] = (), hot_share: float | None = None, unique_keys: bool = False
) -> list[list[Load]]:
    """Both dimensions, then the fact, which reads the written dimensions.

    ``hot_share`` as in :func:`terrace.operators.lookup.left_lookup`, ``unique_keys`` as in
    :func:`terrace.plans.gold.dim_customers`.
    """
    dimensions = [
        Load(
            "gold",
            "dim_customers",
            lambda w: gold.dim_customers(
                w.read("silver", "crm_cust_info"),
                w.read("silver", "erp_cust_az12"),
                w.read("silver", "erp_loc_a101"),
                unique_keys,
            ),
            ("silver.crm_cust_info", "silver.erp_cust_az12", "silver.erp_loc_a101"),
        ),
        Load(
            "gold",
            "dim_products",
            lambda w: gold.dim_products(
                w.read("silver", "crm_prd_info"), w.read("silver", "erp_px_cat_g1v2"), unique_keys
            ),
            ("silver.crm_prd_info", "silver.erp_px_cat_g1v2"),
        ),
    ]
    fact = Load(
        "gold",
        "fact_sales",
        lambda w: gold.fact_sales(
            w.read("silver", "crm_sales_details"),
            w.read("gold", "dim_products"),
            w.read("gold", "dim_customers"),
            hot_share,
        ),
        ("silver.crm_sales_details", "gold.dim_products", "gold.dim_customers"),
        partition_by=fact_partition_by,
    )
    return [dimensions, [fact]]


def report_loads() -> list[Load]:
    """The flat and the aggregated tables, from the written star schema."""
    builds: dict[str, Callable[[DataFrame, DataFrame, DataFrame], DataFrame]] = {
        "flat_sales": marts.flat_sales,
        "agg_sales_rollup": lambda fact, products, _: marts.agg_sales_rollup(fact, products),
        "customer_segments": lambda fact, _, customers: marts.customer_segments(fact, customers),
        "product_performance": lambda fact, products, _: marts.product_performance(fact, products),
        "sales_trend": lambda fact, *_: marts.sales_trend(fact),
        "seasonal_index": lambda fact, *_: marts.seasonal_index(fact),
        "seasonal_forecast": lambda fact, products, _: marts.seasonal_forecast(fact, products),
    }

    def build(warehouse: Warehouse, name: str) -> DataFrame:
        return builds[name](*(warehouse.read("gold", n) for n in ("fact_sales", "dim_products", "dim_customers")))

    needs = ("gold.fact_sales", "gold.dim_products", "gold.dim_customers")
    return [Load("gold", name, lambda w, name=name: build(w, name), needs) for name in builds]


def export_loads(connection: Connection, schema: str = "gold", partitions: int = 8) -> list[Load]:
    """Copies of the gold tables in a database, read from the written files."""

    def sink(name: str) -> Callable[[DataFrame], int]:
        def send(df: DataFrame) -> int:
            rows = df.count()  # from the file footers
            overwrite_table(df, connection, f"{schema}.{name}", rows, partitions)
            return rows

        return send

    return [
        Load("database", name, lambda w, name=name: w.read("gold", name), (f"gold.{name}",), sink(name))
        for name in GOLD
    ]


def jdbc_source(
    spark: SparkSession,
    connection: Connection,
    schema: str = "bronze",
    parallel_by: Mapping[str, tuple[str, int]] | None = None,
) -> Source:
    """Source tables in a database; ``parallel_by`` gives column and number of reads per table.

    A table without an entry is read by one task, which warns: that fits small tables only.
    """

    def read(name: str) -> DataFrame:
        column, partitions = (parallel_by or {}).get(name, (None, 1))
        if column is None or partitions <= 1:
            warnings.warn(f"{schema}.{name} is read by one task; name a column in parallel_by to share it", stacklevel=2)
        return read_table(spark, connection, f"{schema}.{name}", column, partitions)

    return read


def run(
    warehouse: Warehouse,
    source: Source,
    customer_tie_break: Sequence[str | Column] | None = None,
    as_of: dt.date | None = None,
    export_to: Connection | None = None,
    layers: Sequence[str] = ("bronze", "silver", "gold"),
    fact_partition_by: tuple[str, ...] = (),
    hot_share: float | None = None,
    with_reports: bool = False,
    parallel: int = 4,
    unique_keys: bool = False,
) -> list[Audit]:
    """Full load of the given layers; raises :class:`LoadFailed` at the end if a table is not loaded.

    ``fact_partition_by`` and ``hot_share`` shape the load of the fact; ``with_reports`` adds the flat and the aggregated tables to the gold layer;
    with ``unique_keys``, a dimension whose looked-up keys are not unique fails.
    """
    steps: list[list[Load]] = []
    if "bronze" in layers:
        steps.append(bronze_loads(source))
    if "silver" in layers:
        steps.append(silver_loads(customer_tie_break, as_of))
    if "gold" in layers:
        steps += gold_loads(fact_partition_by, hot_share, unique_keys)
    if with_reports:
        steps.append(report_loads())
    if export_to is not None:
        steps.append(export_loads(export_to))
    audits = run_loads(warehouse, steps, parallel)
    if any(a.status != "ok" for a in audits):
        raise LoadFailed(audits)
    return audits
