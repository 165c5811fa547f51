"""Physical plans that must not change unnoticed."""

import re

import pytest
from pyspark.sql import functions as F

from terrace.operators import keys
from terrace.operators.history import close_versions, current_versions
from terrace.operators.keys import surrogate_key, with_position
from terrace.operators.latest import latest_by_key
from terrace.operators.lookup import left_lookup
from terrace.plans import gold, marts, silver
from terrace.queries import layers
from terrace.queries.inputs import SOURCES, table
from terrace.staging import stage

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_by_key_limits_before_the_shuffle(spark):
    text = plan(latest_by_key(table(spark, SF_DIR, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"]))
    assert text.count("WindowGroupLimit") == 2
    assert "PushedFilters: [IsNotNull(o_custkey)]" in text


def test_versions_combine_before_the_shuffle(spark, no_broadcast):
    df = table(spark, SF_DIR, "events").withColumn("s", F.to_date("ts"))
    text = plan(close_versions(df, "user_id", "s", "e", ["event_id"]))
    assert "SinglePartition" not in text
    assert "partial_max" in text
    # Rows are distributed by key and start, never by key alone.
    assert re.search(r"Exchange hashpartitioning\(coalesce\(user_id#\d+L, 0\).*coalesce\(s#", text)


def test_surrogate_key_scans_only_positions_for_the_offsets(spark, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 50)
    text = plan(surrogate_key(table(spark, SF_DIR, "customer"), ["c_custkey"], "key"))
    assert text.count("SinglePartition") == 1
    assert "ReadSchema: struct<_position:bigint>" in text


def test_current_versions_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "products")
    layers.silver_products(spark, SF_DIR).write.parquet(path)
    text = plan(current_versions(spark.read.parquet(path), "prd_end_dt").select("prd_id"))
    assert "PushedFilters: [IsNull(prd_end_dt)]" in text
    assert "ReadSchema: struct<prd_id:bigint,prd_end_dt:date>" in text


def test_lookup_spreads_rows_without_a_key(spark, no_broadcast):
    orders, customer = table(spark, SF_DIR, "orders"), table(spark, SF_DIR, "customer")
    text = plan(left_lookup(orders, customer, "o_custkey", "c_custkey", ["c_name"], ["o_orderkey"]))
    assert re.search(r"Exchange hashpartitioning\(o_custkey#\d+L, _slot#\d+", text)
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text
    never_null = spark.range(5).select("id", F.lit("x").alias("name"))
    text = plan(left_lookup(orders, never_null, "o_custkey", "id", ["name"], ["o_orderkey"]))
    assert re.search(r"Exchange hashpartitioning\(o_custkey#\d+L, _slot#\d+", text)


def test_small_dimension_is_broadcast_by_its_size(spark):
    orders, nation = table(spark, SF_DIR, "orders"), table(spark, SF_DIR, "nation")
    assert "BroadcastHashJoin" in plan(left_lookup(orders, nation, "o_custkey", "n_nationkey", ["n_name"]))


def test_row_wise_tables_do_not_shuffle(spark, tmp_path):
    for name, clean in [
        ("crm_sales_details", silver.silver_sales),
        ("erp_cust_az12", silver.silver_erp_customers),
        ("erp_loc_a101", silver.silver_locations),
    ]:
        path = str(tmp_path / name)
        SOURCES[name](spark, SF_DIR).write.parquet(path)
        text = plan(clean(spark.read.parquet(path)))
        assert "Exchange" not in text
        assert "WholeStageCodegen" in text or "*(1)" in text


def test_no_python_in_any_plan(spark, no_broadcast):
    warehouse = layers.warehouse_of(spark, SF_DIR)
    fact, products, customers = (warehouse.read("gold", n) for n in ("fact_sales", "dim_products", "dim_customers"))
    reports = [
        marts.flat_sales(fact, products, customers),
        marts.agg_sales_rollup(fact, products),
        marts.customer_segments(fact, customers),
        marts.product_performance(fact, products),
        marts.seasonal_forecast(fact, products),
        gold.fact_sales(warehouse.read("silver", "crm_sales_details"), products, customers),
    ]
    for report in reports:
        text = plan(report)
        assert "Python" not in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_reports_reduce_the_fact_before_the_join(spark, no_broadcast, monkeypatch):
    """The fact is read once, by a table of sums that is written; what is left reads that table."""
    warehouse = layers.warehouse_of(spark, SF_DIR)
    fact, products = warehouse.read("gold", "fact_sales"), warehouse.read("gold", "dim_products")
    written = []
    monkeypatch.setattr(marts, "stage", lambda df, label: written.append(plan(df)) or stage(df, label))
    for report in (marts.seasonal_forecast, marts.agg_sales_rollup):
        after = plan(report(fact, products))
        (before,) = [written.pop()]
        assert "sales_amount" not in after and "Expand" not in after + before
        lines = before.splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "sales_amount" in line)
        exchanges = [i for i, line in enumerate(lines[:scan]) if "Exchange hashpartitioning(product_key" in line]
        assert before.count("sales_amount:bigint") == 1
        assert exchanges and any("partial_sum" in line for line in lines[exchanges[-1] : scan])


def test_reports_read_only_what_they_need(spark, no_broadcast, monkeypatch):
    warehouse = layers.warehouse_of(spark, SF_DIR)
    fact, products = warehouse.read("gold", "fact_sales"), warehouse.read("gold", "dim_products")
    written = []
    monkeypatch.setattr(marts, "stage", lambda df, label: written.append(plan(df)) or stage(df, label))
    marts.agg_sales_rollup(fact, products)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", written[0])
    columns = [{c.split(":")[0] for c in schema.split(",")} for schema in schemas]
    assert {"order_number", "product_key", "order_date", "sales_amount", "quantity"} in columns
    assert {"product_key", "cat"} in columns
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(marts.sales_trend(fact)))
    assert schemas == ["order_date:date,sales_amount:bigint"]


def test_numbering_takes_ranges_at_any_size(spark):
    for df, order in ((table(spark, SF_DIR, "customer"), "c_custkey"), (table(spark, SF_DIR, "nation"), "n_nationkey")):
        numbered = with_position(df, [order])
        text = plan(numbered)
        assert "ReadSchema: struct<_position:bigint>" in text  # the only task that sees all ranges reads sizes
        assert numbered.select(F.max("position"), F.count_distinct("position")).first() == (df.count(), df.count())


def test_version_ends_with_two_tie_breaks_are_hashed(spark):
    events = table(spark, SF_DIR, "events").withColumn("end", F.lit(None).cast("date"))
    text = plan(close_versions(events, "user_id", "ts", "end", ["event_id", "value"]))
    assert "SortAggregate" not in text and "HashAggregate" in text
