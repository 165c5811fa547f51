"""Sources, catalog, loads and the star schema."""

import datetime as dt
import os
import warnings

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators import lookup
from terrace.operators.lookup import DuplicateKeys
from terrace.plans import gold, load, marts, medallion, silver
from terrace.plans.checks import warehouse_report
from terrace.plans.load import AUDIT_SCHEMA, Load, LoadFailed, Warehouse, audit_table, run_loads
from terrace.queries.layers import new_warehouse
from terrace.sources import catalog, files, jdbc
from terrace.sources.schemas import GOLD, SOURCES, SchemaMismatch, conform

D = dt.date


@pytest.fixture
def warehouse(spark):
    return new_warehouse(spark)


@pytest.fixture(scope="module")
def source(spark):
    """A small set of source tables with one of each defect."""
    rows = {
        "crm_cust_info": [
            (11, "AW11", " Ann ", "Lee ", "S", "F", D(2020, 1, 1)),
            (11, "AW11", "Anna", "Lee", "m", "n", D(2020, 2, 1)),
            (12, "AW12", "Bob", "Ray", None, "M", D(2020, 1, 5)),
            (None, "AW13", "No", "Id", "S", "M", D(2020, 1, 5)),
        ],
        "crm_prd_info": [
            (1, "AC-HE-HL-1", "Helmet", None, "S ", D(2011, 7, 1), D(2007, 12, 28)),
            (2, "AC-HE-HL-1", "Helmet", 14, "S ", D(2012, 7, 1), None),
            (3, "CO-PE-PD-9", "Pedal", 9, None, D(2013, 7, 1), None),
        ],
        "crm_sales_details": [
            ("SO1", "HL-1", 11, 20130105, 20130110, 20130115, 20, 2, 10),
            ("SO2", "PD-9", 12, 0, 20130210, 20130215, None, 3, -9),
            ("SO3", "XX-0", 99, 2013, 20130231, None, 7, 1, None),
        ],
        "erp_cust_az12": [("NASAW11", D(1980, 5, 5), "Female"), ("AW12", D(2090, 1, 1), " m ")],
        "erp_loc_a101": [("AW-11", "DE"), ("AW-12", " ")],
        "erp_px_cat_g1v2": [("AC_HE", "Accessories", "Helmets", "Yes"), ("CO_PD", "Components", "Pedals", "No")],
    }
    return lambda name: spark.createDataFrame(rows[name], SOURCES[name])


def test_run_builds_the_star_schema(spark, warehouse, source):
    audits = medallion.run(warehouse, source, as_of=D(2024, 1, 1))
    assert [(a.layer, a.status) for a in audits] == [("bronze", "ok")] * 6 + [("silver", "ok")] * 6 + [("gold", "ok")] * 3
    assert all(a.seconds >= 0 and a.message is None for a in audits)
    rows = {name: [tuple(r) for r in warehouse.read("gold", name).orderBy(schema.fieldNames()[0]).collect()] for name, schema in GOLD.items()}
    assert rows["dim_customers"] == [
        (1, 11, "AW11", "Anna", "Lee", "Germany", D(1980, 5, 5), "Female", "Married", D(2020, 2, 1)),
        (2, 12, "AW12", "Bob", "Ray", "n/a", None, "Male", "n/a", D(2020, 1, 5)),
    ]
    assert rows["dim_products"] == [
        (1, 2, "HL-1", "Helmet", "AC_HE", "Accessories", "Helmets", "Yes", 14, "Other Sales", D(2012, 7, 1)),
        (2, 3, "PD-9", "Pedal", "CO_PE", None, None, None, 9, "n/a", D(2013, 7, 1)),
    ]
    assert rows["fact_sales"] == [
        ("SO1", 1, 1, D(2013, 1, 5), D(2013, 1, 10), D(2013, 1, 15), 20, 2, 10.0),
        ("SO2", 2, 2, None, D(2013, 2, 10), D(2013, 2, 15), 27, 3, 9.0),
        ("SO3", None, None, None, None, None, 7, 1, 7.0),
    ]
    for name, schema in GOLD.items():
        found = warehouse.read("gold", name).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema]
    products = warehouse.read("silver", "crm_prd_info").orderBy("prd_id").select("prd_cost", "prd_end_dt").collect()
    assert [tuple(r) for r in products] == [(0, D(2012, 6, 30)), (14, None), (9, None)]


def test_layers_run_one_by_one_and_again(warehouse, source):
    for layer in ("bronze", "silver", "gold", "silver", "gold"):
        medallion.run(warehouse, source, ["cst_key"], layers=[layer])
    assert warehouse.read("gold", "fact_sales").count() == 3
    plain = sorted(warehouse.read("gold", "fact_sales").collect())
    medallion.run(warehouse, source, ["cst_key"], layers=["gold"], fact_partition_by=("order_date",), hot_share=0.3)
    assert sorted(warehouse.read("gold", "fact_sales").select(GOLD["fact_sales"].fieldNames()).collect()) == plain


def test_reports_become_gold_tables(warehouse, source):
    audits = medallion.run(warehouse, source, with_reports=True)
    rows = {a.table_name: a.row_count for a in audits if a.layer == "gold"}
    assert rows == {
        "dim_customers": 2, "dim_products": 2, "fact_sales": 3, "flat_sales": 3, "agg_sales_rollup": 5,
        "customer_segments": 3, "product_performance": 3, "sales_trend": 2, "seasonal_index": 1,
        "seasonal_forecast": 12,
    }
    flat = warehouse.read("gold", "flat_sales").where("order_number = 'SO1'").first()
    assert (flat.product_name, flat.country, flat.sales_amount) == ("Helmet", "Germany", 20)
    found = {(r.rule, r.column_name): r.failed_rows for r in warehouse_report(warehouse).collect()}
    assert found["not_null", "cst_id"] == 1 and found["unique", "cst_id"] == 1
    assert found["references", "sls_prd_key"] == 1 and found["references", "sls_cust_id"] == 1


def test_failed_load_skips_only_its_dependants(spark, warehouse, source):
    def broken(name):
        if name == "erp_loc_a101":
            raise RuntimeError("source is down")
        return source(name)

    with pytest.raises(LoadFailed) as caught:
        medallion.run(warehouse, broken, ["cst_key"])
    status = {f"{a.layer}.{a.table_name}": a.status for a in caught.value.audits}
    bad = {k: v for k, v in status.items() if v != "ok"}
    assert bad == {
        "bronze.erp_loc_a101": "failed", "silver.erp_loc_a101": "skipped", "gold.dim_customers": "skipped",
        "gold.fact_sales": "skipped",
    }
    assert status["gold.dim_products"] == "ok"
    table = audit_table(spark, caught.value.audits)
    assert table.count() == 15
    assert [f"{n} {t}" for n, t in table.dtypes] == AUDIT_SCHEMA.split(", ")


def test_save_counts_and_replaces(spark, warehouse):
    assert warehouse.save("silver", "t", spark.range(100)) == 100
    assert warehouse.read("silver", "t").count() == 100
    assert warehouse.save("silver", "t", spark.range(7)) == 7
    assert warehouse.read("silver", "t").count() == 7
    assert warehouse.save("silver", "t", spark.range(0)) == 0
    assert warehouse.read("silver", "t").count() == 0


def test_a_failed_write_keeps_the_old_rows(spark, warehouse):
    warehouse.save("silver", "t", spark.range(5))
    bad = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).alias("id"))
    audits = run_loads(warehouse, [[Load("silver", "t", lambda _: bad)]])
    assert audits[0].status == "failed" and "bad row" in audits[0].message
    assert warehouse.read("silver", "t").count() == 5


@pytest.mark.parametrize("step", ["register_parquet", "drop_other_versions"])
def test_a_crash_between_the_steps_of_a_load(spark, warehouse, monkeypatch, step):
    warehouse.save("bronze", "t", spark.range(3))
    with monkeypatch.context() as broken:
        broken.setattr(load, step, lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            warehouse.save("bronze", "t", spark.range(5))
    assert warehouse.read("bronze", "t").count() == (3 if step == "register_parquet" else 5)
    assert warehouse.save("bronze", "t", spark.range(4)) == 4
    assert warehouse.read("bronze", "t").count() == 4
    assert files.current_version(spark, warehouse.path("bronze", "t")) and len(os.listdir(warehouse.path("bronze", "t"))) == 1


def test_a_table_whose_folder_is_gone_is_read_from_the_files(spark, warehouse):
    warehouse.save("bronze", "t", spark.range(3))
    spark.sql(f"ALTER TABLE {warehouse.table('bronze', 't')} SET LOCATION '{warehouse.root}/nowhere'")
    assert warehouse.read("bronze", "t").count() == 3


def test_profit_and_places_with_unknown_values(spark):
    sales = "order_number string, product_key bigint, customer_key bigint, order_date date, sales_amount bigint, quantity bigint"
    rows = [("a", 1, 1, None, 100, 2), ("b", 1, 1, None, 50, None), ("c", 2, 1, None, 150, 1), ("d", None, None, None, 7, 1)]
    products = spark.createDataFrame([(1, "p", "x", 10), (2, "q", "x", 1)], "product_key bigint, product_number string, cat string, cost int")
    found = {r.product_key: r for r in marts.product_performance(spark.createDataFrame(rows, sales), products).collect()}
    assert (found[1].revenue, found[1].profit) == (150, 80)
    assert found[1].place == found[2].place == 1 and found[None].revenue == 7


def test_change_skips_no_month(spark):
    days = [dt.date(2020, 1, 5), dt.date(2020, 3, 5), dt.date(2020, 4, 5), None]
    fact = spark.createDataFrame([(d, 10 * (i + 1)) for i, d in enumerate(days)], "order_date date, sales_amount bigint")
    found = marts.sales_trend(fact).collect()
    assert [(r.sales, r.change, r.running_sales) for r in found] == [(10, None, 10), (20, None, 30), (30, 10, 60), (40, None, 100)]


def test_a_table_can_be_built_from_itself(spark, warehouse):
    warehouse.save("silver", "t", spark.range(5))
    warehouse.save("silver", "t", warehouse.read("silver", "t").where("id > 1"))
    assert warehouse.read("silver", "t").count() == 3


def test_new_columns_become_visible(spark, warehouse):
    warehouse.save("silver", "t", spark.range(3))
    warehouse.save("silver", "t", spark.range(3).withColumn("more", F.lit("x")))
    assert warehouse.read("silver", "t").columns == ["id", "more"]


def test_partitioned_table(spark, warehouse):
    day = F.when(F.col("id") % 3 != 0, F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") % 4).cast("int")))
    df = spark.range(200).select("id", day.alias("day"), F.lit("x").alias("t"))
    for _ in range(2):
        assert warehouse.save("gold", "t", df, ("day",)) == 200
    found = warehouse.read("gold", "t")
    assert {(r.id, r.day) for r in found.collect()} == {(r.id, r.day) for r in df.collect()}
    assert found.where("day IS NULL").count() == 67
    plan = found.where(F.col("day") == D(2020, 1, 2))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_folders_of_a_reload_are_those_of_the_new_version(spark, warehouse):
    """Also where a folder had a location of its own, as under a Hive catalog."""
    df = spark.range(20).select("id", (F.col("id") % 2).cast("int").alias("part"))
    warehouse.save("gold", "t", df, ("part",))
    table = warehouse.table("gold", "t")
    old = files.current_version(spark, warehouse.path("gold", "t"))
    spark.sql(f"ALTER TABLE {table} PARTITION (part = 1) SET LOCATION '{old}/part=1'")
    warehouse.save("gold", "t", df.withColumn("id", F.col("id") + 100), ("part",))
    new = files.current_version(spark, warehouse.path("gold", "t"))
    assert new != old
    for part in range(2):
        database = f"{warehouse.prefix}gold"
        shown = spark.sql(f"SHOW TABLE EXTENDED IN `{database}` LIKE 't' PARTITION (part = {part})").first()["information"]
        assert f"{new}/part={part}" in shown and old not in shown
    assert {r.id for r in spark.table(table).collect()} == set(range(100, 120))


def test_paths_and_names(spark):
    made = Warehouse(spark, "/data", "x_")
    assert made.path("bronze", "crm_cust_info") == "/data/bronze/bronze_crm_cust_info"
    assert made.table("bronze", "crm_cust_info") == "`x_bronze`.`crm_cust_info`"


def test_tables_and_fallback(spark, warehouse):
    warehouse.save("bronze", "a", spark.range(3))
    warehouse.save("bronze", "b", spark.range(4))
    files.overwrite_parquet(spark.range(5), warehouse.path("bronze", "c"))
    assert {r[0] for r in catalog.tables(spark, f"{warehouse.prefix}bronze").collect()} == {"a", "b"}
    assert [warehouse.read("bronze", n).count() for n in "abc"] == [3, 4, 5]


def test_files_are_found_by_a_session_without_the_catalog(spark, warehouse):
    warehouse.save("silver", "t", spark.range(6))
    assert Warehouse(spark, warehouse.root, "no_such_prefix_").read("silver", "t").count() == 6


def test_preview(spark):
    assert [r.id for r in catalog.preview(spark.range(50), ["id"], 3).collect()] == [0, 1, 2]


def test_csv(spark, tmp_path):
    path = tmp_path / "prd.csv"
    path.write_bytes(b"id,cat,subcat,maintenance\r\nZZ_01,Garden,Hose Reels,No\r\nX,,,No\r\n")
    found = files.read_csv(spark, str(path), SOURCES["erp_px_cat_g1v2"]).collect()
    assert [tuple(r) for r in found] == [("ZZ_01", "Garden", "Hose Reels", "No"), ("X", None, None, "No")]


def test_conform(spark):
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType())])
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, 5), "x")], "ID int, day timestamp, extra string")
    assert conform(df, declared).dtypes == [("id", "bigint"), ("day", "date"), ("extra", "string")]
    whole = df.withColumn("ID", F.lit(7).cast("decimal(18,0)"))
    assert [tuple(r) for r in conform(whole, declared).collect()] == [(7, dt.date(2020, 1, 1), "x")]
    for kind in ("decimal(19,0)", "decimal(10,2)", "double"):
        with pytest.raises(SchemaMismatch):
            conform(df.withColumn("ID", F.lit(7).cast(kind)), declared)
    with pytest.raises(SchemaMismatch, match="missing"):
        conform(df.drop("day"), declared)
    with pytest.raises(SchemaMismatch, match="string"):
        conform(df.withColumn("ID", F.lit("a")), declared)


def test_conform_takes_other_types_of_measures_and_dates(spark):
    df = spark.createDataFrame([("2011-12-29", "2011-12-30", "x", 1)], "sls_order_dt string, day string, bad string, n int").withColumns(
        {"sls_price": F.lit("1.25").cast("decimal(10,2)"), "due": F.lit("2012-01-02").cast("date")}
    )
    declared = T.StructType(
        [T.StructField(n, t) for n, t in (("sls_order_dt", T.IntegerType()), ("day", T.DateType()), ("bad", T.DateType()), ("due", T.IntegerType()), ("sls_price", T.LongType()))]
    )
    found = conform(df, declared)
    assert found.first()[:4] == (20111229, dt.date(2011, 12, 30), None, 20120102)
    assert dict(found.dtypes)["sls_price"] == "decimal(10,2)"


def test_duplicate_dimension_keys_multiply_rows(spark, source):
    customers = silver.silver_customers(source("crm_cust_info"), ["cst_key"])
    erp = silver.silver_erp_customers(source("erp_cust_az12"), D(2024, 1, 1))
    locations = silver.silver_locations(source("erp_loc_a101"))
    doubled = gold.dim_customers(customers, erp.union(erp), locations)
    assert sorted((r.customer_key, r.customer_id) for r in doubled.collect()) == [(1, 11), (2, 11), (3, 12), (4, 12)]
    with pytest.raises(DuplicateKeys):
        gold.dim_customers(customers, erp.union(erp), locations, unique_keys=True)
    assert gold.dim_customers(customers, erp, locations, unique_keys=True).count() == 2
    categories = silver.silver_categories(source("erp_px_cat_g1v2"))
    products = silver.silver_products(source("crm_prd_info"), ["prd_id"])
    assert gold.dim_products(products, categories, unique_keys=True).count() == 2
    with pytest.raises(DuplicateKeys):
        gold.dim_products(products, categories.union(categories), unique_keys=True)


def test_hot_share_gives_the_same_fact(spark, source):
    customers = silver.silver_customers(source("crm_cust_info"), ["cst_key"])
    sales = silver.silver_sales(source("crm_sales_details"))
    products = spark.createDataFrame([(1, "HL-1"), (2, "PD-9")], "product_key bigint, product_number string")
    customers = customers.select(F.col("cst_id").alias("customer_id"), F.lit(1).cast("bigint").alias("customer_key"))
    plain = gold.fact_sales(sales, products, customers)
    split = gold.fact_sales(sales, products, customers, hot_share=0.3)
    assert sorted(plain.collect()) == sorted(split.collect())


@pytest.mark.parametrize("bounds", [[], [10], [0, 3, 40], ["b", "d'x"]])
def test_range_predicates_meet_every_row_once(spark, bounds):
    values = ["a", "b", "c", "d'x", "e", None] if bounds and isinstance(bounds[0], str) else [-5, 0, 1, 3, 10, 39, 40, 41, None]
    kind = "string" if isinstance(values[0], str) else "int"
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    parts = [df.where(p.replace("''", "\\'")) for p in jdbc.range_predicates("c", bounds)]
    found = [r.c for part in parts for r in part.collect()]
    assert len(parts) == max(1, len(bounds) + 1)
    assert sorted(map(str, found)) == sorted(map(str, values))


class Recorder:
    """Stands in for a reader or writer and keeps what it is told; no database is involved."""

    def __init__(self, log, answers):
        self.log, self.answers, self.seen = log, answers, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def mode(self, name):
        self.seen["mode"] = name
        return self

    def options(self, **found):
        self.seen.update(found)
        return self

    def option(self, name, value):
        self.seen[name] = value
        return self

    def save(self):
        self.log.append(("save", dict(self.seen)))

    def load(self):
        self.log.append(("load", dict(self.seen)))
        return self.answers.pop(0) if "query" in self.seen else "rows"

    def jdbc(self, url, table, **found):
        self.log.append(("jdbc", {"url": url, "table": table, **found}))
        return "rows"


class FakeSession:
    def __init__(self, *answers):
        self.log, self.answers = [], list(answers)

    @property
    def read(self):
        return Recorder(self.log, self.answers)


class FakeFrame:
    def __init__(self, session):
        self.sparkSession = session

    @property
    def write(self):
        return Recorder(self.sparkSession.log, [])


CONNECTION = jdbc.Connection("jdbc:x", "some.Driver", "me", "secret")


def test_jdbc_read_in_parallel(spark):
    fake = FakeSession(spark.createDataFrame([(1, 90)], "lo int, hi int"))
    assert jdbc.read_table(fake, CONNECTION, "bronze.t", "id", 6) == "rows"
    (_, limits), (_, scan) = fake.log
    assert limits["query"] == "SELECT MIN(id) AS lo, MAX(id) AS hi FROM bronze.t"
    assert scan == {
        "format": "jdbc", "url": "jdbc:x", "driver": "some.Driver", "user": "me", "password": "secret",
        "fetchsize": 10_000, "dbtable": "bronze.t", "partitionColumn": "id", "lowerBound": "1", "upperBound": "90",
        "numPartitions": 6,
    }


def test_jdbc_read_of_an_empty_table_and_without_column(spark):
    fake = FakeSession(spark.createDataFrame([(None, None)], "lo int, hi int"))
    jdbc.read_table(fake, CONNECTION, "t", "id", 6)
    jdbc.read_table(fake, CONNECTION, "t")
    assert all("numPartitions" not in seen for _, seen in fake.log)


def test_jdbc_read_by_ranges():
    fake = FakeSession()
    jdbc.read_ranges(fake, CONNECTION, "t", "c", [5])
    assert fake.log[0][1]["predicates"] == ["c < 5 OR c IS NULL", "c >= 5"]
    assert fake.log[0][1]["properties"]["user"] == "me"


def test_jdbc_overwrite_is_counted(spark):
    def count(n):
        return spark.createDataFrame([(n,)], "n int")

    good = FakeSession(count(5))
    jdbc.overwrite_table(FakeFrame(good), CONNECTION, "gold.t", rows=5)
    assert [kind for kind, _ in good.log] == ["save", "load"]
    assert good.log[0][1]["truncate"] is True and good.log[0][1]["mode"] == "overwrite"
    second = FakeSession(count(6), count(5))
    jdbc.overwrite_table(FakeFrame(second), CONNECTION, "gold.t", rows=5)
    assert [kind for kind, _ in second.log] == ["save", "load"] * 2
    with pytest.raises(jdbc.IncompleteWrite):
        jdbc.overwrite_table(FakeFrame(FakeSession(count(6), count(6))), CONNECTION, "gold.t", rows=5)


def test_password_is_not_shown():
    assert "secret" not in repr(CONNECTION)


def test_export_step_counts_the_written_files(spark, warehouse, monkeypatch):
    sent = []
    monkeypatch.setattr(
        medallion, "overwrite_table", lambda df, connection, table, rows, partitions: sent.append((table, rows))
    )
    for name in GOLD:
        warehouse.save("gold", name, spark.range(4))
    audits = run_loads(warehouse, [medallion.export_loads(CONNECTION)])
    assert sorted(sent) == [("gold.dim_customers", 4), ("gold.dim_products", 4), ("gold.fact_sales", 4)]
    assert all(a.row_count == 4 and a.status == "ok" for a in audits)


def test_custom_load(spark, warehouse):
    audits = run_loads(warehouse, [[Load("gold", "n", lambda w: w.spark.range(3))]])
    assert audits[0].row_count == 3


def test_unique_keys_are_asked_for_by_the_run(spark, warehouse, source):
    def doubled(name):
        df = source(name)
        return df.union(df) if name == "erp_loc_a101" else df

    with pytest.raises(LoadFailed, match="cid is not unique"):
        medallion.run(warehouse, doubled, unique_keys=True)


@pytest.mark.parametrize("share", [0, -1, 1.5])
def test_hot_share_is_checked(spark, share):
    df = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(ValueError, match="hot_share"):
        lookup.left_lookup(df, df.withColumn("x", F.lit(1)), "k", "k", ["x"], ["k"], share)


def test_command_line():
    import run_layers

    given = run_layers.parse(["--root", "/data", "--layers", "silver", "--parallel-by", "a:b:4", "--as-of", "2024-01-31"])
    assert given.as_of == D(2024, 1, 31)
    assert (given.root, given.layers, given.parallel_by, given.export) == ("/data", ["silver"], ["a:b:4"], False)


def test_database_tables_read_by_one_task_warn(spark):
    fake = FakeSession(spark.createDataFrame([(1, 90)], "lo int, hi int"))
    read = medallion.jdbc_source(fake, CONNECTION, "src", {"crm_sales_details": ("sls_cust_id", 64)})
    with pytest.warns(UserWarning, match="src.crm_cust_info is read by one task"):
        read("crm_cust_info")
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        read("crm_sales_details")
    assert fake.log[-1][1]["numPartitions"] == 64
