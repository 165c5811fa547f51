"""Queries over time: versions of a day, overlaps, sessions, windows on a stream, changes of tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.props import parsed_json
from terrace.operators.asof import as_of_lookup
from terrace.operators.intervals import overlapping
from terrace.operators.reconcile import differences
from terrace.operators.sessions import sessions
from terrace.plans.versions import History
from terrace.queries import layers
from terrace.queries.inputs import table
from terrace.queries.oracle import with_tables
from terrace.staging import scratch_path, stage
from terrace.streaming import dedup, windows


def fact_sales_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned order lines with the product version of their order day, and its cost, instead of the current one."""
    # Written first, as silver tables are: a filter on the order day would otherwise clean the lines once more.
    sales, products = stage(layers.silver_sales(spark, sf_dir), "sales"), layers.silver_products(spark, sf_dir)
    columns = ["prd_id", "prd_cost", "prd_start_dt"]
    found = as_of_lookup(sales, products, "sls_prd_key", "sls_order_dt", "prd_key", "prd_start_dt", columns, ["prd_id"])
    return found.select("sls_ord_num", "sls_prd_key", "sls_order_dt", "sls_sales", "sls_quantity", *columns)


def _promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods in which parts are promoted; a third of the parts are of one group, and a few periods span everything."""
    key = F.col("p_partkey")
    start = F.date_add(F.lit(dt.date(2011, 7, 1)), F.col("p_size") * 30 + (key % 30).cast("int"))
    spans = key % 500 == 3
    return table(spark, sf_dir, "part").select(
        F.when(key % 3 == 0, 0).otherwise(F.expr("p_partkey div 4")).cast("bigint").alias("grp"),
        key.alias("promotion"),
        F.when(spans, F.lit(dt.date(2000, 1, 1))).otherwise(start).alias("first_day"),
        F.when(spans, None).otherwise(F.date_add(start, (key % 9).cast("int") - 1)).alias("last_day"),
    )


def version_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of promotions of one group that have a day in common."""
    held = _promotions(spark, sf_dir)
    met = overlapping(held, held, "grp", "first_day", "last_day").where("left.promotion < right.promotion")
    since = F.greatest("left.first_day", "right.first_day")
    return met.select("left.grp", F.col("left.promotion").alias("promotion"), F.col("right.promotion").alias("other"), since.alias("since"))


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions without a break of more than three days; a third of the events are of one user."""
    events = table(spark, sf_dir, "events").withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    return sessions(events, "user_id", "ts", "72 HOURS", [total])


def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy that lost, doubled and changed some."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    key = F.col("o_orderkey")
    copied = orders.where(key % 97 != 0).withColumn("o_totalprice", F.when(key % 83 == 0, None).otherwise(F.col("o_totalprice")))
    return differences(orders, copied.unionAll(copied.where(key % 89 == 0)))


def scd2_merge_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product versions loaded without a tenth of them, some with a wrong cost; a delta brings both in."""
    versions = layers.silver_products(spark, sf_dir)
    late, wrong = F.col("prd_id") % 10 == 0, F.col("prd_id") % 50 == 7
    history = History(spark, scratch_path(spark, "history"), versions.schema, "prd_key", "prd_start_dt", "prd_end_dt", ["prd_id"])
    history.load(versions.where(~late).withColumn("prd_cost", F.when(wrong, -1).otherwise(F.col("prd_cost"))))
    history.merge(versions.where(late | wrong))
    return history.read()


def _odd_props() -> Column:
    key = F.col("event_id")
    cut = F.expr("substring(props, 1, length(props) - 1)")
    return F.when(key % 50 == 0, cut).when(key % 50 == 1, None).when(key % 50 == 2, "{}").when(key % 50 == 3, '{"k": "many"}').otherwise(F.col("props"))


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in the properties of each event, or why there is none."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", parsed_json(_odd_props(), "k bigint", ("k",)).alias("props"))
    return events.select("event_id", "event_type", F.when(F.col("props.reason").isNull(), F.col("props.value.k")).alias("k"), F.col("props.reason").alias("reason"))


def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day and kind, from a stream of files that is read to its end: closed windows and open ones."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")  # a pattern may stand for a single file
    sink, checkpoint = scratch_path(spark, "windows"), scratch_path(spark, "stream")
    windows.count_windows(events, "ts", ["event_type"], "value", "1 day", "2 hours", sink, checkpoint)
    found = windows.windows(spark, [T.StructField("event_type", T.StringType())], sink, checkpoint)
    return found.select("window_start", "event_type", "n_events", F.col("total").cast("double").alias("total"))


def stream_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come in by parts of a month, some of them twice, some of them a part later; the first of each, and how many others came."""
    source, sink, checkpoint, audit = (scratch_path(spark, x) for x in ("arrivals", "firsts", "stream", "audit"))
    events = table(spark, sf_dir, "events")
    at, part = F.col("event_id"), F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)).cast("int")
    times = F.concat(
        F.when(at % 13 != 0, F.array(part)).otherwise(F.array().cast("array<int>")),
        F.when((at % 7 == 0) & (at % 13 != 0), F.array(part)).otherwise(F.array().cast("array<int>")),
        F.when((at % 11 == 0) | (at % 13 == 0), F.array(part + 1)).otherwise(F.array().cast("array<int>")),
    )
    arrivals = stage(events.select("*", F.explode(times).alias("arrival")), "arrivals")
    for arrival in range(4):
        arrivals.where(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        dedup.keep_first(stream, "ts", ["event_id"], "5 days", sink, checkpoint, audit)
    counted = dedup.audits(spark, audit).agg(F.sum("late_rows").alias("late"), F.sum("repeated_rows").alias("repeated"))
    others = counted.select(F.expr("stack(2, 'late', late, 'repeated', repeated) AS (status, n)"))
    kept = dedup.kept(spark, events, sink).select(F.lit("kept").alias("status"), "event_id", "ts", F.lit(1).cast("bigint").alias("n"))
    return kept.unionByName(others.select("status", "n"), allowMissingColumns=True)


_PROMOTIONS = """
    SELECT CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey // 4 END AS grp, p_partkey AS promotion,
        CASE WHEN p_partkey % 500 = 3 THEN DATE '2000-01-01' ELSE DATE '2011-07-01' + CAST(p_size * 30 + p_partkey % 30 AS INTEGER) END AS first_day,
        CASE WHEN p_partkey % 500 = 3 THEN DATE '9999-01-01'
            ELSE DATE '2011-07-01' + CAST(p_size * 30 + p_partkey % 30 + p_partkey % 9 - 1 AS INTEGER) END AS last_day
    FROM part"""

QUERIES = {
    "fact_sales_as_of": (
        fact_sales_as_of,
        with_tables(
            """SELECT sls_ord_num, sls_prd_key, sls_order_dt, sls_sales, sls_quantity, prd_id, prd_cost, prd_start_dt
        FROM s_sales ASOF LEFT JOIN (
            SELECT * FROM s_prd WHERE prd_start_dt IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY prd_key, prd_start_dt ORDER BY prd_id DESC) = 1) AS starts
        ON sls_prd_key = prd_key AND sls_order_dt >= prd_start_dt"""
        ),
    ),
    "version_overlaps": (
        version_overlaps,
        f"""WITH held AS ({_PROMOTIONS})
        SELECT a.grp, a.promotion, b.promotion AS other, greatest(a.first_day, b.first_day) AS since
        FROM held a JOIN held b ON a.grp = b.grp AND a.promotion < b.promotion AND a.first_day <= b.last_day AND b.first_day <= a.last_day
            AND a.first_day <= a.last_day AND b.first_day <= b.last_day""",
    ),
    "event_sessions": (
        event_sessions,
        """WITH given AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM events),
        begun AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 72 HOURS THEN 0 ELSE 1 END AS begins FROM given
            WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        numbered AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM begun)
        SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
            CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM numbered GROUP BY user_id, session""",
    ),
    "load_reconciliation": (
        load_reconciliation,
        """WITH before AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders),
        copied AS (SELECT * REPLACE (CASE WHEN o_orderkey % 83 <> 0 THEN o_totalprice END AS o_totalprice) FROM before WHERE o_orderkey % 97 <> 0),
        both_sides AS (SELECT *, 1 AS b, 0 AS a FROM before UNION ALL SELECT *, 0, 1 FROM copied
            UNION ALL SELECT *, 0, 1 FROM copied WHERE o_orderkey % 89 = 0)
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, CAST(sum(b) AS BIGINT) AS before_rows, CAST(sum(a) AS BIGINT) AS after_rows,
            CASE WHEN sum(a) = 0 THEN 'lost' WHEN sum(b) = 0 THEN 'added' WHEN sum(a) > sum(b) THEN 'more' ELSE 'fewer' END AS status
        FROM both_sides GROUP BY ALL HAVING sum(a) <> sum(b)""",
    ),
    "scd2_merge_delta": (scd2_merge_delta, with_tables("SELECT * FROM s_prd")),
    "event_props": (
        event_props,
        """SELECT event_id, event_type, CASE WHEN event_id % 50 > 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
            CASE event_id % 50 WHEN 0 THEN 'not readable' WHEN 1 THEN 'no text' WHEN 2 THEN 'lacks k' WHEN 3 THEN 'not readable' END AS reason
        FROM events""",
    ),
    "stream_window_counts": (
        stream_window_counts,
        """SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n_events,
            CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY ALL""",
    ),
    "stream_dedup_events": (
        stream_dedup_events,
        """WITH parted AS (SELECT event_id, ts, least((day(ts) - 1) // 10, 2) AS part FROM events),
        came AS (SELECT *, part AS arrival FROM parted WHERE event_id % 13 <> 0
            UNION ALL SELECT *, part FROM parted WHERE event_id % 13 <> 0 AND event_id % 7 = 0
            UNION ALL SELECT *, part + 1 FROM parted WHERE event_id % 11 = 0 OR event_id % 13 = 0),
        bounds AS (SELECT arrival, date_trunc('milliseconds', max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
            - INTERVAL 5 DAY AS bound FROM came GROUP BY arrival),
        judged AS (SELECT event_id, ts, coalesce(ts <= bound, FALSE) AS late, row_number() OVER (PARTITION BY event_id, coalesce(ts <= bound, FALSE)) AS nth
            FROM came JOIN bounds USING (arrival))
        SELECT 'kept' AS status, event_id, ts, CAST(1 AS BIGINT) AS n FROM judged WHERE NOT late AND nth = 1
        UNION ALL SELECT 'late', NULL, NULL, count(*) FROM judged WHERE late
        UNION ALL SELECT 'repeated', NULL, NULL, count(*) FROM judged WHERE NOT late AND nth > 1""",
    ),
}
