"""Queries of the column functions and of the per-key operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import codes
from terrace.functions.amounts import repair_amount, repair_price
from terrace.functions.dates import null_future, parse_yyyymmdd
from terrace.functions.text import (
    category_part,
    default_if_null,
    product_part,
    strip_prefix,
    strip_separators,
    trim_text,
)
from terrace.operators.history import close_versions, current_versions
from terrace.operators.keys import surrogate_key
from terrace.operators.latest import latest_by_key, top_n_per_key
from terrace.operators.project import renamed
from terrace.queries.inputs import choose, crm_sales_details, customer_number, dirty_date, padded, table
from terrace.queries.oracle import AMOUNT, CUSTOMER_NUMBER, DIRTY_DATE, PADDED, PARSED_DATE, PRICE, with_tables


def project_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "market_segment"}
    return renamed(table(spark, sf_dir, "customer"), names)


def query_trim_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return trim_text(
        customer.select("c_custkey", padded(F.col("c_name"), "c_custkey").alias("c_name")), "c_name"
    )


def decode_marital(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = choose(F.col("c_custkey"), "s", " M ", "S", "", None, "X")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", codes.decode(code, codes.MARITAL_STATUS).alias("marital_status")
    )


def decode_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = choose(F.col("c_custkey"), "f", " M ", "F", "", None, "Male")
    return table(spark, sf_dir, "customer").select("c_custkey", codes.decode(code, codes.GENDER).alias("gender"))


def standardize_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = choose(F.col("c_custkey"), "Male", "female", " M ", "f", "", None, "other")
    return table(spark, sf_dir, "customer").select("c_custkey", codes.decode(code, codes.GENDER_WORDS).alias("gender"))


def decode_product_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(F.lit(" "), F.lower(F.substring("p_type", 1, 1)), F.lit(" "))
    line = codes.decode(code, codes.PRODUCT_LINE)
    return table(spark, sf_dir, "part").select("p_partkey", line.alias("product_line"))


def standardize_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = choose(F.col("c_nationkey"), "DE", " US", "USA ", "", None, " France ", "us")
    return table(spark, sf_dir, "customer").select("c_custkey", codes.standardize_country(code).alias("country"))


def prefer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = choose(F.col("c_custkey"), "Male", "n/a", None)
    second = choose(F.col("c_custkey"), "Female", "Male", "n/a", None)
    return table(spark, sf_dir, "customer").select("c_custkey", codes.prefer(first, second).alias("gender"))


def split_product_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(
        F.upper(F.substring("p_type", 1, 2)), F.lit("-"), F.upper(F.substring("p_name", 1, 2)), F.lit("-"),
        F.col("p_partkey").cast("string"), F.lit("-"), F.col("p_size").cast("string"),
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", category_part(key).alias("cat_id"), product_part(key).alias("prd_key")
    )


def default_null_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = F.when(F.col("p_partkey") % 4 != 0, F.col("p_retailprice"))
    return table(spark, sf_dir, "part").select("p_partkey", default_if_null(cost, 0.0).alias("cost"))


def query_strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = customer_number("c_custkey")
    cid = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("NAS"), number)).when(F.col("c_custkey") % 3 == 0, number)
    return table(spark, sf_dir, "customer").select("c_custkey", strip_prefix(cid, "NAS").alias("cid"))


def query_strip_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    cid = F.concat(F.lit("AW-"), key, F.lit("-"), key)
    return table(spark, sf_dir, "customer").select("c_custkey", strip_separators(cid).alias("cid"))


def query_parse_yyyymmdd(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dirty_date("o_orderkey", "o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_yyyymmdd(raw).alias("order_date"))


def null_future_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = null_future(F.to_date("o_orderdate"), dt.date(1999, 1, 1))
    return table(spark, sf_dir, "orders").select("o_orderkey", date.alias("order_date"))


def repair_sales_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = crm_sales_details(spark, sf_dir)
    amount = repair_amount(F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price"))
    return lines.select("sls_ord_num", "sls_quantity", "sls_price", amount.alias("sls_sales"))


def repair_sales_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = crm_sales_details(spark, sf_dir)
    repaired = lines.withColumn(
        "sls_sales", repair_amount(F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price"))
    )
    price = repair_price(F.col("sls_price"), F.col("sls_quantity"), F.col("sls_sales"))
    return repaired.select("sls_ord_num", "sls_quantity", "sls_sales", price.alias("sls_price"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")))


_EVENTS = "(SELECT * REPLACE (CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id) FROM events) AS e"


def query_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_by_key(_events(spark, sf_dir), "user_id", "ts", [F.col("event_id").desc()])
    return newest.select("user_id", "event_id", "event_type", "value")


def query_top_n_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("value").desc(), F.col("event_id")]
    return top_n_per_key(_events(spark, sf_dir), "user_id", order, 3).select("user_id", "event_id", "value")


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    started = _events(spark, sf_dir).select("event_id", "user_id", "event_type", F.col("ts").alias("start_dt"))
    return close_versions(started, "user_id", "start_dt", "end_dt", ["event_id"])


def scd2_end_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir)


def query_current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_versions(_versions(spark, sf_dir), "end_dt").select("event_id", "user_id", "event_type", "start_dt")


_VERSIONS = f"""SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS start_dt,
    lead(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), event_id) - 1 AS end_dt
    FROM {_EVENTS}"""


def surrogate_key_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return surrogate_key(customer, ["c_custkey"], "customer_key", stored=True)


def surrogate_key_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name")
    return surrogate_key(part, ["p_size", "p_partkey"], "product_key", stored=True)


def _coded(table_name: str, key: str, code: str, then: str, name: str) -> str:
    return f"SELECT {key}, {then} AS {name} FROM (SELECT {key}, {code} AS code FROM {table_name}) AS coded"


def _cases(key: str, *values: str | None) -> str:
    whens = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values)
    )
    return f"CASE {key} % {len(values)} {whens} END"


_NUMBER = CUSTOMER_NUMBER.format(key="c_custkey")

QUERIES = {
    "project_subset": (project_subset, "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"),
    "project_rename": (
        project_rename,
        "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS market_segment FROM customer",
    ),
    "trim_text": (
        query_trim_text,
        f"SELECT c_custkey, trim({PADDED.format(key='c_custkey', text='c_name')}) AS c_name FROM customer",
    ),
    "decode_marital": (
        decode_marital,
        _coded(
            "customer", "c_custkey", _cases("c_custkey", "s", " M ", "S", "", None, "X"),
            "CASE upper(trim(code)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married' ELSE 'n/a' END", "marital_status",
        ),
    ),
    "decode_gender": (
        decode_gender,
        _coded(
            "customer", "c_custkey", _cases("c_custkey", "f", " M ", "F", "", None, "Male"),
            "CASE upper(trim(code)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'n/a' END", "gender",
        ),
    ),
    "standardize_gender": (
        standardize_gender,
        _coded(
            "customer", "c_custkey", _cases("c_custkey", "Male", "female", " M ", "f", "", None, "other"),
            "CASE WHEN upper(trim(code)) IN ('M', 'MALE') THEN 'Male' "
            "WHEN upper(trim(code)) IN ('F', 'FEMALE') THEN 'Female' ELSE 'n/a' END",
            "gender",
        ),
    ),
    "decode_product_line": (
        decode_product_line,
        _coded(
            "part", "p_partkey", "' ' || lower(substr(p_type, 1, 1)) || ' '",
            "CASE upper(trim(code)) WHEN 'R' THEN 'Road' WHEN 'M' THEN 'Mountain' WHEN 'T' THEN 'Touring' "
            "WHEN 'S' THEN 'Other Sales' ELSE 'n/a' END",
            "product_line",
        ),
    ),
    "standardize_country": (
        standardize_country,
        _coded(
            "customer", "c_custkey", _cases("c_nationkey", "DE", " US", "USA ", "", None, " France ", "us"),
            "CASE WHEN trim(code) = 'DE' THEN 'Germany' WHEN trim(code) IN ('US', 'USA') THEN 'United States' "
            "WHEN code IS NULL OR trim(code) = '' THEN 'n/a' ELSE trim(code) END",
            "country",
        ),
    ),
    "prefer_source": (
        prefer_source,
        f"""SELECT c_custkey, CASE WHEN a <> 'n/a' THEN a ELSE coalesce(b, 'n/a') END AS gender
        FROM (SELECT c_custkey, {_cases("c_custkey", "Male", "n/a", None)} AS a,
            {_cases("c_custkey", "Female", "Male", "n/a", None)} AS b FROM customer) AS coded""",
    ),
    "split_product_key": (
        split_product_key,
        """SELECT p_partkey, replace(substr(key, 1, 5), '-', '_') AS cat_id, substr(key, 7) AS prd_key
        FROM (SELECT p_partkey, upper(substr(p_type, 1, 2)) || '-' || upper(substr(p_name, 1, 2)) || '-'
            || CAST(p_partkey AS VARCHAR) || '-' || CAST(p_size AS VARCHAR) AS key FROM part) AS keyed""",
    ),
    "default_null_cost": (
        default_null_cost,
        """SELECT p_partkey, coalesce(CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END, 0.0) AS cost FROM part""",
    ),
    "strip_key_prefix": (
        query_strip_prefix,
        f"""SELECT c_custkey, CASE WHEN starts_with(code, 'NAS') THEN substr(code, 4) ELSE code END AS cid
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'NAS' || {_NUMBER}
            WHEN c_custkey % 3 = 0 THEN {_NUMBER} END AS code FROM customer) AS coded""",
    ),
    "strip_separators": (
        query_strip_separators,
        """SELECT c_custkey, replace('AW-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR), '-', '')
            AS cid FROM customer""",
    ),
    "parse_yyyymmdd": (
        query_parse_yyyymmdd,
        f"""SELECT o_orderkey, {PARSED_DATE.format(c="raw")} AS order_date
        FROM (SELECT o_orderkey, {DIRTY_DATE.format(key="o_orderkey", date="o_orderdate")} AS raw FROM orders) AS d""",
    ),
    "null_future_date": (
        null_future_date,
        """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) <= DATE '1999-01-01'
            THEN CAST(o_orderdate AS DATE) END AS order_date FROM orders""",
    ),
    "repair_sales_amount": (
        repair_sales_amount,
        with_tables(
            f"""SELECT sls_ord_num, sls_quantity, sls_price,
            {AMOUNT.format(s="sls_sales", q="sls_quantity", p="sls_price")} AS sls_sales FROM b_sales"""
        ),
    ),
    "repair_sales_price": (
        repair_sales_price,
        with_tables(
            f"""SELECT sls_ord_num, sls_quantity, amount AS sls_sales,
            {PRICE.format(s="amount", q="sls_quantity", p="sls_price")} AS sls_price
        FROM (SELECT *, {AMOUNT.format(s="sls_sales", q="sls_quantity", p="sls_price")} AS amount FROM b_sales) AS r"""
        ),
    ),
    "latest_by_key": (
        query_latest_by_key,
        f"""SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY ts DESC, event_id DESC) AS place FROM {_EVENTS}) AS ranked
        WHERE place = 1 AND user_id IS NOT NULL""",
    ),
    "top_n_per_key": (
        query_top_n_per_key,
        f"""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY value DESC, event_id) AS place FROM {_EVENTS}) AS ranked
        WHERE place <= 3 AND user_id IS NOT NULL""",
    ),
    "scd2_end_date": (scd2_end_date, _VERSIONS),
    "current_versions": (
        query_current_versions,
        f"SELECT event_id, user_id, event_type, start_dt FROM ({_VERSIONS}) AS v WHERE end_dt IS NULL",
    ),
    "surrogate_key_customers": (
        surrogate_key_customers,
        "SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey, c_name FROM customer",
    ),
    "surrogate_key_products": (
        surrogate_key_products,
        "SELECT row_number() OVER (ORDER BY p_size, p_partkey) AS product_key, p_partkey, p_size, p_name FROM part",
    ),
}
