"""SQL of the source, silver and gold tables, for comparison with another engine.

Each entry names the tables it reads; :func:`with_tables` puts the needed ones in front of a
query, in order.
"""

from __future__ import annotations

import re

DIRTY_DATE = """CASE WHEN {key} % 7 = 0 THEN 0 WHEN {key} % 11 = 0 THEN 2024013 WHEN {key} % 13 = 0 THEN 20241350
    ELSE CAST(year({date}) * 10000 + month({date}) * 100 + day({date}) AS INTEGER) END"""

PARSED_DATE = """CASE WHEN length(CAST({c} AS VARCHAR)) = 8
    THEN CAST(try_strptime(CAST({c} AS VARCHAR), '%Y%m%d') AS DATE) END"""

AMOUNT = """CASE WHEN {s} IS NULL OR {s} <= 0 OR {s} <> {q} * abs({p}) THEN {q} * abs({p}) ELSE {s} END"""

PRICE = """CASE WHEN {p} IS NULL OR {p} <= 0 THEN CAST({s} AS DOUBLE) / nullif(CAST({q} AS DOUBLE), 0)
    ELSE CAST({p} AS DOUBLE) END"""

PADDED = "repeat(' ', CAST({key} % 3 AS INTEGER)) || {text} || repeat(' ', CAST({key} % 3 AS INTEGER))"

CUSTOMER_NUMBER = "'AW' || lpad(CAST({key} AS VARCHAR), 12, '0')"
PRODUCT_NUMBER = "'P' || lpad(CAST({key} // 4 AS VARCHAR), 12, '0')"

_AMOUNT = AMOUNT.format(s="sls_sales", q="sls_quantity", p="sls_price")

TABLES = {
    "b_cust": f"""
        SELECT CASE WHEN o_orderkey % 17 <> 0 THEN c_custkey END AS cst_id,
            {CUSTOMER_NUMBER.format(key="c_custkey")} AS cst_key,
            {PADDED.format(key="o_orderkey", text="substr(c_name, 1, 8)")} AS cst_firstname,
            {PADDED.format(key="c_custkey", text="substr(c_name, 10)")} AS cst_lastname,
            CASE o_orderkey % 5 WHEN 0 THEN 's' WHEN 1 THEN ' M ' WHEN 2 THEN 'S' WHEN 3 THEN '' END
                AS cst_marital_status,
            CASE (o_orderkey + c_custkey) % 5 WHEN 0 THEN 'f' WHEN 1 THEN ' M ' WHEN 2 THEN 'F' WHEN 3 THEN '' END
                AS cst_gender,
            CAST(o_orderdate AS DATE) AS cst_create_date, o_orderkey AS cst_version
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "b_prd": f"""
        SELECT p_partkey AS prd_id,
            substr(p_type, 1, 2) || '-' || substr(p_type, 3, 2) || '-' || {PRODUCT_NUMBER.format(key="p_partkey")}
                AS prd_key,
            p_name AS prd_nm,
            CASE WHEN p_partkey % 5 <> 0 THEN CAST(floor(p_retailprice) AS BIGINT) END AS prd_cost,
            CASE p_partkey % 6 WHEN 0 THEN 'R ' WHEN 1 THEN 'm' WHEN 2 THEN ' T' WHEN 3 THEN 'S' WHEN 4 THEN '' END
                AS prd_line,
            CASE WHEN p_partkey % 41 > 1 THEN DATE '2011-07-01' + p_size * 30 END AS prd_start_dt
        FROM part""",
    "b_sales": f"""
        SELECT 'SO' || CAST(l_orderkey AS VARCHAR) AS sls_ord_num,
            CASE WHEN l_partkey % 17 = 0 THEN 'X' || CAST(l_partkey AS VARCHAR) WHEN l_partkey % 19 = 0 THEN NULL
                ELSE {PRODUCT_NUMBER.format(key="l_partkey")} END AS sls_prd_key,
            CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 29 = 0 THEN -o_custkey - 1 ELSE o_custkey END
                AS sls_cust_id,
            {DIRTY_DATE.format(key="l_orderkey", date="o_orderdate")} AS sls_order_dt,
            {DIRTY_DATE.format(key="l_partkey", date="l_shipdate")} AS sls_ship_dt,
            CASE WHEN l_suppkey % 9 <> 0 THEN
                CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) END
                AS sls_due_date,
            CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN -qty * unit WHEN l_partkey % 11 = 0 THEN 0
                WHEN l_partkey % 13 = 0 THEN qty * unit + 1 ELSE qty * unit END AS sls_sales,
            qty AS sls_quantity,
            CASE WHEN l_linenumber % 4 = 0 THEN NULL WHEN l_linenumber % 5 = 0 THEN -unit
                WHEN l_linenumber % 6 = 0 THEN 0 ELSE unit END AS sls_price
        FROM (SELECT *, CAST(floor(l_quantity) AS BIGINT) AS qty,
                CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS unit FROM lineitem) AS lines
        JOIN orders ON l_orderkey = o_orderkey""",
    "b_erp": f"""
        SELECT CASE WHEN c_custkey % 11 = 0 THEN 'NONE' || CAST(c_custkey AS VARCHAR)
                WHEN c_custkey % 2 = 0 THEN 'NAS' || {CUSTOMER_NUMBER.format(key="c_custkey")}
                ELSE {CUSTOMER_NUMBER.format(key="c_custkey")} END AS cid,
            DATE '1950-01-01' + CAST(c_custkey * 37 % 30000 AS INTEGER) AS bdate,
            CASE c_custkey % 6 WHEN 0 THEN 'Male' WHEN 1 THEN 'female' WHEN 2 THEN ' M ' WHEN 3 THEN 'F'
                WHEN 4 THEN '' END AS gen
        FROM customer""",
    "b_loc": """
        SELECT CASE WHEN c_custkey % 23 = 0 THEN 'ZZ-' ELSE 'AW-' END || lpad(CAST(c_custkey AS VARCHAR), 12, '0')
                AS cid,
            CASE n_nationkey % 7 WHEN 0 THEN 'DE' WHEN 1 THEN ' US' WHEN 2 THEN 'USA ' WHEN 3 THEN '  '
                WHEN 4 THEN NULL WHEN 5 THEN 'us' ELSE ' ' || n_name || ' ' END AS cntry
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "b_cat": """
        SELECT DISTINCT CASE WHEN p_type = 'PROMO' THEN 'PR_MO'
                ELSE substr(p_type, 1, 2) || '_' || substr(p_type, 3, 2) END AS id,
            'Group ' || substr(p_type, 1, 1) AS cat, lower(p_type) AS subcat,
            CASE WHEN length(p_type) > 5 THEN 'Yes' ELSE 'No' END AS maintenance
        FROM part""",
    "s_cust": """
        SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
            CASE upper(trim(cst_marital_status)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married' ELSE 'n/a' END
                AS cst_marital_status,
            CASE upper(trim(cst_gender)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'n/a' END AS cst_gender,
            cst_create_date
        FROM (SELECT *, row_number() OVER (PARTITION BY cst_id
                ORDER BY cst_create_date DESC NULLS LAST, cst_version DESC) AS place FROM b_cust) AS ranked
        WHERE place = 1 AND cst_id IS NOT NULL""",
    "s_prd": """
        SELECT prd_id, prd_key, prd_nm, prd_cost, prd_line, prd_start_dt,
            lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt NULLS FIRST, prd_id) - 1 AS prd_end_dt,
            cat_id
        FROM (SELECT prd_id, substr(prd_key, 7) AS prd_key, prd_nm, coalesce(prd_cost, 0) AS prd_cost,
                CASE upper(trim(prd_line)) WHEN 'R' THEN 'Road' WHEN 'M' THEN 'Mountain' WHEN 'T' THEN 'Touring'
                    WHEN 'S' THEN 'Other Sales' ELSE 'n/a' END AS prd_line,
                prd_start_dt, replace(substr(prd_key, 1, 5), '-', '_') AS cat_id FROM b_prd) AS split""",
    "s_sales": f"""
        SELECT sls_ord_num, sls_prd_key, sls_cust_id,
            {PARSED_DATE.format(c="sls_order_dt")} AS sls_order_dt,
            {PARSED_DATE.format(c="sls_ship_dt")} AS sls_ship_dt,
            {PARSED_DATE.format(c="sls_due_date")} AS sls_due_date,
            amount AS sls_sales, sls_quantity,
            {PRICE.format(s="amount", q="sls_quantity", p="sls_price")} AS sls_price
        FROM (SELECT *, {_AMOUNT} AS amount FROM b_sales) AS repaired""",
    "s_erp": """
        SELECT CASE WHEN starts_with(cid, 'NAS') THEN substr(cid, 4) ELSE cid END AS cid,
            CASE WHEN bdate > DATE '2020-01-01' THEN NULL ELSE bdate END AS bdate,
            CASE WHEN upper(trim(gen)) IN ('M', 'MALE') THEN 'Male'
                WHEN upper(trim(gen)) IN ('F', 'FEMALE') THEN 'Female' ELSE 'n/a' END AS gen
        FROM b_erp""",
    "s_loc": """
        SELECT replace(cid, '-', '') AS cid,
            CASE WHEN trim(cntry) = 'DE' THEN 'Germany' WHEN trim(cntry) IN ('US', 'USA') THEN 'United States'
                WHEN cntry IS NULL OR trim(cntry) = '' THEN 'n/a' ELSE trim(cntry) END AS cntry
        FROM b_loc""",
    "s_cat": "SELECT id, cat, subcat, maintenance FROM b_cat",
    "dim_customers": """
        SELECT row_number() OVER (ORDER BY cst_id) AS customer_key, cst_id AS customer_id,
            cst_key AS customer_number, cst_firstname AS first_name, cst_lastname AS last_name, cntry AS country,
            bdate AS birthdate,
            CASE WHEN cst_gender <> 'n/a' THEN cst_gender ELSE coalesce(gen, 'n/a') END AS gender,
            cst_marital_status AS marital_status, cst_create_date AS create_date
        FROM s_cust LEFT JOIN s_erp ON cst_key = s_erp.cid LEFT JOIN s_loc ON cst_key = s_loc.cid""",
    "dim_products": """
        SELECT row_number() OVER (ORDER BY prd_id, prd_start_dt NULLS FIRST) AS product_key, prd_id AS product_id,
            prd_key AS product_number, prd_nm AS product_name, cat_id AS category_id, cat, subcat, maintenance,
            prd_cost AS cost, prd_line AS product_line, prd_start_dt AS start_date
        FROM s_prd LEFT JOIN s_cat ON cat_id = id WHERE prd_end_dt IS NULL""",
    "fact_sales": """
        SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
            sls_ship_dt AS shipping_date, sls_due_date AS due_date, sls_sales AS sales_amount,
            sls_quantity AS quantity, sls_price AS price
        FROM s_sales LEFT JOIN dim_products ON sls_prd_key = product_number
            LEFT JOIN dim_customers ON sls_cust_id = customer_id""",
}


def with_tables(query: str) -> str:
    """``query`` behind a WITH list of the tables it uses, directly or through others."""
    used: set[str] = set()
    waiting = [query]
    while waiting:
        text = waiting.pop()
        for name in TABLES:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                waiting.append(TABLES[name])
    if not used:
        return query
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in TABLES.items() if name in used) + "\n" + query
