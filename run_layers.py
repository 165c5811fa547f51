"""Load the warehouse from a database, for ``spark-submit run_layers.py ...``.

    spark-submit --jars <driver jar> run_layers.py --root <shared folder> \\
        --url jdbc:<...> --driver <class> --user <name> --password-file <file> \\
        --parallel-by crm_sales_details:sls_cust_id:64 --layers bronze silver gold --export
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from terrace.plans import medallion
from terrace.plans.checks import warehouse_report
from terrace.plans.load import LoadFailed, Warehouse, audit_table
from terrace.session import session
from terrace.sources.jdbc import Connection


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    parser.add_argument("--root", required=True, help="folder of the layers, on shared storage")
    parser.add_argument("--url", help="JDBC URL; needed for the bronze layer and for --export")
    parser.add_argument("--driver")
    parser.add_argument("--user")
    parser.add_argument("--password-file")
    parser.add_argument("--source-schema", default="bronze")
    parser.add_argument(
        "--parallel-by", nargs="*", default=[], metavar="TABLE:COLUMN:READS", help="tables to read in several parts"
    )
    layers = ["bronze", "silver", "gold"]
    parser.add_argument("--layers", nargs="+", default=layers, choices=layers)
    parser.add_argument("--newest-last", nargs="+", help="tie-break of customer records, descending")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="last valid birth date; by default today")
    parser.add_argument("--hot-share", type=float, help="salt fact keys that hold more than this share of the rows")
    parser.add_argument("--unique-keys", action="store_true", help="fail if a looked-up key occurs twice")
    parser.add_argument("--fact-by", nargs="*", default=[], metavar="COLUMN", help="columns that cut the fact into folders")
    parser.add_argument("--quality", action="store_true", help="print the quality report at the end")
    parser.add_argument("--reports", action="store_true", help="add the flat and the aggregated tables")
    parser.add_argument("--export", action="store_true", help="copy the gold tables to the database")
    parser.add_argument("--hive", action="store_true", help="register the tables in the Hive catalog")
    return parser.parse_args(arguments)


def main(arguments: list[str]) -> int:
    given = parse(arguments)
    spark = session("terrace-layers", hive=given.hive)
    password = None
    if given.password_file:
        with open(given.password_file) as file:
            password = file.read().strip()
    connection = Connection(given.url, given.driver, given.user, password) if given.url else None
    if connection is None and ("bronze" in given.layers or given.export):
        raise SystemExit("--url is needed for the bronze layer and for --export")
    parallel_by = {}
    for entry in given.parallel_by:
        table, column, reads = entry.split(":")
        parallel_by[table] = (column, int(reads))
    source = medallion.jdbc_source(spark, connection, given.source_schema, parallel_by)
    tie_break = [F.col(name).desc() for name in given.newest_last] if given.newest_last else None
    status = 0
    try:
        audits = medallion.run(
            Warehouse(spark, given.root),
            source,
            tie_break,
            as_of=given.as_of,
            export_to=connection if given.export else None,
            layers=given.layers,
            hot_share=given.hot_share,
            with_reports=given.reports,
            fact_partition_by=tuple(given.fact_by),
            unique_keys=given.unique_keys,
        )
        if given.quality:
            warehouse_report(Warehouse(spark, given.root)).show(100, truncate=False)
    except LoadFailed as failed:
        audits, status = failed.audits, 1
    audit_table(spark, audits).show(len(audits), truncate=False)
    spark.stop()
    return status


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
