"""Column profiles, fitted forecasts and the layout for two filters, against plain versions."""

import datetime as dt
import math
import random
from collections import Counter
from itertools import product

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from terrace.operators import profile
from terrace.operators.layout import clustered
from terrace.plans import smoothing

DAY = dt.date(2020, 1, 1)


def test_sketches_of_loads_merge(spark, tmp_path):
    r = random.Random(1)
    rows = [
        (r.choice([7, 7, r.randrange(8000)]), r.choice([None, "x", f"t{r.randrange(50)}"]), r.choice([None, r.gauss(5, 2)]), DAY + dt.timedelta(days=r.randrange(900)), None)
        for _ in range(20000)
    ]
    columns = ["n", "t", "x", "day", "none"]
    df = spark.createDataFrame(rows, "n int, t string, x double, day date, none int").withColumn("load", F.monotonically_increasing_id() % 3)
    for load in (*range(3), 99):  # the last one is empty
        profile.sketches(df.where(F.col("load") == load), columns, f"{load}").write.mode("append").parquet(str(tmp_path / "held"))
    found = {row.column_name: row for row in profile.profile(spark.read.parquet(str(tmp_path / "held")), (0.1, 0.5, 0.9)).collect()}
    assert sorted(found) == sorted(columns)
    for i, name in enumerate(columns):
        values = [row[i] for row in rows if row[i] is not None]
        row, counts = found[name], Counter(values)
        assert (row.n_rows, row.n_nulls) == (len(rows), len(rows) - len(values))
        assert abs(row.n_distinct - len(counts)) <= max(1, profile.DISTINCT_ERROR * len(counts))
        if name in ("t", "none"):
            assert row.quantiles is None
        else:
            plain = [(v - dt.date(1970, 1, 1)).days for v in values] if name == "day" else values
            for q, at in zip((0.1, 0.5, 0.9), row.quantiles):
                below, upto = (sum(v < at for v in plain), sum(v <= at for v in plain))
                assert below <= (q + profile.RANK_ERROR) * len(plain) and upto >= (q - profile.RANK_ERROR) * len(plain)
        listed = {item: n for item, n in row.frequent}
        assert None not in listed and len(listed) <= 10
        for item, n in listed.items():
            assert abs(n - Counter(map(str, values))[item]) <= profile.COUNT_ERROR * len(rows)
    assert max(found["n"].frequent, key=lambda x: x[1])[0] == "7" and found["none"].frequent == []


def test_smoothing(spark):
    """Against the recursion, month by month; a month without a row counts 0, and short series give no row."""
    r = random.Random(2)
    months = [dt.date(2018 + i // 12, i % 12 + 1, 1) for i in range(40)]
    series = {
        "season": [round(100 + i + 30 * math.sin(i * math.pi / 6) + r.gauss(0, 3)) for i in range(40)],
        "noise": [r.randrange(500) for _ in range(40)],
        None: [0 if i % 5 else r.randrange(90) for i in range(40)],
        "flat": [5] * 40,
    }
    rows = [(k, m, v) for k, values in series.items() for m, v in zip(months, values) if v]
    found = smoothing.smoothed_forecast(spark.createDataFrame(rows, "k string, month date, sales long"), ["k"], "month", "sales").collect()
    assert len(found) == 12 * len(series)

    def fit(values, a, b, g):
        level, trend = sum(values[:12]) / 12, (sum(values[12:24]) / 12 - sum(values[:12]) / 12) / 12
        season, errors = [v - level for v in values[:12]], 0.0
        for v in values[12:]:
            error = v - (level + trend + season[0])
            season = [*season[1:], season[0] + g * error]
            level, trend, errors = level + trend + a * error, trend + b * (a * error), errors + error * error
        return errors, (a, b, g), [level + (k + 1) * trend + season[k] for k in range(12)]

    for k, values in series.items():
        errors, shares, ahead = min(fit(values, *s) for s in product(smoothing.LEVELS, smoothing.TRENDS, smoothing.SEASONS))
        mine = sorted((row for row in found if row.k == k), key=lambda row: row.month)
        assert [row.month for row in mine] == [dt.date(2021 + (i + 4) // 12, (i + 4) % 12 + 1, 1) for i in range(12)]
        assert {(row.level_share, row.trend_share, row.season_share) for row in mine} == {shares}
        assert [row.forecast for row in mine] == pytest.approx(ahead)
    short = spark.createDataFrame([("a", m, 1) for m in months[:23]], "k string, month date, sales long")
    assert smoothing.smoothed_forecast(short, ["k"], "month", "sales").collect() == []
    assert smoothing.smoothed_forecast(short.limit(0), ["k"], "month", "sales").collect() == []


def read_share(folder, column, low, high):
    """Row groups that may hold a value between the bounds, of all."""
    spans = []
    for path in folder.glob("*.parquet"):
        held = pq.ParquetFile(path).metadata
        place = held.schema.names.index(column)
        spans += [held.row_group(i).column(place).statistics for i in range(held.num_row_groups)]
    return sum(s.min <= high and s.max >= low for s in spans) / len(spans), len(spans)


def test_either_filter_skips_row_groups(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, r.randrange(5000) if i % 3 else 11, DAY + dt.timedelta(days=int(r.random() ** 3 * 2000))) for i in range(30000)]
    df = spark.createDataFrame(rows, "id int, k int, day date")
    clustered(df, "k", "day", 64).write.parquet(str(tmp_path / "both"))
    df.repartition(64).write.parquet(str(tmp_path / "plain"))
    assert Counter(map(tuple, spark.read.parquet(str(tmp_path / "both")).collect())) == Counter(rows)
    for column, low, high in (("k", 4000, 4050), ("day", DAY + dt.timedelta(days=900), DAY + dt.timedelta(days=910))):
        share, groups = read_share(tmp_path / "both", column, low, high)
        assert groups >= 60 and share < 0.3 and read_share(tmp_path / "plain", column, low, high)[0] == 1
    # Also rows of one place, and of the same content, are shared by tasks; NULLs and empty tables are fine.
    same = spark.range(8000).select(F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, F.lit(2.5)).alias("x"), "id")
    sizes = clustered(same, "k", "x", 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(row["count"] for row in sizes) < 3000
    assert clustered(same.limit(0), "k", "x", 8).collect() == []
    assert clustered(same.withColumn("k", F.lit(None).cast("int")), "k", "x", 8).count() == 8000
