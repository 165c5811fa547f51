"""Per-key and whole-table operators against plain Python or plain windows."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.operators import keys
from terrace.operators.history import close_versions, current_versions
from terrace.operators.keys import rank_in_group, surrogate_key, with_position, with_row_id
from terrace.operators.latest import latest_by_key, top_n_per_key
from terrace.operators.lookup import DuplicateKeys, hot_keys, left_lookup, require_unique
from terrace.operators.quality import in_range, not_before, not_null, references, report, row_checks, unique
from terrace.staging import shared_dir, stage, staged_until_end

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(autouse=True)
def many_ranges(monkeypatch):
    """Several ranges in spite of few rows."""
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 100)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: a third has one key, a tenth has none."""
    pick = random.Random(7)
    rows = [
        (None if i % 10 == 0 else 1 if i % 3 == 0 else pick.randrange(2, 300), pick.randrange(60), i)
        for i in range(3000)
    ]
    return stage(spark.createDataFrame(rows, "k int, v int, id int").repartition(6), "skewed")


def test_latest_by_key(spark):
    d = dt.date
    rows = [(1, d(2020, 1, 1), 1), (1, d(2020, 2, 1), 2), (1, d(2020, 2, 1), 3), (2, None, 4), (None, d(2021, 1, 1), 5)]
    df = spark.createDataFrame(rows, "k int, day date, id int")
    found = latest_by_key(df, "k", "day", [F.col("id").desc()]).select("k", "id")
    assert bag(found) == Counter([(1, 3), (2, 4)])


def test_tie_break_is_required(spark, skewed):
    with pytest.raises(ValueError, match="tie-break"):
        latest_by_key(skewed, "k", "v", [])
    with pytest.raises(ValueError, match="tie_break"):
        close_versions(skewed, "k", "v", "e", [])


def test_latest_by_key_with_hot_key(skewed):
    best = {}
    for row in skewed.collect():
        if row.k is not None and (row.k not in best or (row.v, -row.id) > (best[row.k].v, -best[row.k].id)):
            best[row.k] = row
    found = latest_by_key(skewed, "k", "v", ["id"])
    assert bag(found) == Counter(tuple(r) for r in best.values())


@pytest.mark.parametrize("n", [1, 5, 1500])
def test_top_n(skewed, n):
    window = Window.partitionBy("k").orderBy(F.col("v").desc(), "id")
    plain = skewed.where("k is not null").withColumn("r", F.row_number().over(window)).where(F.col("r") <= n).drop("r")
    assert bag(top_n_per_key(skewed, "k", [F.col("v").desc(), F.col("id")], n)) == bag(plain)


@pytest.mark.parametrize("rows_per_range", [100, 1_000_000])
def test_position_equals_global_row_number(skewed, monkeypatch, rows_per_range):
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", rows_per_range)
    order = [F.col("k").desc(), F.col("v"), F.col("id")]
    plain = skewed.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert bag(with_position(skewed, order)) == bag(plain)
    assert bag(with_position(skewed, order, stored=True)) == bag(plain)


def test_position_of_copies(spark):
    df = spark.createDataFrame([(1, "a")] * 500 + [(None, "b")] * 300 + [(2, "c")], "k int, t string")
    found = surrogate_key(df.repartition(5), ["k"], "key").orderBy("key").collect()
    assert [r.key for r in found] == list(range(1, 802))
    assert [r.k for r in found] == [None] * 300 + [1] * 500 + [2]


@pytest.mark.parametrize("rows_per_range", [100, 1_000_000])
def test_keys_of_ties_do_not_change_between_reads(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", rows_per_range)
    df = spark.range(2000).select(F.lit(1).alias("k"), "id").repartition(7)
    keyed = surrogate_key(df, ["k"], "key")
    assert bag(keyed) == bag(keyed.repartition(3)) == bag(keyed.where("key > 0"))


def test_copies_are_spread_over_ranges(spark):
    """One row repeated: no range holds much more than its share."""
    df = spark.range(8000).select(F.lit(1).alias("k"))
    scan = with_row_id(stage(df, "copies"))
    sizes = scan.repartitionByRange(8, "k", "_row_id").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8
    assert max(r["count"] for r in sizes) < 2 * 1000


def test_position_of_no_rows(spark):
    assert surrogate_key(spark.createDataFrame([], "k int"), ["k"], "key").collect() == []


@QUICK
@given(st.lists(st.tuples(st.none() | st.integers(0, 5), st.none() | st.integers(0, 5)), min_size=1, max_size=60))
def test_surrogate_key_is_gap_free_and_ordered(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int")
    found = sorted((tuple(r) for r in surrogate_key(df, ["a", "b"], "key").collect()))
    assert [r[0] for r in found] == list(range(1, len(rows) + 1))
    in_order = sorted(rows, key=lambda r: tuple((v is not None, v or 0) for v in r))
    assert [r[1:] for r in found] == in_order


@pytest.mark.parametrize("rows_per_range", [100, 1_000_000])
def test_rank_in_group(skewed, monkeypatch, rows_per_range):
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", rows_per_range)
    plain = skewed.withColumn(
        "place", F.row_number().over(Window.partitionBy("k").orderBy(F.col("v").desc(), "id")).cast("bigint")
    )
    assert bag(rank_in_group(skewed, ["k"], [F.col("v").desc(), "id"], "place")) == bag(plain)
    assert bag(rank_in_group(skewed, ["k"], [F.col("v").desc(), "id"], "place", stored=True)) == bag(plain)


def versions_by_window(df):
    """The rule as one window over whole keys."""
    window = Window.partitionBy("k").orderBy("s", "id")
    return df.withColumn("e", F.date_sub(F.lead("s").over(window), 1))


def test_versions_with_hot_key(skewed):
    df = skewed.select("k", F.when(F.col("v") > 2, F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("v"))).alias("s"), "id")
    assert bag(close_versions(df, "k", "s", "e", ["id"])) == bag(versions_by_window(df))


def test_versions_replace_the_given_end_date(spark):
    d = dt.date
    rows = [("a", d(2020, 1, 1), d(1999, 1, 1), 1), ("a", d(2021, 1, 1), d(1999, 1, 1), 2), ("b", None, None, 3)]
    df = spark.createDataFrame(rows, "k string, s date, e date, id int")
    closed = close_versions(df, "k", "s", "e", ["id"])
    expected = {1: d(2020, 12, 31), 2: None, 3: None}
    assert {r.id: r.e for r in closed.collect()} == expected
    assert {r.id for r in current_versions(closed, "e").collect()} == {2, 3}


def test_versions_of_copies(spark):
    """Copies of one row are told apart by their place in the file."""
    d = dt.date
    rows = [("a", d(2020, 1, 1), 1)] * 4 + [("a", d(2020, 6, 1), 2)] * 3 + [(None, None, 3)] * 2
    df = with_row_id(stage(spark.createDataFrame(rows, "k string, s date, id int").coalesce(2), "versions"))
    closed = close_versions(df, "k", "s", "e", ["id", "_row_id"]).select("k", "s", "id", "e")
    assert bag(closed) == bag(versions_by_window(df.drop("_row_id")))


def test_row_ids_differ_between_folders_of_one_table(spark, tmp_path):
    path = str(tmp_path / "folders")
    rows = spark.range(90).select((F.col("id") % 3).alias("part"), F.lit(1).alias("v")).coalesce(1)
    rows.write.partitionBy("part").parquet(path)
    assert with_row_id(spark.read.parquet(path)).select("_row_id").distinct().count() == 90


@QUICK
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40)), min_size=1, max_size=40, unique=True))
def test_versions_neither_overlap_nor_leave_gaps(spark, rows):
    start = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(k, start + dt.timedelta(days=n), i) for i, (k, n) in enumerate(rows)], "k int, s date, id int")
    by_key = {}
    for row in close_versions(df, "k", "s", "e", ["id"]).collect():
        by_key.setdefault(row.k, []).append((row.s, row.e))
    for spans in by_key.values():
        spans.sort()
        assert spans[-1][1] is None
        assert all(end + dt.timedelta(days=1) == after for (_, end), (after, _) in zip(spans, spans[1:]))


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("options", [{}, {"spread_by": ["id"]}, {"spread_by": ["id"], "hot_share": 0.2}])
def test_left_lookup(spark, skewed, options, threshold):
    right = spark.createDataFrame([(1, "hot"), (1, "twice"), (2, "two"), (None, "never"), (9999, "unused")], "r int, t string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plain = skewed.join(right, skewed.k == right.r, "left").select("k", "v", "id", "t")
        assert bag(left_lookup(skewed, right, "k", "r", ["t"], **options)) == bag(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_left_lookup_does_not_depend_on_where_keys_are_counted(spark, skewed):
    right = spark.createDataFrame([(1, "hot"), (2, "two"), (3, "three")], "r int, t string")
    plain = skewed.join(right, skewed.k == right.r, "left").select("k", "v", "id", "t")
    for counted in (skewed.where("k = 2"), skewed.where("k = 1"), skewed.where("false")):
        assert bag(left_lookup(skewed, right, "k", "r", ["t"], ["id"], 0.2, counted)) == bag(plain)


def test_left_lookup_keeps_rows_of_unique_keys(spark, skewed):
    right = skewed.where("k is not null").select(F.col("k").alias("r")).distinct().withColumn("t", F.lit(1))
    assert left_lookup(skewed, right, "k", "r", ["t"], ["id"]).count() == skewed.count()


def test_keyless_rows_are_spread(spark):
    """Rows without a key do not meet in one shuffle partition."""
    left = spark.range(8000).select(F.lit(None).cast("int").alias("k"), "id")
    right = spark.createDataFrame([(1, "a")], "r int, t string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_lookup(left, right, "k", "r", ["t"], ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 8000 and max(sizes) < 4000


def skew_splits(df):
    """Number of joins that split a partition when the query ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Join(skew=true)")


@pytest.fixture
def small_skew_limits(spark):
    """Run-time skew handling as for large tables, at the size of the test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def test_dominating_key_is_split_in_lookups(spark, skewed, small_skew_limits):
    wide = skewed.withColumn("text", F.sha2(F.col("id").cast("string"), 512)).repartition(12)
    right = spark.range(300).select(F.col("id").cast("int").alias("r"), F.lit("x").alias("t"))
    once = left_lookup(wide, right, "k", "r", ["t"], ["id"])
    twice = left_lookup(once, right.withColumnRenamed("t", "u"), "k", "r", ["u"], ["id"])
    assert skew_splits(twice) == 2
    assert twice.count() == skewed.count()


@pytest.mark.parametrize("hash_join_limit", ["0", "64m"])
def test_dominating_version_start_is_split(spark, skewed, small_skew_limits, hash_join_limit):
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", hash_join_limit)
    df = skewed.select("k", F.lit(dt.date(2020, 1, 1)).alias("s"), "id").repartition(12)
    df = df.withColumn("text", F.sha2(F.col("id").cast("string"), 512))
    closed = close_versions(df, "k", "s", "e", ["id"])
    assert skew_splits(closed) == 1
    assert bag(closed) == bag(versions_by_window(df))


def test_staged_tables_end_with_their_block(spark, tmp_path):
    with staged_until_end(spark):
        with staged_until_end(spark):
            inner = stage(spark.range(3), "inner").inputFiles()[0]
        outer = stage(spark.range(3), "outer")
        assert outer.count() == 3
        outer = outer.inputFiles()[0]
        assert not os.path.exists(os.path.dirname(inner.removeprefix("file://")))
    assert not os.path.exists(os.path.dirname(outer.removeprefix("file://")))


def test_hot_keys(skewed):
    assert [r[0] for r in hot_keys(skewed, "k", 0.2).collect()] == [1]


def test_require_unique(spark):
    good = spark.createDataFrame([(1,), (2,), (None,), (None,)], "k int")
    assert require_unique(good, "k") is good
    with pytest.raises(DuplicateKeys):
        require_unique(good.union(good), "k")


def test_quality_report(spark):
    d = dt.date
    rows = [(1, 5, d(2020, 1, 1), d(2019, 1, 1)), (1, None, d(2020, 1, 1), None), (None, 50, None, None), (3, 7, None, None)]
    df = spark.createDataFrame(rows, "k int, v int, s date, e date")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    found = report(
        row_checks(df, "t", [not_null("k"), in_range("v", 1, 10), not_before("e", "s")]),
        unique(df, "t", "k"),
        references(df, "t", "k", parent, "p"),
    )
    assert [tuple(r) for r in found.collect()] == [
        ("not_null", "t", "k", 4, 1),
        ("in_range", "t", "v", 4, 1),
        ("not_before", "t", "e", 4, 1),
        ("unique", "t", "k", 4, 1),
        ("references", "t", "k", 4, 1),
    ]


def test_quality_report_on_no_rows(spark):
    df = spark.createDataFrame([], "k int")
    found = report(row_checks(df, "t", [not_null("k")]), unique(df, "t", "k"), references(df, "t", "k", df, "k"))
    assert [(r.checked_rows, r.failed_rows) for r in found.collect()] == [(0, 0)] * 3


class FakeSession:
    """Just the settings that decide on the shared folder."""

    def __init__(self, master, configured=None):
        self.conf = {"spark.checkpoint.dir": configured}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})


def test_shared_folder():
    assert shared_dir(FakeSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    local = shared_dir(FakeSession("local[2]"))
    assert os.path.isdir(local) and shared_dir(FakeSession("local[2]")) == local
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("yarn"))


def test_ties_do_not_depend_on_the_files(spark, tmp_path):
    rows = [(i % 3, f"name {i}", i // 2 % 2) for i in range(60)]
    made = []
    for number, parts in enumerate((1, 7)):
        path = str(tmp_path / str(number))
        given = rows if number else rows[::-1]
        spark.createDataFrame(given, "k int, name string, start int").repartition(parts).write.parquet(path)
        df = spark.read.parquet(path)
        numbered = {(r.name, r.key) for r in surrogate_key(df, ["k"], "key").collect()}
        dated = df.withColumn("start_dt", F.date_add(F.lit("2020-01-01").cast("date"), "start")).withColumn("end_dt", F.lit(None).cast("date"))
        closed = close_versions(dated.withColumn("content", keys.content_hash(dated)), "k", "start_dt", "end_dt", ["start", "content"])
        made.append((numbered, {(r.name, r.end_dt) for r in closed.collect()}))
    assert made[0] == made[1]


def test_version_ends_with_unknown_tie_breaks(spark):
    rows = [(1, None, 1), (1, None, 2), (1, 5, 3), (2, None, 4), (2, None, 5)]
    df = spark.createDataFrame(rows, "k int, t int, u int").withColumns(
        {"s": F.lit("2020-01-01").cast("date"), "e": F.lit(None).cast("date")}
    )
    still_open = close_versions(df, "k", "s", "e", ["t", "u"]).where("e is null")
    assert {r.u for r in still_open.collect()} == {3, 5}
