"""Versions of a day, overlaps, sessions, streams, merged and reconciled tables, against plain versions."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.props import parsed_json
from terrace.operators import intervals, keys
from terrace.operators.asof import as_of_lookup
from terrace.operators.intervals import overlapping
from terrace.operators.ordered import in_ranges, with_earlier, with_running_sum
from terrace.operators.reconcile import differences, differing_buckets
from terrace.operators.sessions import sessions
from terrace.plans import silver
from terrace.plans.versions import History
from terrace.sources.schemas import SOURCES, conform
from terrace.streaming import dedup, windows

DAY = dt.date(2020, 1, 1)


@pytest.fixture(autouse=True)
def many_ranges(monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 40)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def test_earlier_rows_across_ranges(spark):
    r = random.Random(1)
    rows = [(i, r.choice([None, None, i]), r.randrange(5)) for i in range(500)]
    placed = in_ranges(spark.createDataFrame(rows, "at_ int, held int, n long").repartition(7), ["at_"])
    assert placed.select("_range").distinct().count() > 5
    found = with_running_sum(with_earlier(placed, F.col("held"), "earlier"), "n", "total").orderBy("at_").collect()
    last, total = None, 0
    for (at, held, n), row in zip(rows, found):
        total += n
        assert (row.at_, row.earlier, row.total) == (at, last, total)
        last = held if held is not None else last


def test_as_of(spark):
    r = random.Random(2)
    keys_ = ["hot"] * 5 + ["a", "b", "c", None]
    versions = [(r.choice(keys_), day(r.choice([None, *range(0, 300, 3)])), i, f"v{i}") for i in range(200)]
    events = [(i, r.choice([*keys_, "unknown"]), day(r.choice([None, *range(-20, 330)]))) for i in range(600)]
    left = spark.createDataFrame(events + events[:9], "id int, k string, at date").withColumn("_version", F.lit(1))
    right = spark.createDataFrame(versions, "key string, since date, no int, name string")
    found = as_of_lookup(left, right, "k", "at", "key", "since", ["name", "no"], ["no"])
    assert found.columns == ["id", "k", "at", "_version", "name", "no"]

    def valid(key, at):
        able = [(since, no, name) for k, since, no, name in versions if None not in (k, since, at) and k == key and since <= at]
        return max(able)[2] if able else None

    assert Counter((x.id, x.name) for x in found.collect()) == Counter((i, valid(k, at)) for i, k, at in events + events[:9])
    # No window or join by the key itself: a hot key is shared.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "hashpartitioning(_key" not in plan and "hashpartitioning(_range" in plan
    assert as_of_lookup(left.limit(0), right, "k", "at", "key", "since", ["name"], ["no"]).collect() == []
    assert {x.name for x in as_of_lookup(left, right.limit(0), "k", "at", "key", "since", ["name"], ["no"]).collect()} == {None}
    with pytest.raises(ValueError):
        as_of_lookup(left, right.withColumn("since", F.col("since").cast("timestamp")), "k", "at", "key", "since", ["name"], ["no"])


def test_overlaps(spark):
    r = random.Random(3)
    rows = []
    for i in range(300):
        start = r.choice([None, *range(400)]) if i % 20 == 0 else r.randrange(400)
        length = r.choice([-3, 0, 0, 1, 2, 3, 7, 8, 40, 3000, None])
        rows.append((i, r.choice([1, 1, 1, 2, 3, None]), day(start), day(start + length) if start is not None and length is not None else None))
    df = spark.createDataFrame(rows + rows[:5], "id int, k int, a date, b date")
    half = df.where("id % 2 = 0")

    def pairs(left, right):
        held = lambda x: x[1] is not None and x[2] is not None and (x[3] is None or x[2] <= x[3])
        end = lambda x: x[3] or dt.date.max
        return Counter((x[0], y[0]) for x in left for y in right if held(x) and held(y) and x[1] == y[1] and x[2] <= end(y) and y[2] <= end(x))

    given = rows + rows[:5]
    found = overlapping(half, df, "k", "a", "b").select(F.col("left.id").alias("x"), F.col("right.id").alias("y")).collect()
    want = pairs([x for x in given if x[0] % 2 == 0], given)
    assert Counter(map(tuple, found)) == want and len(want) > 1000
    assert overlapping(df.limit(0), df, "k", "a", "b").collect() == []


def tries(found):
    """Rows that meet by the keys of the join, before any other condition."""
    plan = found._jdf.queryExecution().analyzed()
    while plan.nodeName() != "Join":
        plan = plan.children().apply(0)
    spark = found.sparkSession
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark).count()


def test_overlaps_are_not_tried_in_vain(spark, monkeypatch):
    """Short periods of hot keys, far from each other beside some that span everything, or in weeks, and keys of few rows."""
    rows = [(i, 1, day(10 * i), day(10 * i + i % 3)) for i in range(6000)] + [(6000 + i, 1, day(0), None) for i in range(4)]
    weeks = [(7000 + i, 2, day(7 * (i % 2000) + 3 * (i % 2)), day(7 * (i % 2000) + 3 * (i % 2) + 2 + i % 2)) for i in range(6000)]
    df = spark.createDataFrame(rows + weeks + [(13_000 + i, i % 100, day(i), day(i)) for i in range(5000)], "id int, k int, a date, b date")
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 10_000)
    monkeypatch.setattr(intervals, "FEW_TRIES", 0, raising=False)
    for left, right in ((df, df), (df.where("id % 2 = 0"), df.where("id % 2 = 1"))):
        found = overlapping(left, right, "k", "a", "b")
        # Keys of few rows are tried as a whole, here 50 rows each.
        assert 10_000 < tries(found) < 2 * found.count() + 50 * 5000


@pytest.mark.parametrize(("most_broadcast", "tries_per_row"), [(0, 4), (50_000, 0), (50_000, 100)])
def test_crowded_overlaps_are_shared(spark, monkeypatch, most_broadcast, tries_per_row):
    """Copies of one row, days before 1970 and far off, keys of other types; either side may be empty or beside the other one."""
    monkeypatch.setattr(intervals, "ROWS_PER_BLOCK", 32)
    monkeypatch.setattr(intervals, "TRIES_PER_ROW", tries_per_row)
    monkeypatch.setattr(intervals, "FEW_TRIES", 0)
    monkeypatch.setattr(keys, "MOST_BROADCAST", most_broadcast)
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 10_000)
    r, starts = random.Random(9), [None, dt.date.min, dt.date(1969, 12, 31), dt.date(1970, 1, 1), *map(day, range(60))]
    rows = [(i, r.choice([1, 1, 2, None]), r.choice(starts), r.choice([*starts, dt.date.max])) for i in range(250)]
    rows += [(900, 1, day(5), day(5))] * 150 + [(901, 1, day(4), day(6))] * 40
    schema = "id int, k int, a date, b date"
    df = spark.createDataFrame(rows, schema)
    other = df.select(F.col("k").cast("bigint").alias("k"), "b", "a", "id").where("id % 3 > 0")

    def pairs(left, right):
        held = lambda x: None not in x[1:3] and (x[3] is None or x[2] <= x[3])
        end = lambda x: x[3] or dt.date.max
        return Counter((x[0], y[0]) for x in left for y in right if held(x) and held(y) and x[1] == y[1] and x[2] <= end(y) and y[2] <= end(x))

    for left, right in ((df, df), (df, other), (other, df.where("true"))):
        found = overlapping(left, right, "k", "a", "b").select(F.col("left.id").alias("x"), F.col("right.id").alias("y"), F.spark_partition_id().alias("task")).collect()
        given = [[x for x in rows if side is not other or x[0] % 3 > 0] for side in (left, right)]
        assert Counter((x.x, x.y) for x in found) == pairs(*given)
        # The hot day has most pairs, and no task has it alone.
        assert right is not df or max(Counter(x.task for x in found).values()) < len(found) / 3
    for left, right in ((df, df.limit(0)), (df.limit(0), df), (df.where("a < '1969-01-01'"), df.where("a >= '2020-02-20' AND a < '2021-01-01'"))):
        found = overlapping(left, right, "k", "a", "b")
        assert found.columns == ["left", "right"]
        assert Counter((x.left.id, x.right.id) for x in found.collect()) == pairs([tuple(x) for x in left.collect()], [tuple(x) for x in right.collect()])


def test_sessions(spark):
    r = random.Random(4)
    start = dt.datetime(2020, 1, 1)
    rows = [(r.choice([0, 0, 0, 1, 2, None]), start + dt.timedelta(minutes=r.randrange(9000)) if i % 50 else None, i) for i in range(900)]
    rows += [(0, start, 7)] * 100  # copies of one row spread over ranges too
    found = sessions(spark.createDataFrame(rows, "u int, at timestamp_ntz, n long"), "u", "at", "30 MINUTES", [F.sum("n").alias("total")])
    want, by_user = Counter(), defaultdict(list)
    for user, at, n in rows:
        if at:
            by_user[user].append((at, n))
    for user, held in by_user.items():
        held.sort()
        parts = [[held[0]]]
        for a, b in zip(held, held[1:]):
            if b[0] - a[0] > dt.timedelta(minutes=30):
                parts.append([])
            parts[-1].append(b)
        want.update((user, p[0][0], p[-1][0], len(p), sum(n for _, n in p)) for p in parts)
    assert Counter((x.u, x.session_start, x.session_end, x.n_events, x.total) for x in found.collect()) == want


def test_differences(spark):
    r = random.Random(5)
    rows = [(r.randrange(50), r.choice(["x", None]), r.choice([0.5, None])) for _ in range(400)]
    after = rows[7:] + rows[20:25] + [(99, "new", None)]
    a, b = (spark.createDataFrame(x, "a int, b string, c double") for x in (rows, after))
    want = {k: (Counter(rows)[k], Counter(after)[k]) for k in {*rows, *after} if Counter(rows)[k] != Counter(after)[k]}
    found = differences(a, b.select("c", "b", "a"), buckets=16).collect()
    assert {(x.a, x.b, x.c): (x.before_rows, x.after_rows) for x in found} == want
    for x in found:
        assert x.status == ("lost" if not x.after_rows else "added" if not x.before_rows else "more" if x.after_rows > x.before_rows else "fewer")
    same = differences(a, b.union(a).exceptAll(b))
    assert differing_buckets(a, a.orderBy("b")) == [] and same.collect() == []
    # Of equal tables no row is read for a second time, let alone shuffled.
    assert "LocalTableScan <empty>" in same._jdf.queryExecution().executedPlan().toString()
    assert [x.status for x in differences(a.limit(0), a.limit(1)).collect()] == ["added"]
    with pytest.raises(ValueError):
        differences(a, a.drop("a"))


def test_merged_history(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("a", T.DateType()), T.StructField("b", T.DateType()), T.StructField("no", T.IntegerType()), T.StructField("x", T.StringType())])
    r = random.Random(6)
    rows = [(r.randrange(40), day(r.choice([None, *range(90)])), None, i, f"x{i}") for i in range(300)]
    late = [x for x in rows if x[0] == 3 and x[3] % 2] + [(77, day(5), None, 900, "new key")]
    early = [x[:4] + ("wrong",) if x in rows[:1] else x for x in rows if x not in late]
    history = History(spark, str(tmp_path / "h"), schema, "k", "a", "b", ["no"], buckets=16)
    assert history.read().collect() == [] and history.merge(spark.createDataFrame([], schema)) == []
    history.load(spark.createDataFrame(early, schema))
    before = history.folders()
    touched = history.merge(spark.createDataFrame(late + rows[:1], schema))
    after = history.folders()
    # Only the buckets of the delta's keys have new files.
    assert 1 <= len(touched) <= 3 and {b for b in after if after[b] != before.get(b)} == set(touched)
    whole = History(spark, str(tmp_path / "w"), schema, "k", "a", "b", ["no"], buckets=4)
    whole.load(spark.createDataFrame(rows + late[-1:], schema))
    assert Counter(map(tuple, history.read().collect())) == Counter(map(tuple, whole.read().collect()))
    assert history.merge(spark.createDataFrame(late, schema)) and history.read().count() == 301


def test_props(spark):
    texts = ['{"k": 1, "more": {"x": 2}}', '{"k": 1.5}', "{", None, "", "{}", '{"k": null}', "[1]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parsed_json(F.col("t"), "k bigint", ("k",)).alias("p"))
    found = [(x.p.value.k if x.p.value and not x.p.reason else None, x.p.reason) for x in df.collect()]
    assert found[0] == (1, None)
    assert [reason for _, reason in found[1:]] == ["not readable", "not readable", "no text", "not readable", "lacks k", "lacks k", "not readable"]


@pytest.mark.parametrize("slide", [None, "5 minutes"])
def test_windows_of_a_stream(spark, tmp_path, slide):
    """Files that come one after the other, each run stopped and started again; a late event of a closed window is left out."""
    schema = "id int, at timestamp_ntz, kind string, value double"
    start = dt.datetime(2020, 1, 1)
    sink, checkpoint, source = (str(tmp_path / x) for x in ("sink", "checkpoint", "source"))
    r, given = random.Random(7), []
    for part in range(3):
        rows = [(i, start + dt.timedelta(minutes=part * 100 + r.randrange(100)), r.choice("ab"), r.randrange(500) / 4) for i in range(80)]
        late = [(999, start, "a", 1.0)] if part == 2 else []
        spark.createDataFrame(rows + late, schema).coalesce(1).write.mode("append").parquet(source)
        given += rows
        for _ in range(2):
            events = spark.readStream.schema(schema).parquet(source)
            windows.count_windows(events, "at", ["kind"], "value", "10 minutes", "30 minutes", sink, checkpoint, slide)
    found = windows.windows(spark, [T.StructField("kind", T.StringType())], sink, checkpoint).collect()
    want: dict = defaultdict(lambda: [0, 0])
    for _, at, kind, value in given:
        minute = int((at - start).total_seconds() // 60)
        for first in {minute // 10 * 10} if slide is None else {minute // 5 * 5, minute // 5 * 5 - 5}:
            entry = want[start + dt.timedelta(minutes=first), kind]
            entry[0] += 1
            entry[1] += round(value * 100)
    assert len(found) == len(want)
    assert {(x.window_start, x.kind): [x.n_events, round(x.total * 100)] for x in found} == dict(want)
    assert {x.closed for x in found} == {True, False}


def test_first_events_of_a_stream(spark, tmp_path):
    """Parts that come one after the other, each run stopped and started again: kept + late + repeated = input, nothing twice."""
    schema = "id int, at timestamp_ntz, note string"
    start, delay = dt.datetime(2020, 1, 1), dt.timedelta(minutes=30)
    sink, checkpoint, source, audit = (str(tmp_path / x) for x in ("sink", "checkpoint", "source", "audit"))
    r, given, bound, seen = random.Random(8), 0, None, {}
    want: Counter = Counter()
    for part in range(4):
        rows = [(r.choice([1, 1, 1, *range(60), None]), start + dt.timedelta(minutes=part * 40 + r.randrange(-50, 40)), f"{part}") for _ in range(150)]
        rows.append((-1 - part, None, "no time"))
        # One time a key, so that which row is kept is the same whatever their order.
        rows = [(k, seen.setdefault(k, at), note) for k, at, note in rows]
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(source)
        for _ in range(2):
            dedup.keep_first(spark.readStream.schema(schema).parquet(source), "at", ["id"], "30 minutes", sink, checkpoint, audit)
        given += len(rows)
        for k, at, _ in rows:
            late = bound is not None and at is not None and at <= bound
            want["late" if late else "repeated" if (k, "kept") in want else "kept"] += 1
            if not late:
                want[k, "kept"] = 1
        bound = max(at for _, at, _ in rows if at) - delay if bound is None else max(bound, max(at for _, at, _ in rows if at) - delay)
    found = dedup.kept(spark, spark.createDataFrame([], schema), sink).collect()
    counts = dedup.audits(spark, audit).collect()
    assert len(found) == len({x.id for x in found}) == want["kept"]
    assert (sum(x.kept_rows for x in counts), sum(x.late_rows for x in counts), sum(x.repeated_rows for x in counts)) == (want["kept"], want["late"], want["repeated"])
    assert min(want["late"], want["repeated"]) > 20 and sum(x.input_rows for x in counts) == given
    assert len(counts) == len({x.batch for x in counts}) == 4


def test_cleaned_sales_are_compiled(spark):
    """The JVM compiles methods of up to 8,000 bytes."""
    schema = SOURCES["crm_sales_details"]
    plain = spark.range(10).select(*(F.col("id").cast(f.dataType).alias(f.name) for f in schema.fields))
    money = {c: F.col(c).cast("decimal(14,2)") for c in ("sls_sales", "sls_price")}
    dates = {"sls_order_dt": F.col("sls_order_dt").cast("string"), "sls_ship_dt": F.date_add(F.current_date(), F.col("sls_ship_dt")), "sls_due_date": F.current_date().cast("string")}
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    for bronze in (plain, conform(plain.withColumns({**money, **dates}), schema)):
        codes = debug.codegenStringSeq(silver.silver_sales(bronze)._jdf.queryExecution().executedPlan())
        assert codes.size() == 1 and codes.apply(0)._3().maxMethodCodeSize() < 6000
