"""Column functions on small literal rows."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
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


def apply(spark, function, values, kind="string"):
    """Results of a column function for each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
    return [row[0] for row in df.orderBy("n").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("labels", "expected"),
    [
        (codes.MARITAL_STATUS, {"S": "Single", " m ": "Married", "s": "Single", "": "n/a", None: "n/a", "X": "n/a"}),
        (codes.GENDER, {"F": "Female", " m": "Male", "Male": "n/a", "": "n/a", None: "n/a"}),
        (codes.GENDER_WORDS, {"male": "Male", " F ": "Female", "FEMALE": "Female", "x": "n/a", None: "n/a"}),
        (
            codes.PRODUCT_LINE,
            {"R ": "Road", "m": "Mountain", "T": "Touring", " s": "Other Sales", "Q": "n/a", None: "n/a"},
        ),
    ],
)
def test_decode(spark, labels, expected):
    assert apply(spark, lambda c: codes.decode(c, labels), list(expected)) == list(expected.values())


def test_standardize_country(spark):
    expected = {
        " DE ": "Germany", "US": "United States", "USA": "United States", "us": "us", "de": "de", "": "n/a",
        "   ": "n/a", None: "n/a", " France ": "France", "\t": "\t",
    }
    assert apply(spark, codes.standardize_country, list(expected)) == list(expected.values())


def test_prefer(spark):
    rows = [("Male", "Female"), ("n/a", "Female"), ("n/a", None), (None, "Male"), (None, None), ("n/a", "n/a")]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "n int, a string, b string")
    found = [r[0] for r in df.orderBy("n").select(codes.prefer(F.col("a"), F.col("b"))).collect()]
    assert found == ["Male", "Female", "n/a", "Male", "n/a", "n/a"]


def test_trim_removes_blanks_only(spark):
    df = spark.createDataFrame([("  a b ", " x", 1), (None, "\ty ", 2)], "a string, b string, n int")
    assert [tuple(r) for r in trim_text(df, "a", "b").orderBy("n").collect()] == [("a b", "x", 1), (None, "\ty", 2)]


def test_product_key_parts(spark):
    keys = ["CO-RF-FR-R92B-58", "AB", None, "AB-CD-" + "x" * 300]
    assert apply(spark, category_part, keys) == ["CO_RF", "AB", None, "AB_CD"]
    assert apply(spark, product_part, keys) == ["FR-R92B-58", "", None, "x" * 300]


def test_strip(spark):
    assert apply(spark, lambda c: strip_prefix(c, "NAS"), ["NASAW1", "AW1", "NAS", "nasX", None, "xNAS"]) == [
        "AW1", "AW1", "", "nasX", None, "xNAS",
    ]
    assert apply(spark, strip_separators, ["A-B-C", "", None, "--"]) == ["ABC", "", None, ""]


def test_default_if_null(spark):
    assert apply(spark, default_if_null, [None, 3, 0], "bigint") == [0, 3, 0]


def test_parse_yyyymmdd(spark):
    values = [20240229, 20240230, 20241350, 2024013, 0, None, 99999999, -2024011, 2**40]
    assert apply(spark, parse_yyyymmdd, values, "bigint") == [dt.date(2024, 2, 29)] + [None] * 8
    edges = [-(2**31), 2**31 - 1, 10000101, 99991231, 20230229, 20240200, 20240001, 20241231, 20240432]
    good = {2: dt.date(1000, 1, 1), 3: dt.date(9999, 12, 31), 7: dt.date(2024, 12, 31)}
    assert apply(spark, parse_yyyymmdd, edges, "int") == [good.get(i) for i in range(9)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**31), 2**31 - 1) | st.integers(19_990_000, 20_301_300), min_size=1, max_size=200))
def test_parse_yyyymmdd_never_fails(spark, values):
    def parsed(value):
        try:
            return dt.datetime.strptime(str(value), "%Y%m%d").date() if len(str(value)) == 8 else None
        except ValueError:
            return None

    assert apply(spark, parse_yyyymmdd, values, "int") == [parsed(v) for v in values]


def test_null_future(spark):
    days = [dt.date(2020, 1, 1), dt.date(2020, 1, 2), None]
    assert apply(spark, lambda c: null_future(c, dt.date(2020, 1, 1)), days, "date") == [days[0], None, None]
    far = dt.date.today() + dt.timedelta(days=3)
    assert apply(spark, null_future, [dt.date(1990, 5, 5), far], "date") == [dt.date(1990, 5, 5), None]


# amount, quantity, price -> amount, price
REPAIRS = [
    ((None, 2, 5), (10, 5.0)),
    ((10, 2, None), (10, 5.0)),
    ((10, 2, -5), (10, 5.0)),
    ((7, 2, 5), (10, 5.0)),
    ((-3, 1, 3), (3, 3.0)),
    ((9, 3, 0), (0, 0.0)),
    ((None, 2, None), (None, None)),
    ((5, 0, 5), (0, 5.0)),
    ((5, None, 5), (5, 5.0)),
    ((5, 0, None), (5, None)),
    ((4, -2, 2), (-4, 2.0)),
    ((1, 2_000_000_000, 2_000_000_000), (4_000_000_000_000_000_000, 2e9)),
]


def test_repair_truth_table(spark):
    df = spark.createDataFrame([(i, *row) for i, (row, _) in enumerate(REPAIRS)], "n int, a int, q int, p int")
    amount = repair_amount(F.col("a"), F.col("q"), F.col("p"))
    fixed = df.select("n", "q", "p", amount.alias("a"))
    fixed = fixed.select("n", "q", "p", "a", repair_price(F.col("p"), F.col("q"), F.col("a")).alias("fixed_p"))
    assert [(r.a, r.fixed_p) for r in fixed.orderBy("n").collect()] == [expected for _, expected in REPAIRS]
    again = fixed.select("n", "a", repair_amount(F.col("a"), F.col("q"), F.col("p")).alias("b"))
    # A second run changes only amounts that stay at or below zero, to the same value.
    assert all(r.a == r.b for r in again.collect())


def test_repair_of_fractions(spark):
    df = spark.createDataFrame([(1.0, 3, 0.5), (None, 2, -0.25)], "a double, q int, p double")
    amount = repair_amount(F.col("a"), F.col("q"), F.col("p"), number="double")
    assert sorted(r[0] for r in df.select(amount).collect()) == [0.5, 1.5]
