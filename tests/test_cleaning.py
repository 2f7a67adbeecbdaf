import math

import pytest
from pyspark.sql import functions as F

from creditgrade.functions import cleaning as clean
from creditgrade.functions.identity import member_key
from creditgrade.plans import tables
from creditgrade.schema import LOAN_PURPOSES, MEMBER_KEY_COLUMNS


def one(spark, column, **values):
    names = ", ".join(f"{name} string" for name in values)
    df = spark.createDataFrame([tuple(values.values())], names)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, years",
    [("10+ years", 10), ("< 1 year", 1), ("n/a", None), ("", None), (None, None), ("3", 3)],
)
def test_digits_to_int(spark, text, years):
    assert one(spark, clean.digits_to_int("c"), c=text) == years


@pytest.mark.parametrize("code, kept", [("NY", "NY"), ("N10", "NA"), ("", ""), (None, None)])
def test_state_code(spark, code, kept):
    assert one(spark, clean.state_code("c"), c=code) == kept


@pytest.mark.parametrize(
    "term, years",
    [(" 36 months", 3), ("60 months", 5), (" 11 months", 0), ("x months", None), (None, None)],
)
def test_term_years(spark, term, years):
    assert one(spark, clean.term_years("c"), c=term) == years


@pytest.mark.parametrize(
    "purpose, kept", [("car", "car"), ("boat", "other"), (None, "other"), ("Car", "other")]
)
def test_purpose(spark, purpose, kept):
    assert one(spark, clean.allowed_or_other("c", LOAN_PURPOSES), c=purpose) == kept


@pytest.mark.parametrize("text, date", [("0.0", None), ("Jan-2015", "Jan-2015"), (None, None)])
def test_real_date(spark, text, date):
    assert one(spark, clean.real_date("c"), c=text) == date


def test_reconciled_total(spark):
    total = clean.reconciled_total("t", "p", "i", "f")
    df = spark.createDataFrame(
        [(0.0, 5.0, 2.0, 1.0), (3.0, 5.0, 2.0, 1.0), (0.0, 0.0, 2.0, 1.0), (None, 5.0, 1.0, 1.0)],
        "t float, p float, i float, f float",
    )
    assert [row[0] for row in df.select(total).collect()] == [8.0, 3.0, 0.0, None]


@pytest.mark.parametrize(
    "value, filled", [(2.9, 2), (-2.9, -2), (None, 0), (math.nan, 0), (1e30, 0)]
)
def test_whole_or_zero(spark, value, filled):
    df = spark.createDataFrame([(value,)], "c float")
    assert df.select(clean.whole_or_zero("c")).first()[0] == filled


def test_lenient_casts(spark):
    df = spark.createDataFrame([("1.5",), ("",), ("abc",), ("NaN",), (None,)], "c string")
    out = [r[0] for r in tables.rename_and_cast(df, {"c": ("x", "float")}).collect()]
    assert out[0] == 1.5 and out[1] is None and out[2] is None and out[4] is None
    assert math.isnan(out[3])


def test_member_key(spark):
    values = dict.fromkeys(MEMBER_KEY_COLUMNS, "a")
    key = one(spark, member_key(), **values)
    assert len(key) == 64 and key == key.lower()
    # Nulls are left out, so a null in one place equals a null in the next.
    columns = ("c", "d")
    left = one(spark, member_key(columns), c="a", d=None)
    right = one(spark, member_key(columns), c=None, d="a")
    assert left == right is not None


def test_required_columns_drop_nan(spark):
    rows = [(1.0, "a"), (math.nan, "a"), (None, "a"), (1.0, None)]
    df = spark.createDataFrame(rows, "n float, t string")
    assert df.filter(clean.present(["t"], ["n"])).count() == 1
    assert df.na.drop(subset=["n", "t"]).count() == 1


def test_income_filter_keeps_nan(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "annual_income float")
    assert tables.with_income(df).count() == 2


def test_delinquent_needs_a_true_side(spark):
    df = spark.createDataFrame([(0, None), (0, 0), (1, None), (0, 3)], "a int, b int")
    assert df.filter(clean.is_delinquent("a", "b")).count() == 2


def test_fill_with_floor_mean(spark):
    df = spark.createDataFrame([(1,), (4,), (None,)], "y int")
    filled = tables.fill_with_floor_mean(df, "y")
    assert sorted(r[0] for r in filled.collect()) == [1, 2, 4]
    assert filled.schema["y"].dataType.simpleString() == "int"
    nothing = tables.fill_with_floor_mean(df.filter("y IS NULL"), "y")
    assert [r[0] for r in nothing.collect()] == [None]


def test_ingest_time_is_one_value(spark):
    df = tables.stamp_ingest(spark.range(1000).repartition(8))
    assert df.select(tables.INGEST_COLUMN).distinct().count() == 1
    fixed = F.lit("2024-01-01").cast("timestamp")
    assert tables.stamp_ingest(spark.range(1), fixed).first()[1].year == 2024
