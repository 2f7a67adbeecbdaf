import pytest

from creditgrade.functions import scores
from creditgrade.scorecard import Scorecard

CARD = Scorecard()


def points(spark, column, schema, *values):
    df = spark.createDataFrame([values], schema)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "paid, due, expected",
    [
        (49.0, 100.0, 100),
        (50.0, 100.0, 100),
        (99.0, 100.0, 100),
        (100.0, 100.0, 500),
        (101.0, 100.0, 650),
        (150.0, 100.0, 650),
        (150.5, 100.0, 800),
        (0.0, 0.0, 500),
        (-80.0, -100.0, 100),
        (None, 100.0, 0),
        (1.0, None, 0),
        (0.1, 0.1, 500),
    ],
)
def test_last_payment(spark, paid, due, expected):
    rule = scores.last_payment_points("p", "m", CARD)
    assert points(spark, rule, "p float, m float", paid, due) == expected


@pytest.mark.parametrize(
    "received, funded, expected",
    [
        (50.0, 100.0, 650),
        (49.9, 100.0, 500),
        (0.0, 100.0, 0),
        (0.0, 0.0, 650),
        (-1.0, 100.0, 0),
        (None, 100.0, 0),
        (5.0, None, 0),
    ],
)
def test_total_payment(spark, received, funded, expected):
    rule = scores.total_payment_points("r", "f", CARD)
    assert points(spark, rule, "r float, f float", received, funded) == expected


@pytest.mark.parametrize(
    "status, expected",
    [
        ("Fully Paid", 800),
        ("Does not meet the policy. Status:Fully Paid", 800),
        ("CURRENT", 500),
        ("In Grace Period", 250),
        ("Late (31-120 days)", 100),
        ("Charged Off", 0),
        ("Default", 0),
        (None, 0),
    ],
)
def test_loan_status(spark, status, expected):
    assert points(spark, scores.loan_status_points("s", CARD), "s string", status) == expected


@pytest.mark.parametrize(
    "ownership, expected",
    [("OWN", 800), ("rent", 500), ("Mortgage", 250), ("OWNED", 100), ("ANY", 100), (None, 100)],
)
def test_home_ownership(spark, ownership, expected):
    rule = scores.home_ownership_points("h", CARD)
    assert points(spark, rule, "h string", ownership) == expected


@pytest.mark.parametrize(
    "funded, limit, expected",
    [
        (100.0, 1000.0, 800),
        (200.0, 1000.0, 650),
        (300.0, 1000.0, 500),
        (500.0, 1000.0, 250),
        (700.0, 1000.0, 100),
        (700.1, 1000.0, 0),
        (100.0, None, 0),
    ],
)
def test_credit_use(spark, funded, limit, expected):
    rule = scores.credit_use_points("f", "l", CARD)
    assert points(spark, rule, "f float, l float", funded, limit) == expected


@pytest.mark.parametrize(
    "grade, expected",
    [("A", 800), ("B", 650), ("C", 500), ("D", 250), ("E", 100), ("F", 0), ("a", 0), (None, 0)],
)
def test_grade(spark, grade, expected):
    assert points(spark, scores.grade_points("g", CARD), "g string", grade) == expected


@pytest.mark.parametrize(
    "score, letter",
    [
        (2500.01, "A"),
        (2500.0, "B"),
        (2000.01, "B"),
        (2000.0, "C"),
        (1500.0, "D"),
        (1000.0, "E"),
        (750.01, "E"),
        (750.0, "F"),
        (0.0, "F"),
        (None, None),
    ],
)
def test_grade_band(spark, score, letter):
    assert points(spark, scores.grade_band("s", CARD), "s double", score) == letter


def test_weight_scope(spark):
    names = ("s", "h", "f", "l", "g")
    schema = "s string, h string, f float, l float, g string"
    values = ("Current", "OWN", 100.0, 1000.0, "B")
    by_grade = points(spark, scores.financial_health(*names, CARD), schema, *values)
    card = Scorecard(grade_weight_scope="all")
    by_all = points(spark, scores.financial_health(*names, card), schema, *values)
    assert by_grade == 500 + 800 + 800 + 650 * 0.35
    assert by_all == (500 + 800 + 800 + 650) * 0.35
    with pytest.raises(ValueError):
        Scorecard(grade_weight_scope="none")


def test_weights(spark):
    history = scores.payment_history("a", "b", CARD)
    assert points(spark, history, "a int, b int", 100, 650) == 750 * 0.20
    counts = scores.defaulters_history("a", "b", "c", "d", CARD)
    assert points(spark, counts, "a int, b int, c int, d int", 1, 2, 3, 4) == 10 * 0.45


def test_scorecard_from_session(spark):
    assert Scorecard.from_session(spark) == CARD
    spark.conf.set("spark.sql.good_rated_pts", "501")
    try:
        assert Scorecard.from_session(spark) == Scorecard(good_rated_pts=501)
    finally:
        spark.conf.unset("spark.sql.good_rated_pts")


def test_thresholds_may_be_fractional(spark):
    spark.conf.set("spark.sql.very_good_grade_pts", "2500.5")
    try:
        card = Scorecard.from_session(spark)
        assert card.very_good_grade_pts == 2500.5
        row = spark.createDataFrame([(2500.25,)], "s double").select(scores.grade_band("s", card))
        assert row.first()[0] == "B"
    finally:
        spark.conf.unset("spark.sql.very_good_grade_pts")
