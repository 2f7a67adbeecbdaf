"""The fast plans give the rows of the step-by-step ones."""

from dataclasses import replace

import pytest
from conftest import random_applications, rows_of
from pyspark.sql import functions as F

from creditgrade.operators import duplicates, skew
from creditgrade.operators.statistics import KeyStatistics
from creditgrade.plans import direct, scoring
from creditgrade.plans.batch import CuratedTables, curate
from creditgrade.scorecard import Scorecard
from creditgrade.sources import star, write_parquet

SEEDS = [1, 2]


@pytest.fixture(scope="module", params=SEEDS)
def raw(spark, request, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "applications")
    return write_parquet(random_applications(spark, request.param), path)


@pytest.fixture(scope="module")
def curated(raw, tmp_path_factory):
    folder = tmp_path_factory.mktemp("curated")
    tables = curate(raw, F.lit("2024-01-01").cast("timestamp"))
    return CuratedTables(
        **{name: write_parquet(df, str(folder / name)) for name, df in tables.tables().items()}
    )


@pytest.fixture(scope="module")
def bad_rows(curated):
    return rows_of(plain_bad(curated))


@pytest.fixture(scope="module")
def score_rows(curated):
    return rows_of(plain_scores(curated))


def plain_verification(t):
    """The verification table as four plain left joins."""
    c, l, r = t.customers.drop("ingest_date"), t.loans, t.repayments
    l = l.drop("ingest_date", "loan_title")
    r = r.drop("ingest_date", "total_payment_received", "last_payment_amount")
    joined = c.join(l, "member_id", "left").join(r, "loan_id", "left")
    return joined.join(t.delinquency, "member_id", "left").join(t.records, "member_id", "left")


def spread(t, rows_per_task=2):
    """The tables with so few rows per task that many keys are crowded."""
    return replace(t, rows_per_task=rows_per_task)


def plain_bad(t):
    return duplicates.bad_members(plain_verification(t), t.delinquency, t.records)


def plain_scores(t, card=Scorecard()):
    """The scores as the plain joins of all tables."""
    bad = plain_bad(t)
    good = t.customers.join(bad, "member_id", "left_anti")
    pairs = t.repayments.join(
        t.loans.select("loan_id", "monthly_installment", "funded_amount"), "loan_id"
    )
    points = pairs.select("loan_id", *scoring.payment_points(card))
    by_member = points.join(t.loans.select("loan_id", "member_id"), "loan_id").drop("loan_id")
    base = (
        t.records.join(t.delinquency, "member_id")
        .join(by_member, "member_id")
        .join(t.loans.select("member_id", "loan_status", "funded_amount"), "member_id")
        .join(good.drop("verification_status"), "member_id")
        .withColumnsRenamed(
            {
                "delinq_2yrs": "delinq_pts",
                "pub_rec": "public_records_pts",
                "pub_rec_bankruptcies": "public_bankruptcies_pts",
                "inq_last_6mths": "enq_pts",
            }
        )
    )
    return scoring.graded(scoring.score_parts(base, card), card)


def test_verification(curated):
    expected = plain_verification(curated)
    for t in (curated, spread(curated), spread(curated, 30)):
        built = t.verification()
        assert len(built.columns) == 35
        assert rows_of(built.select(*expected.columns)) == rows_of(expected)
        counted = t.verification_counted().agg(F.sum(skew.TIMES)).first()[0]
        assert counted == expected.count()


def test_verification_dealt_by_member(curated):
    """With statistics no table is merged and written; members without a key meet nothing."""
    few = replace(curated, rows_per_task=4, statistics=KeyStatistics(31, {"member_id": 90, "loan_id": 400}))
    customers = curated.customers
    without_key = customers.withColumn("member_id", F.lit(None).cast("string"))
    records = curated.records.withColumn("member_id", F.lit(None).cast("string"))
    few = replace(few, customers=customers.union(without_key), records=curated.records.union(records))
    expected = plain_verification(few)
    built = few.verification()
    assert built.columns == curated.verification().columns
    assert rows_of(built.select(*expected.columns)) == rows_of(expected)
    counted = few.verification_counted()
    assert counted.count() == counted.drop(skew.TIMES).distinct().count()
    assert counted.agg(F.sum(skew.TIMES)).first()[0] == expected.count()


def test_fixture_has_crowded_keys(curated):
    loans = skew.crowded_keys([curated.loans, curated.repayments], "loan_id", 2)
    members = skew.crowds(curated.records, "member_id", 2)
    assert loans.count() > 0 and members.count() > 0


def test_bad_members(curated, bad_rows):
    assert bad_rows
    for t in (curated, spread(curated)):
        assert rows_of(t.bad_members()) == bad_rows


def test_bad_members_of_raw(raw, bad_rows):
    assert rows_of(direct.bad_members(raw)) == bad_rows
    assert rows_of(direct.bad_members(raw, rows_per_task=2)) == bad_rows


def test_good_customers_of_raw(raw, curated, bad_rows):
    time = F.lit("2024-01-01").cast("timestamp")
    expected = rows_of(curated.customers.join(plain_bad(curated), "member_id", "left_anti"))
    for rows_per_task in (2, 100_000):
        good = direct.good_customers(raw, time, rows_per_task)
        assert rows_of(good.select(*curated.customers.columns)) == expected


def test_duplicate_verification_members(curated):
    expected = rows_of(duplicates.duplicate_keys(plain_verification(curated)))
    for t in (curated, spread(curated)):
        built = duplicates.duplicate_verification_members(*vars(t).values())
        assert rows_of(built) == expected


def test_good_customers(curated):
    bad = plain_bad(curated)
    expected = rows_of(curated.customers.join(bad, "member_id", "left_anti"))
    for rows_per_task in (1, 100_000):
        good = duplicates.good_customers(curated.customers, bad, rows_per_task)
        assert rows_of(good) == expected


def test_direct_score(raw, score_rows):
    assert len(score_rows) > 10
    assert rows_of(direct.score_applications(raw)) == score_rows
    assert rows_of(direct.score_applications(raw, rows_per_task=2)) == score_rows


def test_direct_score_with_other_weights(raw, curated):
    card = Scorecard(grade_weight_scope="all", good_rated_pts=480, bad_grade_pts=1200)
    assert rows_of(direct.score_applications(raw, card)) == rows_of(plain_scores(curated, card))


def test_score_from_tables(curated, score_rows):
    t = curated
    bad = plain_bad(t)
    good = duplicates.good_customers(t.customers, bad)
    for rows_per_task in (2, 100_000):
        for people, left_out in ((good, None), (t.customers, bad)):
            built = scoring.loan_score(
                people, t.loans, t.repayments, left_out, t.delinquency, t.records,
                rows_per_task=rows_per_task,
            )
            assert rows_of(built) == score_rows


def test_second_removal_of_bad_members_changes_nothing(curated, score_rows):
    t = curated
    bad = plain_bad(t)
    good = duplicates.good_customers(t.customers, bad)
    built = scoring.loan_score(good, t.loans, t.repayments, bad, t.delinquency, t.records)
    assert rows_of(built) == score_rows


def test_score_of_duplicated_customers(curated):
    """Any customers can be scored, also ones with several rows per member."""
    t = curated
    nobody = plain_bad(t).filter("false")
    plain = scoring.loan_score(t.customers, t.loans, t.repayments, None, t.delinquency, t.records)
    for bad in (None, nobody):
        dealt = scoring.loan_score(
            t.customers, t.loans, t.repayments, bad, t.delinquency, t.records, rows_per_task=5
        )
        assert rows_of(dealt) == rows_of(plain)


def test_plans_without_broadcast(raw, curated, bad_rows, score_rows, no_broadcast):
    assert rows_of(direct.score_applications(raw)) == score_rows
    assert rows_of(direct.score_applications(raw, rows_per_task=2)) == score_rows
    assert rows_of(spread(curated).bad_members()) == bad_rows


def test_folded_points_need_unique_loans(spark, sf_dir):
    t = curate(star.applications(spark, sf_dir))
    unique = t.loans.join(duplicates.duplicate_keys(t.loans, "loan_id"), "loan_id", "left_anti")
    t = CuratedTables(t.customers, unique, t.repayments, t.delinquency, t.records)
    points = scoring.repayment_points_counted(t.repayments, t.loans)
    assert rows_of(scoring.unique_loan_points_by_member(t.repayments, t.loans)) == rows_of(
        scoring.repayment_points_by_member(points, t.loans)
    )


def test_invariants(spark, sf_dir):
    raw = star.applications(spark, sf_dir)
    t = curate(raw)
    scored = direct.score_applications(raw).cache()
    assert scored.join(t.bad_members(), "member_id").count() == 0
    assert scored.join(t.delinquency, "member_id", "left_anti").count() == 0
    bounds = scored.groupBy("loan_final_grade").agg(
        F.min("loan_score").alias("low"), F.max("loan_score").alias("high")
    )
    bounds = sorted(tuple(row) for row in bounds.collect())
    assert all(better[1] > worse[2] for better, worse in zip(bounds, bounds[1:]))
    scored.unpersist()


def test_known_row_counts(spark, sf_dir):
    raw = star.applications(spark, sf_dir)
    t = curate(raw)
    bad = t.bad_members()
    tables = [raw, *t.tables().values(), t.verification(), bad]
    assert [df.count() for df in tables] == [1508, 1009, 1491, 1443, 1286, 1508, 4433, 337]
    assert duplicates.good_customers(t.customers, bad).count() == 692
    grades = direct.score_applications(raw).groupBy("loan_final_grade").count()
    assert dict(grades.collect()) == {"A": 11, "B": 27, "C": 168, "D": 218, "E": 80, "F": 60}
    every = direct.score_applications(raw, Scorecard(grade_weight_scope="all"))
    grades = every.groupBy("loan_final_grade").count()
    assert dict(grades.collect()) == {"D": 23, "E": 170, "F": 371}


def test_members_of_a_hot_loan_are_dealt_once(spark):
    """Dealing keeps one row per member, whatever the number of parts."""
    members = spark.range(5000).selectExpr("'hot' AS loan_id", "id AS member_id").repartition(3)
    parts = skew.crowds(members, "loan_id", 100)
    dealt = skew.with_cells(members, "loan_id", parts.selectExpr("loan_id", "p0", "1L AS p1"), 0)
    assert dealt.count() == 5000 and dealt.select(skew.CELL).distinct().count() == 50


def reads(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_good_customers_read_the_input_few_times(spark, raw):
    assert reads(direct.good_customers(raw)) <= 4
    assert reads(direct.score_applications(raw)) <= 4
