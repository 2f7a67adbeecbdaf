"""Bad members and scores straight from the raw table, with little data movement.

All curated tables come from the same raw rows, which settles much of the
general plan beforehand:

* Every raw row is a row of the records table, so a member with several raw
  rows is bad. A scored member has one raw row, and all of its own values
  (status, ownership, credit limit, grade, incident counts) are on that row:
  they are turned into points there, before anything moves.
* A member with one raw row is still bad if its loan id has several repayment
  rows. A scored loan id has exactly one.
* What is left to join is that one repayment against the loan rows that share
  its loan id, and their points against the scored members with that loan id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditgrade.functions import cleaning as clean
from creditgrade.functions import scores
from creditgrade.functions.identity import member_key
from creditgrade.operators import projections, skew
from creditgrade.plans import tables
from creditgrade.plans.scoring import graded, payment_points
from creditgrade.schema import (
    COUNTRY,
    CUSTOMER_FIELDS,
    DEFAULTER_FIELDS,
    LOAN_FIELDS,
    LOAN_TEXT_COLUMNS,
    REPAYMENT_FIELDS,
    REQUIRED_LOAN_COLUMNS,
    REQUIRED_REPAYMENT_COLUMNS,
)
from creditgrade.scorecard import Scorecard

_NOT_RAW = ("member_id", "country", "loan_id")


def typed_applications(raw: DataFrame) -> DataFrame:
    """The fields of all curated tables, cast and renamed, on one row per raw row."""
    fields = DEFAULTER_FIELDS | CUSTOMER_FIELDS | LOAN_FIELDS | REPAYMENT_FIELDS
    raw_fields = {source: target for source, target in fields.items() if source not in _NOT_RAW}
    return projections.with_member_id(raw).selectExpr(
        "member_id", "string(id) AS loan_id", *clean.renamed(raw_fields)
    )


_COMPLETE_LOAN = (
    LOAN_TEXT_COLUMNS,
    tuple(name for name in REQUIRED_LOAN_COLUMNS if name not in LOAN_TEXT_COLUMNS),
)


def complete_loan() -> Column:
    """Whether a row has a complete loan."""
    return clean.present(*_COMPLETE_LOAN)


def owns_loan() -> Column:
    """Whether a row has an income and a complete loan."""
    return F.col("annual_income").isNotNull() & complete_loan()


def loan_rows(rows: DataFrame) -> DataFrame:
    """What the scorecard needs of each complete loan row."""
    return rows.filter(complete_loan()).select("loan_id", "monthly_installment", "funded_amount")


def total_paid() -> Column:
    """The payments of a row, added up where their total is missing."""
    return clean.reconciled_total(
        "total_payment_received",
        "total_principal_received",
        "total_interest_received",
        "total_late_fee_received",
    )


def is_paid() -> Column:
    """Whether a row has a complete repayment of a loan id."""
    complete = clean.present((), REQUIRED_REPAYMENT_COLUMNS)
    return complete & F.col("loan_id").isNotNull() & (total_paid() != 0)


def repayments_by_loan(rows: DataFrame) -> DataFrame:
    """Per loan id its number of repayments, and the repayment if there is one only."""
    return (
        rows.filter(is_paid())
        .select("loan_id", "last_payment_amount", total_paid().alias("total_payment_received"))
        .groupBy("loan_id")
        .agg(
            F.expr("count(*) AS n"),
            F.expr("max(last_payment_amount) AS last_payment_amount"),
            F.expr("max(total_payment_received) AS total_payment_received"),
        )
    )


def _members_with_bad(rows: DataFrame, more: list[Column], rows_per_task: int) -> DataFrame:
    """One row per member: its number of raw rows, and whether its loan id is repaid twice.

    Of members with several raw rows, ``more`` holds the values of any of them.
    """
    members = (
        rows.withColumn("owned", F.when(owns_loan(), F.col("loan_id")))
        .groupBy("member_id")
        .agg(F.expr("count(*) AS n"), F.expr("max(owned) AS loan_id"), *more)
        # Of duplicated members the loan does not matter; null joins nothing.
        .withColumn("loan_id", F.expr("IF(n = 1, loan_id, NULL)"))
    )
    repaid_twice = repayments_by_loan(rows).filter("n > 1").selectExpr("loan_id", "true AS twice")
    parts = skew.crowds(loan_rows(rows), "loan_id", rows_per_task)
    return skew.join_few(members, repaid_twice, "loan_id", parts, "left")


def bad_members(raw: DataFrame, rows_per_task: int = skew.ROWS_PER_TASK) -> DataFrame:
    """The bad members of a raw application table.

    The same set as that of its verification, delinquency and records tables:
    members with several raw rows, and members with an income whose one complete
    loan has a loan id with several repayment rows.
    """
    members = _members_with_bad(typed_applications(raw), [], rows_per_task)
    return members.filter("n > 1 OR twice").select("member_id")


def good_customers(
    raw: DataFrame,
    ingest_time: Column | None = None,
    rows_per_task: int = skew.ROWS_PER_TASK,
    mean: DataFrame | None = None,
) -> DataFrame:
    """The cleaned customers of a raw application table without its bad members.

    A good member has one raw row, so its columns come out of the grouping that finds the
    bad ones. The mean that fills employment lengths is that of all customers; it is given
    where it is stored already.
    """
    rows = typed_applications(raw).withColumn("address_country", F.lit(COUNTRY))
    columns = [target for target, _ in CUSTOMER_FIELDS.values()]
    own = F.struct(*columns[1:])
    members = _members_with_bad(rows, [F.any_value(own).alias("own")], rows_per_task)
    good = members.filter("n = 1 AND twice IS NULL").select("member_id", "own.*")
    if mean is None:
        mean = tables.mean_employment(
            tables.distinct_customers(projections.customers(projections.with_member_id(raw)))
        )
    return tables.finished_customers(
        tables.numbered_employment(tables.with_income(good)), mean, ingest_time
    )


def single_members(rows: DataFrame, card: Scorecard) -> DataFrame:
    """Members with one raw row that has an income, a complete loan and a delinquency.

    One grouping over all rows: only fixed-size points and the loan id travel,
    and the rows of a duplicated member are merged before the shuffle.
    """
    counts = ("delinq_2yrs", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")
    whole = rows.withColumns(
        {name: clean.whole_or_zero(name) for name in counts}
        | {"mths_since_last_delinq": clean.whole_number("mths_since_last_delinq")}
    )
    eligible = owns_loan() & clean.is_delinquent("delinq_2yrs", "mths_since_last_delinq")
    health = scores.financial_health(
        "loan_status", "home_ownership", "funded_amount", "total_high_credit_limit", "grade", card
    )
    return (
        whole.select(
            "member_id",
            F.when(eligible, F.col("loan_id")).alias("loan_id"),
            scores.defaulters_history(*counts, card).alias("defaulters_history_pts"),
            health.alias("financial_health_pts"),
        )
        .groupBy("member_id")
        .agg(
            F.expr("count(*) AS n"),
            F.expr("max(loan_id) AS loan_id"),
            F.expr("max(defaulters_history_pts) AS defaulters_history_pts"),
            F.expr("max(financial_health_pts) AS financial_health_pts"),
        )
        .filter("n = 1 AND loan_id IS NOT NULL")
        .drop("n")
    )


def loan_points(
    rows: DataFrame, card: Scorecard, parts: DataFrame | None
) -> DataFrame:
    """Per loan id with one repayment its different points and their number.

    The points have few values, so a loan id has some fifteen rows at most. ``parts`` are
    the crowded loan ids of the loan rows.
    """
    sole = repayments_by_loan(rows).filter("n = 1").drop("n")
    loans = loan_rows(rows)
    loans = loans.selectExpr("*", f"1L AS {skew.TIMES}") if parts is None else skew.merged(loans)
    return points_of_loans(loans, sole, card, parts)


def points_of_loans(
    loans: DataFrame, sole: DataFrame, card: Scorecard, parts: DataFrame | None
) -> DataFrame:
    """``loan_points`` of counted loan rows and the loan ids' only repayments."""
    history = scores.payment_history("last_payment_pts", "total_payment_pts", card)
    points = (
        skew.join_few(loans, sole, "loan_id", parts, "inner")
        .select("loan_id", *payment_points(card), skew.TIMES)
        .select("loan_id", history.alias("payment_history_pts"), skew.TIMES)
    )
    return skew.merged(points)


def score_applications(
    raw: DataFrame, card: Scorecard = Scorecard(), rows_per_task: int = skew.ROWS_PER_TASK
) -> DataFrame:
    """Score and grade of every scorable member of a raw application table.

    The same rows as curating the table and calling ``loan_score`` with the
    good customers and the bad members of its verification table.
    """
    rows = typed_applications(raw)
    # A loan id has no more single members than loan rows, so one list serves both joins.
    parts = skew.crowds(loan_rows(rows), "loan_id", rows_per_task)
    points = loan_points(rows, card, parts)
    scored = skew.join_few(single_members(rows, card), points, "loan_id", parts, "inner")
    return graded(
        skew.repeat_rows(scored, spread=parts is not None).select(
            "member_id", "payment_history_pts", "defaulters_history_pts", "financial_health_pts"
        ),
        card,
    )
