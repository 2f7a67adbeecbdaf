"""The scorecard over curated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from creditgrade.functions import scores
from creditgrade.operators import skew
from creditgrade.operators.duplicates import good_customers
from creditgrade.operators.statistics import KeyStatistics
from creditgrade.operators.wanted import WantedKeys, wanted_keys
from creditgrade.scorecard import Scorecard


def payment_points(card: Scorecard) -> list[Column]:
    """Points of a repayment row joined with a loan row."""
    return [
        scores.last_payment_points("last_payment_amount", "monthly_installment", card).alias(
            "last_payment_pts"
        ),
        scores.total_payment_points("total_payment_received", "funded_amount", card).alias(
            "total_payment_pts"
        ),
    ]


# Different points that the repayments of one loan id can have, at most.
POINT_KINDS = 32


def _pairs(
    repayments: DataFrame,
    loans: DataFrame,
    columns: tuple[str, ...],
    rows_per_task: int,
    statistics: KeyStatistics | None = None,
) -> tuple[DataFrame, bool]:
    return skew.counted_join(
        loans.select("loan_id", *columns),
        [repayments.select("loan_id", "last_payment_amount", "total_payment_received")],
        "loan_id",
        "inner",
        rows_per_task,
        statistics,
    )


_COMPARED = ("monthly_installment", "funded_amount")


def repayments_with_loans_counted(
    repayments: DataFrame,
    loans: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """Pairs of a repayment and a loan row with its loan id, each with its number."""
    return _pairs(repayments, loans, _COMPARED, rows_per_task, statistics)[0]


def repayments_with_loans(
    repayments: DataFrame,
    loans: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """Every repayment row with every loan row that has its loan id."""
    pairs, crowded = _pairs(repayments, loans, _COMPARED, rows_per_task, statistics)
    return skew.repeat_rows(pairs, spread=crowded)


def repayment_points_counted(
    repayments: DataFrame,
    loans: DataFrame,
    card: Scorecard = Scorecard(),
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """Different points of the repayment rows of a loan id, with their number.

    Points take a few values, so a loan id has few rows whatever it had before.
    """
    pairs = repayments_with_loans_counted(repayments, loans, rows_per_task, statistics)
    return skew.merged(pairs.select("loan_id", *payment_points(card), skew.TIMES))


def points_by_member_counted(
    points: DataFrame,
    loans: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """Counted points of loan ids with every member that has a loan row with the loan id."""
    owners = loans.select("loan_id", "member_id")
    parts = skew.crowds(owners, "loan_id", rows_per_task, statistics)
    owners = owners.selectExpr("*", "1L AS _loans") if parts is None else skew.merged(owners, "_loans")
    return skew.join_few(owners, points, "loan_id", parts, "inner").selectExpr(
        "member_id", "last_payment_pts", "total_payment_pts", f"_loans * {skew.TIMES} AS {skew.TIMES}"
    )


def repayment_points_by_member(
    points: DataFrame,
    loans: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """``points_by_member_counted`` row by row."""
    return skew.repeat_rows(points_by_member_counted(points, loans, rows_per_task, statistics))


def unique_loan_points_by_member(
    repayments: DataFrame,
    loans: DataFrame,
    card: Scorecard = Scorecard(),
    rows_per_task: int = skew.ROWS_PER_TASK,
) -> DataFrame:
    """``repayment_points_by_member`` with one join instead of two.

    Equal to it only where no loan id has several rows in ``loans``.
    """
    pairs, crowded = _pairs(repayments, loans, ("member_id", *_COMPARED), rows_per_task)
    points = pairs.select("member_id", *payment_points(card), skew.TIMES)
    return skew.repeat_rows(points, spread=crowded)


def _points_of(
    people: DataFrame,
    likely_people: WantedKeys,
    loans: DataFrame,
    repayments: DataFrame,
    card: Scorecard,
    rows_per_task: int,
    statistics: KeyStatistics | None,
) -> DataFrame:
    """Counted repayment points, made only for loan ids that the people have.

    The many copies of one application have a product of pairs of repayment and loan rows.
    Their member is a bad one, so these pairs are not formed.
    """
    owners = likely_people.keep(loans.select("loan_id", "member_id"), "member_id")
    by_member = skew.crowds(owners, "member_id", rows_per_task, statistics)
    owned = skew.join_few(owners, people.select("member_id"), "member_id", by_member, "left_semi")
    wanted = skew.write_shared(owned.select("loan_id").distinct(), "wanted-loans")
    # Rows of other loan ids go before they are shuffled, but for a few.
    likely = wanted_keys(wanted, "loan_id")
    loans, repayments = (
        skew.join_few(
            likely.keep(table, "loan_id"), wanted, "loan_id",
            skew.crowds(table, "loan_id", rows_per_task, statistics), "left_semi",
        )
        for table in (loans, repayments)
    )
    points = repayment_points_counted(repayments, loans, card, rows_per_task, statistics)
    return points_by_member_counted(points, loans, rows_per_task, statistics)


def score_base_counted(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    bad: DataFrame | None,
    delinquency: DataFrame,
    records: DataFrame,
    card: Scorecard = Scorecard(),
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """Different combinations of a member's rows in all five tables, with their number.

    ``bad`` members are left out; pass None when ``customers`` already comes without them.
    Members that lack a row in any of the tables join nothing; those with very many rows
    among them are taken out before the joins.
    """
    people = customers.select(
        "member_id", "home_ownership", "total_high_credit_limit", "grade", "sub_grade"
    )
    if bad is not None:
        people = good_customers(people, bad, rows_per_task, statistics)
    people = skew.write_shared(people, "people")
    likely = wanted_keys(people, "member_id")
    points = _points_of(people, likely, loans, repayments, card, rows_per_task, statistics)
    points = skew.write_shared(skew.merged(points), "points")
    arms = [
        likely.keep(records, "member_id").selectExpr(
            "member_id",
            "pub_rec AS public_records_pts",
            "pub_rec_bankruptcies AS public_bankruptcies_pts",
            "inq_last_6mths AS enq_pts",
        ),
        likely.keep(delinquency, "member_id").selectExpr("member_id", "delinq_2yrs AS delinq_pts"),
        likely.keep(loans, "member_id").select("member_id", "loan_status", "funded_amount"),
        points,
    ]
    # Of points a member has some kinds only; the other tables have no more rows of it than
    # the rows they come from.
    if statistics is not None and statistics.never_above("member_id", 4, rows_per_task // POINT_KINDS):
        joined = skew.star_join(people, arms, "member_id", None, "inner")
    else:
        joined, _ = skew.counted_join(people, arms, "member_id", "inner", rows_per_task)
    return joined.select(
        "member_id",
        "last_payment_pts",
        "total_payment_pts",
        "delinq_pts",
        "public_records_pts",
        "public_bankruptcies_pts",
        "enq_pts",
        "loan_status",
        "home_ownership",
        "total_high_credit_limit",
        "funded_amount",
        "grade",
        "sub_grade",
        skew.TIMES,
    )


def score_base(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    bad: DataFrame | None,
    delinquency: DataFrame,
    records: DataFrame,
    card: Scorecard = Scorecard(),
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """One row per combination of a member's rows in all five tables."""
    return skew.repeat_rows(
        score_base_counted(
            customers, loans, repayments, bad, delinquency, records, card, rows_per_task, statistics
        )
    )


def score_parts(base: DataFrame, card: Scorecard = Scorecard()) -> DataFrame:
    """The three weighted parts of the score."""
    return base.select(
        "member_id",
        scores.payment_history("last_payment_pts", "total_payment_pts", card).alias(
            "payment_history_pts"
        ),
        scores.defaulters_history(
            "delinq_pts", "public_records_pts", "public_bankruptcies_pts", "enq_pts", card
        ).alias("defaulters_history_pts"),
        scores.financial_health(
            "loan_status",
            "home_ownership",
            "funded_amount",
            "total_high_credit_limit",
            "grade",
            card,
        ).alias("financial_health_pts"),
    )


def graded(parts: DataFrame, card: Scorecard = Scorecard()) -> DataFrame:
    """Add the total score and its letter."""
    total = scores.total_score(
        "payment_history_pts", "defaulters_history_pts", "financial_health_pts"
    )
    return parts.select("*", total.alias("loan_score")).select(
        "*", scores.grade_band("loan_score", card).alias("loan_final_grade")
    )


def loan_score(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    bad: DataFrame | None,
    delinquency: DataFrame,
    records: DataFrame,
    card: Scorecard = Scorecard(),
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """Score and grade of the members in all of the given tables and not in ``bad``.

    Takes any tables of these shapes. From one raw table,
    ``score_applications`` gives the same rows with much less data movement.
    """
    base = score_base(
        customers, loans, repayments, bad, delinquency, records, card, rows_per_task, statistics
    )
    return graded(score_parts(base, card), card)
