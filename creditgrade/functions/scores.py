"""Scorecard rules as column expressions. A comparison with null is never true.

Fixed values: the limits, status words and letters in these rules have to stay as they are
for right results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditgrade.scorecard import Scorecard


def last_payment_points(paid: str, installment: str, card: Scorecard) -> Column:
    """Points for the last payment against the monthly installment."""
    # Below half and below the full installment rate the same; both are tested
    # because half is the higher limit when an installment is negative.
    return F.expr(
        f"""
        CASE WHEN {paid} < {installment} * 0.5D OR {paid} < {installment}
                THEN {card.very_bad_rated_pts}
             WHEN {paid} = {installment} THEN {card.good_rated_pts}
             WHEN {paid} <= {installment} * 1.5D THEN {card.very_good_rated_pts}
             WHEN {paid} > {installment} * 1.5D THEN {card.excellent_rated_pts}
             ELSE {card.unacceptable_rated_pts} END
        """
    )


def total_payment_points(received: str, funded: str, card: Scorecard) -> Column:
    """Points for the total received against the funded amount."""
    return F.expr(
        f"""
        CASE WHEN {received} >= {funded} * 0.5D THEN {card.very_good_rated_pts}
             WHEN {received} < {funded} * 0.5D AND {received} > 0 THEN {card.good_rated_pts}
             ELSE {card.unacceptable_rated_pts} END
        """
    )


def loan_status_points(status: str, card: Scorecard) -> Column:
    """Points by what the status contains; charged off, default and others get the least."""
    return F.expr(
        f"""
        CASE WHEN contains(lower({status}), 'fully paid') THEN {card.excellent_rated_pts}
             WHEN contains(lower({status}), 'current') THEN {card.good_rated_pts}
             WHEN contains(lower({status}), 'in grace period') THEN {card.bad_rated_pts}
             WHEN contains(lower({status}), 'late') THEN {card.very_bad_rated_pts}
             ELSE {card.unacceptable_rated_pts} END
        """
    )


def home_ownership_points(ownership: str, card: Scorecard) -> Column:
    return F.expr(
        f"""
        CASE WHEN endswith(lower({ownership}), 'own') THEN {card.excellent_rated_pts}
             WHEN endswith(lower({ownership}), 'rent') THEN {card.good_rated_pts}
             WHEN endswith(lower({ownership}), 'mortgage') THEN {card.bad_rated_pts}
             ELSE {card.very_bad_rated_pts} END
        """
    )


def credit_use_points(funded: str, credit_limit: str, card: Scorecard) -> Column:
    """Points for the funded amount as a share of the credit limit."""
    return F.expr(
        f"""
        CASE WHEN {funded} <= {credit_limit} * 0.10D THEN {card.excellent_rated_pts}
             WHEN {funded} <= {credit_limit} * 0.20D THEN {card.very_good_rated_pts}
             WHEN {funded} <= {credit_limit} * 0.30D THEN {card.good_rated_pts}
             WHEN {funded} <= {credit_limit} * 0.50D THEN {card.bad_rated_pts}
             WHEN {funded} <= {credit_limit} * 0.70D THEN {card.very_bad_rated_pts}
             ELSE {card.unacceptable_rated_pts} END
        """
    )


def grade_points(grade: str, card: Scorecard) -> Column:
    return F.expr(
        f"""
        CASE {grade} WHEN 'A' THEN {card.excellent_rated_pts}
             WHEN 'B' THEN {card.very_good_rated_pts} WHEN 'C' THEN {card.good_rated_pts}
             WHEN 'D' THEN {card.bad_rated_pts} WHEN 'E' THEN {card.very_bad_rated_pts}
             ELSE {card.unacceptable_rated_pts} END
        """
    )


def payment_history(last_payment_pts: str, total_payment_pts: str, card: Scorecard) -> Column:
    weight = card.payment_history_weight
    return F.expr(f"({last_payment_pts} + {total_payment_pts}) * {weight}D")


def defaulters_history(
    delinquencies: str, records: str, bankruptcies: str, enquiries: str, card: Scorecard
) -> Column:
    """Weighted raw counts: more incidents give a higher score."""
    counts = f"{delinquencies} + {records} + {bankruptcies} + {enquiries}"
    return F.expr(f"({counts}) * {card.defaulters_history_weight}D")


def financial_health(
    status: str, ownership: str, funded: str, credit_limit: str, grade: str, card: Scorecard
) -> Column:
    """Weighted points of the loan status, home ownership, credit use and grade."""
    unweighted = (
        loan_status_points(status, card)
        + home_ownership_points(ownership, card)
        + credit_use_points(funded, credit_limit, card)
    )
    by_grade, weight = grade_points(grade, card), card.financial_health_weight
    if card.grade_weight_scope == "all":
        return (unweighted + by_grade) * weight
    return unweighted + by_grade * weight


def total_score(payment_pts: str, defaulters_pts: str, health_pts: str) -> Column:
    return F.expr(f"{payment_pts} + {defaulters_pts} + {health_pts}")


def grade_band(score: str, card: Scorecard) -> Column:
    """Letter of the score; a null score has none."""
    return F.expr(
        f"""
        CASE WHEN {score} > {card.very_good_grade_pts} THEN 'A'
             WHEN {score} > {card.good_grade_pts} THEN 'B'
             WHEN {score} > {card.bad_grade_pts} THEN 'C'
             WHEN {score} > {card.very_bad_grade_pts} THEN 'D'
             WHEN {score} > {card.unacceptable_grade_pts} THEN 'E'
             WHEN {score} <= {card.unacceptable_grade_pts} THEN 'F' END
        """
    )
