"""Distinct rows, duplicated keys and the set of bad (duplicated) members."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditgrade.operators import skew
from creditgrade.operators.statistics import KeyStatistics
from creditgrade.operators.wanted import wanted_keys


def duplicate_keys(df: DataFrame, key: str = "member_id") -> DataFrame:
    """Keys with more than one row. Counts are combined before the shuffle."""
    return df.groupBy(key).agg(F.expr("count(*) AS total")).filter("total > 1").select(key)


def bad_members(verification: DataFrame, delinquency: DataFrame, records: DataFrame) -> DataFrame:
    """Members with more than one row in any of three given tables.

    All three tables are counted in one grouping, so the members are shuffled
    once and come out unique.
    """
    tables = (verification, delinquency, records)
    tagged = [
        table.selectExpr("member_id", *(f"{int(i == j)} AS n{j}" for j in range(len(tables))))
        for i, table in enumerate(tables)
    ]
    counts = reduce(DataFrame.union, tagged).groupBy("member_id")
    totals = counts.agg(*(F.expr(f"sum(n{j}) AS n{j}") for j in range(len(tables))))
    return totals.filter("greatest(n0, n1, n2) > 1").select("member_id")


_COUNTED = ("customers", "loans", "delinquency", "records", "repaid_twice")


def _counted(df: DataFrame, name: str) -> DataFrame:
    number = skew.TIMES if skew.TIMES in df.columns else "1L"
    return df.selectExpr("member_id", *(f"{number if c == name else '0L'} AS {c}" for c in _COUNTED))


def _member_counts(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    delinquency: DataFrame,
    records: DataFrame,
    rows_per_task: int,
    statistics: KeyStatistics | None,
) -> DataFrame:
    """Per member, its rows in each table and its loans with several repayment rows."""
    tables = {
        "customers": customers,
        "loans": loans,
        "delinquency": delinquency,
        "records": records,
        "repaid_twice": loans_repaid_twice(loans, repayments, rows_per_task, statistics),
    }
    rows = reduce(DataFrame.union, (_counted(df, name) for name, df in tables.items()))
    return rows.groupBy("member_id").agg(*(F.expr(f"sum({c}) AS {c}") for c in _COUNTED))


def loans_repaid_twice(
    loans: DataFrame,
    repayments: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """Members of the loans whose loan id has several repayment rows, with their number.

    Loans with other ids go before they are shuffled, but for a few.
    """
    twice = skew.write_shared(duplicate_keys(repayments, "loan_id"), "repaid-twice")
    likely = wanted_keys(twice, "loan_id").keep(loans.select("loan_id", "member_id"), "loan_id")
    owners = skew.merged(likely)
    return skew.join_few(
        owners,
        twice,
        "loan_id",
        skew.crowds(owners, "loan_id", rows_per_task, statistics),
        "left_semi",
    ).select("member_id", skew.TIMES)


# Rows of a member in the verification table: customers x (repayment rows of its
# loans, at least one each) x delinquency x records, where an empty factor counts
# as one. The product exceeds one exactly if a factor does.
_SEVERAL_IN_VERIFICATION = """
    customers > 0 AND (greatest(customers, loans, delinquency, records) > 1 OR repaid_twice > 0)
"""


def duplicate_verification_members(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    delinquency: DataFrame,
    records: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """Members with several verification rows, without building that table."""
    counts = _member_counts(
        customers, loans, repayments, delinquency, records, rows_per_task, statistics
    )
    return counts.filter(_SEVERAL_IN_VERIFICATION).select("member_id")


def bad_members_from_tables(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    delinquency: DataFrame,
    records: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """``bad_members`` of the verification table of these five tables.

    Gives the same set without building the verification table, whose rows per
    member grow with the fourth power of the member's applications.
    """
    counts = _member_counts(
        customers, loans, repayments, delinquency, records, rows_per_task, statistics
    )
    return counts.filter(
        f"({_SEVERAL_IN_VERIFICATION}) OR greatest(delinquency, records) > 1"
    ).select("member_id")


def good_customers(
    customers: DataFrame,
    bad: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """Customers that are not in the bad set."""
    parts = skew.crowds(customers, "member_id", rows_per_task, statistics)
    return skew.join_few(customers, bad.select("member_id"), "member_id", parts, "left_anti").select(
        *customers.columns
    )
