"""The five cleaned tables, each from its projection of the raw table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditgrade.functions import cleaning as clean
from creditgrade.schema import (
    CUSTOMER_FIELDS,
    DEFAULTER_FIELDS,
    LOAN_FIELDS,
    LOAN_PURPOSES,
    REPAYMENT_FIELDS,
    REQUIRED_LOAN_COLUMNS,
    REQUIRED_REPAYMENT_COLUMNS,
)

INGEST_COLUMN = "ingest_date"
# What observes the rows of a table before its filters.
Seen = Callable[[DataFrame], DataFrame]


def rename_and_cast(df: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*clean.renamed(fields))


def stamp_ingest(df: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Add the ingest time, by default the start time of the query."""
    return df.withColumn(
        INGEST_COLUMN, F.current_timestamp() if ingest_time is None else ingest_time
    )


def floor_mean(df: DataFrame, column: str) -> DataFrame:
    """The rounded-down mean of a column, as a one-row table."""
    return df.agg(F.floor(F.avg(column)).alias(column))


def fill_with_floor_mean(df: DataFrame, column: str) -> DataFrame:
    """Fill nulls of an int column with its rounded-down mean, if there is one.

    The mean is a scalar subquery: it stays in the plan, and is not computed
    when the column is not needed.
    """
    return fill_with(df, column, floor_mean(df, column))


def fill_with(df: DataFrame, column: str, mean: DataFrame) -> DataFrame:
    """Fill nulls of an int column with the value of a one-row table."""
    return df.withColumn(column, F.coalesce(F.col(column), mean.scalar().cast("int")))


def fill_with_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Truncate columns to int, with 0 for null."""
    return df.withColumns({name: clean.whole_or_zero(name) for name in columns})


def with_income(customers: DataFrame) -> DataFrame:
    return customers.filter("annual_income IS NOT NULL")


def complete_loans(loans: DataFrame) -> DataFrame:
    return loans.na.drop(subset=list(REQUIRED_LOAN_COLUMNS))


def complete_repayments(repayments: DataFrame) -> DataFrame:
    return repayments.na.drop(subset=list(REQUIRED_REPAYMENT_COLUMNS))


def with_reconciled_total(repayments: DataFrame) -> DataFrame:
    return repayments.withColumn(
        "total_payment_received",
        clean.reconciled_total(
            "total_payment_received",
            "total_principal_received",
            "total_interest_received",
            "total_late_fee_received",
        ),
    )


def with_payment(repayments: DataFrame) -> DataFrame:
    return repayments.filter("total_payment_received <> 0")


def distinct_customers(customers: DataFrame) -> DataFrame:
    """Customer rows once each; copies are merged before the shuffle."""
    return rename_and_cast(customers, CUSTOMER_FIELDS).distinct()


def numbered_employment(customers: DataFrame) -> DataFrame:
    return customers.withColumn("emp_length", clean.digits_to_int("emp_length"))


def mean_employment(different: DataFrame) -> DataFrame:
    """The mean that fills employment years: that of the different customers with an income."""
    return floor_mean(numbered_employment(with_income(different)), "emp_length")


def clean_different(different: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """``clean_customers`` of stored ``distinct_customers``."""
    rows = numbered_employment(with_income(different))
    return finished_customers(rows, mean_employment(different), ingest_time)


def clean_customers(
    customers: DataFrame, ingest_time: Column | None = None, seen: Seen | None = None
) -> DataFrame:
    # The time is the same for all rows, so it can be added after the distinct.
    distinct = distinct_customers(customers)
    rows = numbered_employment(with_income(distinct))
    mean = floor_mean(rows, "emp_length")
    if seen:
        rows = numbered_employment(with_income(seen(distinct)))
    return finished_customers(rows, mean, ingest_time)


def finished_customers(
    rows: DataFrame, mean: DataFrame, ingest_time: Column | None = None
) -> DataFrame:
    """Numbered customers with an income, their gaps filled, in their final form."""
    filled = fill_with(rows, "emp_length", mean)
    return stamp_ingest(
        filled.withColumn("address_state", clean.state_code("address_state")), ingest_time
    )


def clean_loans(
    loans: DataFrame, ingest_time: Column | None = None, seen: Seen | None = None
) -> DataFrame:
    typed = rename_and_cast(loans, LOAN_FIELDS)
    rows = stamp_ingest(complete_loans(seen(typed) if seen else typed), ingest_time)
    return rows.withColumns(
        {
            "loan_purpose": clean.allowed_or_other("loan_purpose", LOAN_PURPOSES),
            "loan_term_years": clean.term_years("loan_term_months"),
        }
    ).drop("loan_term_months")


def clean_repayments(
    repayments: DataFrame, ingest_time: Column | None = None, seen: Seen | None = None
) -> DataFrame:
    typed = rename_and_cast(repayments, REPAYMENT_FIELDS)
    complete = complete_repayments(seen(typed) if seen else typed)
    paid = with_payment(with_reconciled_total(complete))
    return stamp_ingest(
        paid.withColumns(
            {
                name: clean.real_date(name)
                for name in ("last_payment_date", "next_payment_date")
            }
        ),
        ingest_time,
    )


def clean_delinquency(defaulters: DataFrame, seen: Seen | None = None) -> DataFrame:
    """Members with a delinquency in the last two years or a dated earlier one."""
    rows = rename_and_cast(defaulters, DEFAULTER_FIELDS)
    typed = fill_with_zero(seen(rows) if seen else rows, ["delinq_2yrs"])
    return (
        typed.withColumn("mths_since_last_delinq", clean.whole_number("mths_since_last_delinq"))
        .filter(clean.is_delinquent("delinq_2yrs", "mths_since_last_delinq"))
        .select("member_id", "delinq_2yrs", "delinq_amnt", "mths_since_last_delinq")
    )


RECORD_COLUMNS = ("pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")


def clean_records(defaulters: DataFrame, seen: Seen | None = None) -> DataFrame:
    """Public records and enquiries: one row per raw row, none left out."""
    typed = rename_and_cast(defaulters, DEFAULTER_FIELDS)
    return fill_with_zero(seen(typed) if seen else typed, RECORD_COLUMNS).select("member_id", *RECORD_COLUMNS)


def enquiry_members(defaulters: DataFrame) -> DataFrame:
    """Members of rows with any public record, bankruptcy or enquiry."""
    typed = rename_and_cast(defaulters, DEFAULTER_FIELDS)
    return typed.filter(clean.has_public_record(*RECORD_COLUMNS)).select("member_id")
