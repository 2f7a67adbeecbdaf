"""The member key column and the four projections of the raw table.

What each table takes is listed once, as the keys of its fields in ``schema.py``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditgrade.functions.identity import member_key
from creditgrade.schema import (
    COUNTRY,
    CUSTOMER_FIELDS,
    DEFAULTER_FIELDS,
    LOAN_FIELDS,
    RAW_COLUMNS,
    REPAYMENT_FIELDS,
)


def with_member_id(raw: DataFrame) -> DataFrame:
    """The raw table with its member key, which is made once only."""
    return raw if "member_id" in raw.columns else raw.withColumn("member_id", member_key())


def keyed_applications(raw: DataFrame) -> DataFrame:
    """The used columns of the raw table with the member key."""
    return with_member_id(raw).select("member_id", *RAW_COLUMNS)


def _projected(keyed: DataFrame, fields: Iterable[str]) -> DataFrame:
    made = {"loan_id": F.col("id").alias("loan_id"), "country": F.lit(COUNTRY).alias("country")}
    columns: list[str | Column] = [made.get(name, name) for name in fields]
    return keyed.select(*columns)


def customers(keyed: DataFrame) -> DataFrame:
    return _projected(keyed, CUSTOMER_FIELDS)


def loans(keyed: DataFrame) -> DataFrame:
    return _projected(keyed, LOAN_FIELDS)


def repayments(keyed: DataFrame) -> DataFrame:
    return _projected(keyed, REPAYMENT_FIELDS)


def defaulters(keyed: DataFrame) -> DataFrame:
    return _projected(keyed, DEFAULTER_FIELDS)
