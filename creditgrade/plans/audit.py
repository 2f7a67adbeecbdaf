"""How many rows each filter leaves, counted while the tables are written.

Each cleaned table is observed once, where its rows are renamed and cast, before its filters:
one metric counts all rows, and one for each filter those that pass it and the ones before. So
the audit costs no other scan. Customers are observed after their copies are gone, that is
behind the shuffle, so a map task that is run again counts nothing twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditgrade.functions import cleaning as clean
from creditgrade.schema import (
    LOAN_TEXT_COLUMNS,
    REQUIRED_LOAN_COLUMNS,
    REQUIRED_REPAYMENT_COLUMNS,
)

SCHEMA = "table_name string, step int, filter_name string, n_rows long"
ROWS = "rows"


def _filters(table: str) -> dict[str, Column]:
    """The filters of a cleaned table, in their order, over its renamed and cast rows."""
    if table == "customers":
        return {"income_present": F.col("annual_income").isNotNull()}
    if table == "loans":
        numbers = [name for name in REQUIRED_LOAN_COLUMNS if name not in LOAN_TEXT_COLUMNS]
        return {"complete": clean.present(LOAN_TEXT_COLUMNS, numbers)}
    if table == "repayments":
        total = clean.reconciled_total(
            "total_payment_received",
            "total_principal_received",
            "total_interest_received",
            "total_late_fee_received",
        )
        return {"complete": clean.present((), REQUIRED_REPAYMENT_COLUMNS), "paid": total != 0}
    if table == "delinquency":
        years = "coalesce(try_cast(delinq_2yrs AS INT), 0)"
        return {
            "delinquent": clean.is_delinquent(years, "try_cast(mths_since_last_delinq AS INT)")
        }
    return {}


class Audit:
    """Observes tables on their way; the counts are there once the tables were written."""

    def __init__(self) -> None:
        self._observed: dict[str, tuple[list[str], Observation]] = {}

    def seen(self, df: DataFrame, table: str) -> DataFrame:
        """The same rows, counted when they are written. A table is observed once."""
        if table in self._observed:
            raise ValueError(f"{table} is observed already")
        passing, counts = F.lit(True), [F.count(F.lit(1)).alias(ROWS)]
        for name, condition in _filters(table).items():
            passing = passing & condition
            counts.append(F.count_if(passing).alias(name))
        self._observed[table] = [ROWS, *_filters(table)], Observation()
        return df.observe(self._observed[table][1], *counts)

    def counts(self, spark: SparkSession) -> DataFrame:
        """A row per table and filter: the rows left after it; step 0 has all rows.

        Waits for tables that were not written yet. An empty table has zeros.
        """
        rows = [
            (table, step, name, observed.get.get(name, 0))
            for table, (names, observed) in self._observed.items()
            for step, name in enumerate(names)
        ]
        return spark.createDataFrame(rows, SCHEMA)
