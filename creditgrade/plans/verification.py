"""The wide verification table: row by row, with counted rows, or factorised.

Its rows per member are the product of the member's rows in five tables. The factorised form
holds the factors: it is linear in the input, and ``expanded`` gives the rows when they are
wanted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditgrade.functions.identity import packed_key, unpacked_key
from creditgrade.operators import skew
from creditgrade.operators.statistics import KeyStatistics
from creditgrade.schema import (
    VERIFICATION_CUSTOMER_COLUMNS,
    VERIFICATION_DELINQUENCY_COLUMNS,
    VERIFICATION_LOAN_COLUMNS,
    VERIFICATION_LOAN_KEY,
    VERIFICATION_RECORD_COLUMNS,
    VERIFICATION_REPAYMENT_COLUMNS,
)

# Different rows of one table that one factorised row holds.
ARRAY_ROWS = 4096
_COLUMNS = (
    *VERIFICATION_LOAN_KEY,
    *VERIFICATION_CUSTOMER_COLUMNS,
    *VERIFICATION_LOAN_COLUMNS,
    *VERIFICATION_REPAYMENT_COLUMNS,
    *VERIFICATION_DELINQUENCY_COLUMNS,
    *VERIFICATION_RECORD_COLUMNS,
)


def _joined(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    delinquency: DataFrame,
    records: DataFrame,
    rows_per_task: int,
    statistics: KeyStatistics | None,
    count_all: bool,
) -> tuple[DataFrame, bool]:
    """The table with the number of its equal rows, and whether there are crowded keys.

    Copies are counted where keys are crowded, or everywhere with ``count_all``.
    """
    owned_loans = loans.select("loan_id", "member_id", *VERIFICATION_LOAN_COLUMNS)
    paid = repayments.select("loan_id", *VERIFICATION_REPAYMENT_COLUMNS)
    if count_all:
        owned_loans, paid = (skew.merged_by(table, "loan_id", statistics) for table in (owned_loans, paid))
    paid_loans, crowded = skew.counted_join(
        owned_loans, [paid], "loan_id", "left", rows_per_task, statistics
    )
    # A member's loans with their repayments are the most rows that a task would hold of it.
    if (
        skew.dealt_at_once("member_id", 4, rows_per_task, statistics)
        and statistics.never_above("loan_id", 1, skew.ROWS_PER_TASK // max(1, statistics.most["member_id"]))
    ):
        tables = [
            customers.select(*VERIFICATION_CUSTOMER_COLUMNS),
            paid_loans,
            delinquency.select("member_id", *VERIFICATION_DELINQUENCY_COLUMNS),
            records.select("member_id", *VERIFICATION_RECORD_COLUMNS),
        ]
        # Null keys become bytes that no key is packed to, other ones in the customers than in the
        # rest: they meet nothing, and no filter of theirs makes the customers' rows be read anew.
        packed = [
            table.withColumn("member_id", F.coalesce(packed_key("member_id"), F.lit(b"" if n == 0 else b"\x02")))
            for n, table in enumerate(tables)
        ]
        joined = skew.dealt_join(packed[0], packed[1:], "member_id", "left", rows_per_task)
        joined = joined.withColumn(
            "member_id", F.when(F.octet_length("member_id") > 0, unpacked_key("member_id"))
        )
        return joined.selectExpr(*_COLUMNS, skew.TIMES), True
    # What repayments add to a member's loans has been looked at above, by loan id.
    owned = [table.select("member_id") for table in (customers, loans, delinquency, records)]
    parts = skew.crowded_keys(owned, "member_id", rows_per_task, "left", statistics)
    tables = [
        customers.select(*VERIFICATION_CUSTOMER_COLUMNS),
        paid_loans,
        delinquency.select("member_id", *VERIFICATION_DELINQUENCY_COLUMNS),
        records.select("member_id", *VERIFICATION_RECORD_COLUMNS),
    ]
    crowded = crowded or parts is not None
    if crowded:
        tables = [skew.write_shared(skew.merged(table), "merged") for table in tables]
        parts = skew.crowded_keys(tables, "member_id", rows_per_task, "left")
    elif count_all:
        # The joined loans are different rows already, as loans and repayments were.
        tables = [
            table if table is paid_loans else skew.merged_by(table, "member_id", statistics) for table in tables
        ]
    joined = skew.star_join(tables[0], tables[1:], "member_id", parts, "left")
    return joined.selectExpr(*_COLUMNS, skew.TIMES), crowded


def verification_counted(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    delinquency: DataFrame,
    records: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
    factorised: DataFrame | None = None,
) -> DataFrame:
    """Different rows of the verification table with the number of times each is there, in
    ``_times``.

    Copies of a member's records become counts before they are joined: a member with many
    copies of one application has one row here. Repayments join their loans first, so that
    the other three tables need only one shuffle by member. Where the factorised form of the
    same tables is stored, it is given as ``factorised``: its rows are combined where they lie.
    """
    if factorised is not None:
        return _combinations(factorised, True)
    tables = (customers, loans, repayments, delinquency, records)
    return _joined(*tables, rows_per_task, statistics, True)[0]


def verification(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    delinquency: DataFrame,
    records: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame:
    """Customers with all combinations of their loans, repayments and incidents.

    Written out row by row; the rows of a member grow with the fourth power of its
    applications. ``verification_counted`` and ``verification_factorised`` hold the same.
    """
    tables = (customers, loans, repayments, delinquency, records)
    counted, crowded = _joined(*tables, rows_per_task, statistics, False)
    # Where nothing is crowded, nothing has been counted: all rows are there once.
    return skew.repeat_rows(counted) if crowded else counted.drop(skew.TIMES)


def _crowded_arrays(
    tables: Sequence[DataFrame], key: str, most: int, statistics: KeyStatistics | None
) -> DataFrame | None:
    """Keys with more than ``most`` different rows in any table, with the parts of each table
    as ``skew.with_cells`` takes them; None if there are none."""
    if statistics is not None and statistics.never_above(key, 1, most):
        return None
    numbers = range(len(tables))
    tagged = [table.selectExpr(key, *(f"{int(n == m)} AS n{m}" for m in numbers)) for n, table in enumerate(tables)]
    counts = reduce(DataFrame.union, tagged).groupBy(key).agg(*(F.expr(f"sum(n{n}) AS n{n}") for n in numbers))
    many = counts.filter(" OR ".join(f"n{n} > {most}" for n in numbers)).selectExpr(
        key, *(f"greatest(1L, bigint(ceil(n{n} / {most}))) AS p{n}" for n in numbers)
    )
    found = skew.write_shared(many, "crowded-arrays")
    return None if found.isEmpty() else found


def _as_array(df: DataFrame, keys: Sequence[str], name: str, kept: Sequence[str] = ()) -> DataFrame:
    """The rows of each group as one array of structs; ``kept`` columns are the same in a group."""
    inside = [column for column in df.columns if column not in (*keys, *kept)]
    return df.groupBy(*keys).agg(
        F.collect_list(F.struct(*inside)).alias(name), *(F.any_value(c).alias(c) for c in kept)
    )


def verification_factorised(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    delinquency: DataFrame,
    records: DataFrame,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
    array_rows: int = ARRAY_ROWS,
) -> DataFrame:
    """The verification table as its factors: ``member_id`` and the arrays ``customers``,
    ``loans`` (each with its ``repayments``), ``delinquency`` and ``records``.

    Elements are different rows with their number in ``_times``, so a member with very many
    copies of one application is one small row. A member has one row, unless it has more than
    ``array_rows`` different rows in a table: these are dealt over several arrays, and each
    combination of arrays is a row. So are the repayments of a loan, which then has several
    elements. Arrays without rows are null. The size is in proportion to the different rows
    of the tables, but for loan ids that several loans share: each holds the repayments.
    """
    paid = skew.merged_by(
        repayments.select("loan_id", *VERIFICATION_REPAYMENT_COLUMNS), "loan_id", statistics
    )
    parts = _crowded_arrays([paid], "loan_id", array_rows, statistics)
    if parts is None:
        paid = _as_array(paid, ["loan_id"], "repayments")
    else:
        dealt = skew.with_cells(paid, "loan_id", parts.selectExpr("loan_id", "p0", "1L AS p1"), 0)
        paid = _as_array(dealt.drop("p1"), ["loan_id", skew.CELL], "repayments").drop(skew.CELL)
    owned_loans = skew.merged_by(
        loans.select("loan_id", "member_id", *VERIFICATION_LOAN_COLUMNS), "loan_id", statistics
    )
    by_loan = skew.crowds(owned_loans, "loan_id", rows_per_task, statistics)
    owned_loans = skew.join_few(owned_loans, paid, "loan_id", by_loan, "left")

    names = ["customers", "loans", "delinquency", "records"]
    tables = [
        skew.merged_by(customers.select(*VERIFICATION_CUSTOMER_COLUMNS), "member_id", statistics),
        owned_loans,
        skew.merged_by(delinquency.select("member_id", *VERIFICATION_DELINQUENCY_COLUMNS), "member_id", statistics),
        skew.merged_by(records.select("member_id", *VERIFICATION_RECORD_COLUMNS), "member_id", statistics),
    ]
    parts = _crowded_arrays(tables, "member_id", array_rows, statistics)
    if parts is None:
        arrays = [_as_array(table, ["member_id"], name) for table, name in zip(tables, names, strict=True)]
        return reduce(lambda left, arm: left.join(arm, "member_id", "left"), arrays)
    cells = [skew.with_cells(table, "member_id", parts, n) for n, table in enumerate(tables)]
    others = [f"p{n}" for n in range(1, len(tables))]
    keys = ["member_id", skew.CELL]
    arrays = [
        _as_array(cell, keys, name, others if n == 0 else ())
        for n, (cell, name) in enumerate(zip(cells, names, strict=True))
    ]
    joined = reduce(lambda left, arm: left.join(arm, keys, "left"), arrays)
    # A part that got no rows has no partners; the member's other parts have them.
    whole = [f"({name} IS NOT NULL OR p{n} = 1)" for n, name in enumerate(names) if n]
    return joined.filter(" AND ".join(whole)).select("member_id", *names)


def _owned(factorised: DataFrame) -> DataFrame:
    """Each customer of a member with each of its loans, and the member's other arrays."""
    people = factorised.selectExpr("member_id", "explode(customers) AS c", "loans", "delinquency", "records")
    return people.selectExpr("member_id", "c", "explode_outer(loans) AS l", "delinquency", "records")


def expanded(factorised: DataFrame, spread: bool = True) -> DataFrame:
    """The rows of the verification table from its factors.

    With ``spread``, the combinations of customers and loans of one member, and the copies of
    one row, are made by several tasks where there are very many.
    """
    return skew.repeat_rows(_combinations(factorised, spread), spread=spread)


def _combinations(factorised: DataFrame, spread: bool) -> DataFrame:
    """Different rows of the verification table with their number, from its factors."""
    if spread:
        # Only what one task should not make is dealt anew: a pair of customer and loan takes the
        # member's other arrays with it.
        factors = ("customers", "delinquency", "records")
        sizes = [f"greatest(double(coalesce(size({name}), 1)), 1)" for name in factors]
        paid = "coalesce(aggregate(loans, 0D, (n, l) -> n + greatest(coalesce(size(l.repayments), 1), 1)), 1)"
        many = f"{' * '.join(sizes)} * greatest({paid}, 1) > {skew.ROWS_PER_TASK}"
        owned = _owned(factorised.filter(f"NOT ({many})")).union(
            _owned(factorised.filter(many)).hint("rebalance")
        )
    else:
        owned = _owned(factorised)
    rows = (
        owned.selectExpr("member_id", "c", "l", "explode_outer(l.repayments) AS r", "delinquency", "records")
        .selectExpr("member_id", "c", "l", "r", "explode_outer(delinquency) AS d", "records")
        .selectExpr("member_id", "c", "l", "r", "d", "explode_outer(records) AS e")
    )
    times = " * ".join(f"coalesce({arm}.{skew.TIMES}, 1L)" for arm in "clrde")
    own = [f"c.{name}" for name in VERIFICATION_CUSTOMER_COLUMNS if name != "member_id"]
    return rows.selectExpr(
        *(f"l.{name}" for name in VERIFICATION_LOAN_KEY),
        "member_id",
        *own,
        *(f"l.{name}" for name in VERIFICATION_LOAN_COLUMNS),
        *(f"r.{name}" for name in VERIFICATION_REPAYMENT_COLUMNS),
        *(f"d.{name}" for name in VERIFICATION_DELINQUENCY_COLUMNS),
        *(f"e.{name}" for name in VERIFICATION_RECORD_COLUMNS),
        f"{times} AS {skew.TIMES}",
    ).select(*_COLUMNS, skew.TIMES)
