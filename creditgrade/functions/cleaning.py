"""Value cleaning. Casts are lenient: text that does not parse becomes null."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditgrade.schema import EMPTY_DATE, LONG_STATE, OTHER_PURPOSE


def renamed(fields: Mapping[str, tuple[str, str]]) -> list[str]:
    """One SQL cast and alias per ``source: (target, type)`` entry."""
    return [
        f"try_cast(`{source}` AS {dtype}) AS `{target}`"
        for source, (target, dtype) in fields.items()
    ]


def digits_to_int(text: str) -> Column:
    """The digits of a text as a number: ``10+ years`` is 10, ``n/a`` is null."""
    return F.expr(f"try_cast(regexp_replace({text}, r'\\D', '') AS INT)")


def state_code(code: str) -> Column:
    """State codes of more than two characters become ``NA``; nulls stay."""
    return F.expr(f"IF(length({code}) > 2, '{LONG_STATE}', {code})")


def term_years(term: str) -> Column:
    """``36 months`` as whole years."""
    return F.expr(f"try_cast(try_cast(replace({term}, ' months', '') AS INT) / 12 AS INT)")


def allowed_or_other(value: str, allowed: Sequence[str], other: str = OTHER_PURPOSE) -> Column:
    """The value if it is in the list, else ``other`` (also for null)."""
    quoted = ", ".join(f"'{text}'" for text in allowed)
    return F.expr(f"IF({value} IN ({quoted}), {value}, '{other}')")


def real_date(text: str) -> Column:
    """Date text, null where the source wrote its empty-date mark."""
    return F.expr(f"nullif({text}, '{EMPTY_DATE}')")


def reconciled_total(total: str, principal: str, interest: str, late_fee: str) -> Column:
    """A zero total with principal paid is replaced by the sum of its parts."""
    return F.expr(
        f"IF({principal} <> 0 AND {total} = 0, {principal} + {interest} + {late_fee}, {total})"
    )


def whole_number(value: str) -> Column:
    """Truncated to int; null where that is not possible."""
    return F.expr(f"try_cast({value} AS INT)")


def whole_or_zero(value: str) -> Column:
    return F.expr(f"coalesce(try_cast({value} AS INT), 0)")


def is_delinquent(delinq_2yrs: str, mths_since_last_delinq: str) -> Column:
    return F.expr(f"{delinq_2yrs} > 0 OR {mths_since_last_delinq} > 0")


def has_public_record(pub_rec: str, bankruptcies: str, enquiries: str) -> Column:
    return F.expr(f"{pub_rec} > 0 OR {bankruptcies} > 0 OR {enquiries} > 0")


def present(text_columns: Sequence[str], number_columns: Sequence[str]) -> Column:
    """No null in any of the columns and no NaN in the numbers."""
    nulls = [f"{name} IS NOT NULL" for name in (*text_columns, *number_columns)]
    nans = [f"NOT isnan({name})" for name in number_columns]
    return F.expr(" AND ".join(nulls + nans))
