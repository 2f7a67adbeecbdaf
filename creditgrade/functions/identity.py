"""The member key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditgrade.schema import MEMBER_KEY_COLUMNS, MEMBER_KEY_NUMBERS, MEMBER_KEY_SEPARATOR


def member_key(columns: Sequence[str] = MEMBER_KEY_COLUMNS) -> Column:
    """SHA-256 (64 hex digits) over the columns' text; nulls are left out of the text.

    The income counts as a double, whatever type the source gives it: 5000 is ``5000.0``,
    and from ten million on the text is ``1.0E7``. So all source formats give one key.
    Income that is no number is null.
    """
    text = ", ".join(
        f"string(try_cast({name} AS DOUBLE))" if name in MEMBER_KEY_NUMBERS else f"string({name})"
        for name in columns
    )
    return F.expr(f"sha2(concat_ws('{MEMBER_KEY_SEPARATOR}', {text}), 256)")


def packed_key(name: str) -> Column:
    """A text key as bytes, for shuffles: lower-case hex digits take half the room there.

    The first byte tells how the rest is to be read, so different keys never become one.
    """
    return F.expr(
        f"IF(lower(hex(unhex({name}))) = {name}, concat(X'01', unhex({name})),"
        f" concat(X'00', CAST({name} AS BINARY)))"
    )


def unpacked_key(name: str) -> Column:
    """The text of a ``packed_key``."""
    rest = f"substring({name}, 2)"
    return F.expr(f"IF(substring({name}, 1, 1) = X'01', lower(hex({rest})), CAST({rest} AS STRING))")
