"""A Bloom filter of wanted keys: rows that cannot join are left out before they are shuffled.

The filter is a table of 64-bit words. A key's hash names one word and three of its bits, and a
row passes if these bits are set. It may let unwanted rows pass (about one in thirty), so the
exact join follows; it never stops a wanted one. The table is broadcast, so it is made only for
so many keys that its size is bounded; beyond that the join goes without.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 12
# 750,000 words of 16 bytes at this number.
MAX_KEYS = 4_000_000
_WORD, _BITS = "_wanted_word", "_wanted_bits"


@dataclass(frozen=True)
class WantedKeys:
    """The filter's words, or None where there would be too many."""

    words: DataFrame | None
    n_words: int

    def keep(self, df: DataFrame, key: str) -> DataFrame:
        """The rows whose key may be wanted; rows with a null key go."""
        if self.words is None:
            return df
        place = F.pmod(F.xxhash64(key), F.lit(self.n_words))
        found = df.filter(F.col(key).isNotNull()).join(F.broadcast(self.words), place == F.col(_WORD))
        return found.filter(F.col(_BITS).bitwiseAND(_mask(key)) == _mask(key)).select(*df.columns)

    def split(self, df: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
        """The rows whose key may be wanted or is null, and all others; None if that is unknown."""
        if self.words is None:
            return df, None
        place = F.pmod(F.xxhash64(key), F.lit(self.n_words))
        found = df.join(F.broadcast(self.words), place == F.col(_WORD), "left")
        bits = F.coalesce(F.col(_BITS), F.lit(0))
        likely = F.col(key).isNull() | (bits.bitwiseAND(_mask(key)) == _mask(key))
        return found.filter(likely).select(*df.columns), found.filter(~likely).select(*df.columns)


def _mask(key: str) -> Column:
    """Three bits of a word, which may coincide."""
    bits = [
        F.expr(f"shiftleft(1L, int(pmod(shiftright(xxhash64(1, `{key}`), {shift}), 64)))")
        for shift in (0, 16, 32)
    ]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def wanted_keys(keys: DataFrame, key: str) -> WantedKeys:
    """The filter of a stored table's keys; copies and nulls do no harm."""
    n_keys = keys.count()
    n_words = max(1, -(-n_keys * BITS_PER_KEY // 64))
    if n_keys > MAX_KEYS:
        return WantedKeys(None, n_words)
    place = F.pmod(F.xxhash64(key), F.lit(n_words)).alias(_WORD)
    own = keys.filter(F.col(key).isNotNull()).select(place, _mask(key).alias("bits"))
    return WantedKeys(own.groupBy(_WORD).agg(F.bit_or("bits").alias(_BITS)), n_words)
