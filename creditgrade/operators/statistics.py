"""How many rows the keys of a table have, from a mergeable sketch; it chooses plans only.

Joins whose keys may be heavy are planned by row counts of their keys. Counting all keys of all
tables before every join costs a grouping each. The tables come from one set of rows, though,
and give a key no more rows than it has there. So these rows are sketched once: keys are dealt
over buckets by their hash, and each bucket gets a sketch of its frequent keys, which tasks
merge. The sketch's error is in proportion to the rows of the bucket, so the number of buckets
follows the number of rows and the error stays below the limit of interest. Only keys that may
lie above the limit are then counted exactly.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditgrade.sources.sinks import write_shared

# Keys with no more rows than this in any of four tables make a million rows at most.
LIMIT = 31
# So few that the sketch of a bucket is exact, but for buckets with very uneven shares of keys.
BUCKET_ROWS = 20_000
LISTED = 64
TRACKED = 16_384
# Fixed values of the sketch: its table is the next power of two above 4/3 of the tracked keys,
# exact while three quarters of it are filled, and off by 3.5 / its size of the rows otherwise.
_SLOTS = 32_768
_EXACT_KEYS = 24_576


@dataclass(frozen=True)
class KeyStatistics:
    """Bounds on the rows of the keys, by key column.

    No key has more rows than ``most``. Where that is above ``limit``, ``heavy`` has the keys
    with more than ``limit`` rows and their exact number ``n``.
    """

    limit: int
    most: Mapping[str, int]
    heavy: Mapping[str, DataFrame] = field(default_factory=dict)

    def never_above(self, key: str, tables: int, rows: int) -> bool:
        """Whether no key makes more than ``rows`` rows in a join of so many tables."""
        return key in self.most and self.most[key] ** tables <= rows

    def candidates(self, df: DataFrame, key: str, tables: int, rows: int) -> DataFrame:
        """The rows of keys that may make more than ``rows`` rows in a join of so many tables."""
        if key not in self.heavy or self.limit**tables > rows:
            return df
        listed = self.heavy[key].select(F.col(key).alias("_heavy"))
        return df.join(listed, F.col(key).eqNullSafe(F.col("_heavy")), "left_semi")


def _sketched(rows: DataFrame, keys: Mapping[str, str], n_buckets: int) -> DataFrame:
    """Per key column and bucket: ``top`` (hashes of frequent keys and their estimated rows),
    ``rest`` and ``highest``, which no other key and no key at all exceeds."""
    hashed = ", ".join(f"struct('{name}' AS name, xxhash64({key}) AS h)" for name, key in keys.items())
    return (
        rows.selectExpr(f"inline(array({hashed}))")
        .groupBy("name", F.expr(f"pmod(h, {n_buckets}) AS bucket"))
        .agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {LISTED}, {TRACKED})").alias("top"))
        .withColumn("estimates", F.expr("transform(top, t -> t.count)"))
        .withColumn(
            "rest",
            # A key that is not listed has at most twice the error, or less than the last listed.
            F.expr(
                f"greatest(IF(n <= {_EXACT_KEYS}, 0L, bigint(ceil(7 * n / {_SLOTS}))),"
                f" IF(size(top) = {LISTED}, array_min(estimates), 0L))"
            ),
        )
        .withColumn("highest", F.expr("greatest(rest, coalesce(array_max(estimates), 0L))"))
    )


def key_statistics(
    rows: DataFrame, keys: Mapping[str, str], limit: int = LIMIT, bucket_rows: int = BUCKET_ROWS
) -> KeyStatistics:
    """Statistics of key columns, given by their names and expressions over the rows.

    One job over the key columns, and a second one only if a key may have more than ``limit``
    rows. ``rows`` should be a stored table: its rows are counted from the files' footers. A
    null key is a key. Without rows no key has any.
    """
    n_buckets = max(1, -(-rows.count() // bucket_rows))
    sketched = _sketched(rows, keys, n_buckets)
    found = sketched.groupBy("name").agg(F.max("highest").alias("highest")).collect()
    most = {name: 0 for name in keys} | {row["name"]: int(row["highest"]) for row in found}
    heavy = {}
    for name, key in keys.items():
        if most[name] <= limit:
            continue
        suspects = sketched.filter((F.col("name") == name) & (F.col("highest") > limit)).selectExpr(
            "bucket", f"rest > {limit} AS every", f"transform(filter(top, t -> t.count > {limit}), t -> t.item) AS listed"
        )
        hashed = rows.selectExpr(f"{key} AS {name}", f"xxhash64({key}) AS _h", f"pmod(xxhash64({key}), {n_buckets}) AS bucket")
        counted = (
            hashed.join(suspects, "bucket")
            .filter("every OR array_contains(listed, _h)")
            .groupBy(name)
            .agg(F.count("*").alias("n"))
        )
        heavy[name] = write_shared(counted.filter(f"n > {limit}"), "heavy-keys")
    return KeyStatistics(limit, most, heavy)


def application_statistics(keyed: DataFrame, limit: int = LIMIT) -> KeyStatistics:
    """Statistics of the member key and the loan id of raw applications."""
    return key_statistics(keyed, {"member_id": "member_id", "loan_id": "string(id)"}, limit)
