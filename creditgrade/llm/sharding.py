"""Jump consistent hashing: stable keys to shards without a ring table.

A key's shard depends on the key and the number of shards only. Going from n to n + 1
shards, a key either stays or moves to the new shard, and 1/(n + 1) of the keys move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BUCKET = 50_000
# Fixed values of the published algorithm: its linear congruential generator.
_LCG = 2862933555777941757
_TOP = float(1 << 31)


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key, all keys jumping in step.

    A key's pseudo-random sequence says at which shard counts it moves on; the last such
    count within ``n_shards`` is its shard. Needs O(log n_shards) rounds.
    """
    if n_shards < 1:
        raise ValueError("there has to be one shard at least")
    state = keys.astype(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    target = np.zeros(len(state), np.int64)
    while len(moving):
        shard[moving] = target
        with np.errstate(over="ignore"):
            state[moving] = state[moving] * np.uint64(_LCG) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        target = ((shard[moving] + 1) * (_TOP / draw)).astype(np.int64)
        ahead = target < n_shards
        moving, target = moving[ahead], target[ahead]
    return shard


def stable_key(column: str) -> Column:
    """A 64-bit key of any column: the hash of its text, a null hashing as such."""
    return F.xxhash64(F.col(column).cast("string"))


def shard_of(key: Column, n_shards: int) -> Column:
    @F.pandas_udf(T.IntegerType())
    def jump(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), n_shards), dtype="int32")

    return jump(key)


def assign_shards(df: DataFrame, key: str, n_shards: int, name: str = "shard") -> DataFrame:
    """Add each row's shard; a column of that name is replaced.

    Equal keys share a shard, null keys too. No shuffle: the shard follows from the row.
    """
    return df.withColumn(name, shard_of(stable_key(key), n_shards))


def with_slots(df: DataFrame, shard: str, order: list[str], name: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    A shard is not sorted in one task: its rows are dealt over hash buckets of about
    ROWS_PER_BUCKET rows, the buckets' counts give each bucket its first number, and rows
    are numbered by ``order`` inside the bucket. Rows that are equal in ``order`` are
    numbered in any order; other rows get the same number on every run.
    """
    n_buckets = max(1, -(-df.count() // ROWS_PER_BUCKET))
    bucket = F.pmod(F.xxhash64(*order), F.lit(n_buckets)).alias("_bucket")
    first = (
        df.select(shard, bucket)
        .groupBy(shard, "_bucket")
        .agg(F.count("*").alias("_n"))
        .selectExpr(
            f"{shard} AS _shard", "_bucket AS _of",
            f"sum(_n) OVER (PARTITION BY {shard} ORDER BY _bucket) - _n AS _first",
        )
    )
    columns = [F.col(column) for column in df.columns if column != name]
    ordering = ", ".join(f"`{column}`" for column in order)
    numbered = df.select(*columns, bucket).withColumn(
        "_rank",
        F.expr(f"row_number() OVER (PARTITION BY {shard}, _bucket ORDER BY {ordering}) - 1"),
    )
    return numbered.join(
        first, (F.col(shard) == F.col("_shard")) & (F.col("_bucket") == F.col("_of"))
    ).select(*columns, (F.col("_first") + F.col("_rank")).alias(name))
