"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditgrade.sources.sinks import write_parquet


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that the cluster names.

    Only a local session without such a setting falls back to a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="creditgrade-llm-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def mounted(path: str) -> str:
    """The plain file path of a shared folder that every machine has mounted."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        raise ValueError(
            f"{path}: models are memory-mapped, so spark.checkpoint.dir has to be a folder "
            "that all machines mount (file:/...)"
        )
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage.

    Rows are counted on the way there and back, so a lost file raises.
    """
    return write_parquet(df, scratch_path(df.sparkSession, name))


def in_every_shard(pieces_: DataFrame, n_shards: int, piece: bytes) -> DataFrame:
    """Rows of ``shard`` and ``piece`` with an empty piece for each shard.

    So the task of each shard runs and writes its files, and a file that is not there when it
    is read is a lost one: reading it raises.
    """
    spark = pieces_.sparkSession
    empty = spark.range(n_shards).select(F.col("id").cast("int").alias("shard"), F.lit(piece).alias("piece"))
    return pieces_.union(empty)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id's text, modulo ``divisor``; a null id counts as an empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor


def bounded_sample(rows: DataFrame, group: str, key: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows of each group, those with the smallest hashes of the key, with
    their number from 1 in ``n``.

    Groups are counted first, and of a large one only the rows whose hash lies below a limit
    are ranked: about twice as many as are asked for, however large the group is.
    """
    sizes = stored(rows.groupBy(group).agg(F.count("*").alias("_size")), "sample-sizes")
    place = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 31))
    near = rows.join(sizes, group).withColumn("_place", place)
    near = near.filter(F.col("_place") < F.lit(float(1 << 31)) * (2 * most + 200) / F.col("_size"))
    rank = f"row_number() OVER (PARTITION BY {group} ORDER BY _place, {key})"
    return near.withColumn("n", F.expr(rank)).filter(f"n <= {most}").drop("_place", "_size")


def utf8(column: str) -> Column:
    """A text column as UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def text_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column; sizes the number of shards."""
    total = df.agg(F.sum(F.octet_length(F.col(column).cast("string"))).alias("n")).first()["n"]
    return int(total or 0)


def shards_for(n_bytes: int, per_shard: int, least: int = 1) -> int:
    return max(least, ceil(n_bytes / per_shard))


def byte_rows(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary or string Arrow array in one buffer, and the row offsets into it."""
    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    wide = pa.types.is_large_binary(array.type) or pa.types.is_large_string(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    if data is None or not len(array):
        return np.empty(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return flat, offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the column holds about ``most`` bytes, one row at least."""
    for batch in batches:
        _, offsets = byte_rows(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def released(results: Iterator) -> Iterator:
    """The results of a task; then what Arrow keeps of freed batches goes back to the system.

    Python workers outlive their tasks, and several wait beside those that run: each would go
    on holding the memory of the largest batches that it has read.
    """
    yield from results
    pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit numbers (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@cache
def letter_table() -> np.ndarray:
    """For each code point its lower-case letter's code point, 0 for all but letters."""
    table = np.zeros(0x110000, np.int32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def save_array(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array as a whole: a task that is run again replaces it by an equal one."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as file:
        np.save(file, array)
    os.replace(part, f"{folder}/{name}.npy")


def mapped_array(path: str) -> np.ndarray:
    """A written array mapped into memory. No file stays open, however many arrays there are."""
    with pa.memory_map(path) as file:
        np.lib.format.read_magic(file)
        shape, _, kind = np.lib.format.read_array_header_1_0(file)
        start = file.tell()
        file.seek(0)
        data = file.read_buffer()
    return np.frombuffer(data, kind, shape[0], start)


def schema_text(df: DataFrame, columns: list[str]) -> str:
    """Columns with their types, as a schema for Arrow functions."""
    return ", ".join(f"`{name}` {df.schema[name].dataType.simpleString()}" for name in columns)
