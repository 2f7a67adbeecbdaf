"""Curated tables stored by buckets of their key: joins and groupings by the key need no shuffle.

The files are plain Parquet. How they are cut is known to the catalog, so a folder that another
session wrote is registered with ``open_bucketed`` before it is read; ``_buckets.json`` beside
the files says how it was cut.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditgrade.operators.statistics import KeyStatistics
from creditgrade.sources.sinks import checked, smaller

BUCKETS = 200
_ABOUT = "_buckets.json"


def _about(spark: SparkSession, path: str) -> dict:
    lines = spark.read.option("wholetext", True).text(f"{path}{_ABOUT}").collect()
    return json.loads(lines[0]["value"])


def write_bucketed(
    df: DataFrame,
    path: str,
    table: str,
    key: str = "member_id",
    n_buckets: int = BUCKETS,
    statistics: KeyStatistics | None = None,
    heavy_rows: int = 1_000_000,
) -> DataFrame:
    """Write a table in buckets of its key, sorted by it, and return it as read from there.

    A bucket is one file, made by one task, unless ``statistics`` say that a key may have more
    than ``heavy_rows`` rows: then each task writes its own rows of a bucket. ``table`` is the
    name in the catalog; a table of that name is replaced, its files stay. The number of rows
    is checked on reading back. Null keys share a bucket.
    """
    spark = df.sparkSession
    written = Observation()
    heavy = statistics is not None and not statistics.never_above(key, 1, heavy_rows)
    dealt = df if heavy else df.repartition(n_buckets, key)
    counted = dealt.observe(written, F.count(F.lit(1)).alias("n_rows"))
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        counted.write.mode("errorifexists")
        .bucketBy(n_buckets, key)
        .sortBy(key)
        .options(path=path, **smaller(spark))
        .saveAsTable(table)
    )
    n_rows = written.get.get("n_rows", 0)
    about = {"key": key, "buckets": n_buckets, "rows": n_rows, "schema": df.schema.jsonValue()}
    lines = spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1)
    lines.write.mode("errorifexists").text(f"{path}{_ABOUT}")
    return checked(spark.table(table), n_rows, path)


def open_bucketed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Register a folder of ``write_bucketed`` in this session's catalog and read it."""
    about = _about(spark, path)
    schema = T.StructType.fromJson(about["schema"])
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{about['key']}`) "
        f"SORTED BY (`{about['key']}`) INTO {about['buckets']} BUCKETS LOCATION '{path}'"
    )
    return checked(spark.table(table), about["rows"], path)
