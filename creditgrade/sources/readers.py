"""Sources of raw applications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditgrade.schema import RAW_COLUMNS, RAW_TEXT_SCHEMA
from creditgrade.sources.sinks import write_parquet

_LINE, REJECTED = "_line", "csv_rejected"
# Quoted parts of a line; a quote is doubled or follows a backslash.
_QUOTED = r'"(?:[^"\\\\]|\\\\.|"")*"'


def read_csv(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """Delimited text with a header, one application per line.

    By default the used columns are picked from the file by name and read as
    text, which takes a single look at the header instead of a pass over all
    data. ``infer_schema=True`` spends that pass and keeps every column.
    """
    reader = spark.read.option("header", True)
    if infer_schema:
        return reader.option("inferSchema", True).csv(path)
    as_text = reader.csv(path)
    return as_text.select(
        *(
            F.col(field.name).try_cast(field.dataType).alias(field.name)
            for field in RAW_TEXT_SCHEMA
        )
    )


def ingest_csv(spark: SparkSession, path: str, output: str) -> tuple[DataFrame, DataFrame]:
    """Convert delimited text to Parquet in one read; malformed lines are kept apart.

    Returns the applications, with all columns of the header as text, and the rejected lines:
    ``reason`` (``too few fields``, ``too many fields``, ``open quote`` or ``malformed``),
    ``line`` and ``n_lines``, the number of such lines. Rejected is what does not have one
    value for each name in the header; ``read_csv`` would fill or cut such lines. Every line
    but headers and empty lines is in one of the two. Files have equal headers.
    """
    names = spark.read.option("header", True).csv(path).columns
    taken = {_LINE, REJECTED} & set(names)
    if taken:
        raise ValueError(f"reserved column names: {sorted(taken)}")
    fields = ", ".join(f"`{name}` STRING" for name in names)
    parsed = (
        spark.read.schema(f"{fields}, {_LINE} STRING")
        .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE)
        .csv(path)
        .withColumn(REJECTED, F.col(_LINE).isNotNull())
    )
    there = write_parquet(parsed, output, partition_by=[REJECTED])
    plain = f"regexp_replace({_LINE}, '{_QUOTED}', '')"
    n_fields = f"(length({plain}) - length(replace({plain}, ',', '')) + 1)"
    reason = f"""CASE WHEN contains({plain}, '"') THEN 'open quote'
        WHEN {n_fields} < {len(names)} THEN 'too few fields'
        WHEN {n_fields} > {len(names)} THEN 'too many fields' ELSE 'malformed' END"""
    rejected = there.filter(REJECTED).selectExpr(f"{reason} AS reason", f"{_LINE} AS line")
    return (
        there.filter(f"NOT {REJECTED}").select(*(f"`{name}`" for name in names)),
        rejected.groupBy("reason", "line").agg(F.count("*").alias("n_lines")),
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet applications; only the used columns are named in the scan."""
    return spark.read.parquet(path).select(*RAW_COLUMNS)


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make the table available to SQL under a name, and return it."""
    df.createOrReplaceTempView(name)
    return df
