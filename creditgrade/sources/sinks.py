"""Sinks for curated and scored tables, and the shared folder for tables on the way."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_folder: list[str] = []


class LostRows(RuntimeError):
    """A table does not read back as it was written."""


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the shared folder that the cluster names.

    A machine's own folder is used only where there is but one machine and no setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        if not _local_folder:
            _local_folder.append(tempfile.mkdtemp(prefix="creditgrade-"))
            atexit.register(shutil.rmtree, _local_folder[0], ignore_errors=True)
        base = _local_folder[0]
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def checked(df: DataFrame, n_rows: int, path: str) -> DataFrame:
    """The table, if it has as many rows as were written; lost files would go unnoticed."""
    found = df.count()
    if found != n_rows:
        raise LostRows(f"{path}: {n_rows} rows were written and {found} are there")
    return df


def smaller(spark: SparkSession) -> dict[str, str]:
    """The codec of Parquet files: what the session sets, else one that makes small files."""
    return {"compression": spark.conf.get("spark.sql.parquet.compression.codec", "zstd")}


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write as Parquet and return the table as read back from there, all rows of it.

    Rows are counted while they are written, and again in the files' footers.
    """
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("n_rows"))
    counted.write.mode(mode).options(**smaller(df.sparkSession)).partitionBy(*partition_by).parquet(path)
    there = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    if mode == "append":
        return there
    return checked(there, written.get.get("n_rows", 0), path)


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later steps use to the shared folder; cuts the lineage."""
    return write_parquet(df, f"{shared_folder(df.sparkSession)}-{name}")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write as delimited text with a header and return the table as read back."""
    # Leading blanks are part of the values, as in " 36 months".
    as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(header=True, **as_is).csv(path)
    return df.sparkSession.read.schema(df.schema).options(header=True).csv(path)
