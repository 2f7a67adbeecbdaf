"""Compare each query with its SQL: ``python -m conformance.compare SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from conformance.oracle import ORACLE_SQL
from conformance.queries import QUERIES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted_rows(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    as_text = frame.map(lambda value: None if pd.isna(value) else str(value))
    order = as_text.sort_values(list(as_text.columns), na_position="first").index
    return frame.loc[order].reset_index(drop=True)


def difference(result: DataFrame, oracle: pd.DataFrame) -> str | None:
    """What differs between a query's rows and its SQL's, None if nothing does."""
    found = result.toPandas()
    if sorted(found.columns) != sorted(oracle.columns):
        return f"columns {sorted(found.columns)} != {sorted(oracle.columns)}"
    if len(found) != len(oracle):
        return f"{len(found)} rows != {len(oracle)}"
    try:
        pd.testing.assert_frame_equal(
            _sorted_rows(found), _sorted_rows(oracle), check_dtype=False, check_exact=True
        )
    except AssertionError as error:
        return str(error)
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        wrong = difference(QUERIES[name](spark, sf_dir), connection.sql(ORACLE_SQL[name]).df())
        failed += wrong is not None
        print(f"{name:32} {time.time() - start:6.2f}s  {wrong or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
