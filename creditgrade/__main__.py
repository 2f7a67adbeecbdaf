"""The batch as a job: ``spark-submit`` or ``python -m creditgrade INPUT OUTPUT``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from creditgrade.plans.batch import run_batch
from creditgrade.scorecard import Scorecard
from creditgrade.sources.readers import read_csv, read_parquet


def main() -> None:
    parser = argparse.ArgumentParser(description="Curate and score loan applications.")
    parser.add_argument("input", help="raw applications")
    parser.add_argument("output", help="shared folder for the resulting tables")
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    parser.add_argument("--overwrite", action="store_true", help="replace existing tables")
    parser.add_argument("--verification", action="store_true", help="also write that table")
    parser.add_argument("--preview", type=int, default=20, help="score rows to print")
    arguments = parser.parse_args()

    spark = SparkSession.builder.appName("creditgrade").getOrCreate()
    read = read_csv if arguments.format == "csv" else read_parquet
    scored = run_batch(
        read(spark, arguments.input),
        arguments.output,
        Scorecard.from_session(spark),
        mode="overwrite" if arguments.overwrite else "errorifexists",
        with_verification=arguments.verification,
    )
    scored.printSchema()
    scored.show(arguments.preview, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
