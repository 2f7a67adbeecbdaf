"""Runs of a batch below one root folder: a run is there once its manifest, written last, is.

Every run has a folder of its own. Its manifest lists its tables with their schemas and row
counts. A run that ended in the middle has none, so readers go on with the newest complete run.
Folders are never removed here.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditgrade.sources.sinks import checked, write_parquet

_MANIFEST = "manifest"


class IncompleteRun(RuntimeError):
    """A table is asked for that the run does not have."""


@dataclass(frozen=True)
class Run:
    """A complete run: its place in the order of runs, its folder and its tables."""

    number: int
    path: str
    tables: Mapping[str, Mapping]
    notes: Mapping[str, str] = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A table of the run, all rows of it: files that were lost raise."""
        if name not in self.tables:
            raise IncompleteRun(f"{self.path} has no table {name}")
        about = self.tables[name]
        schema = T.StructType.fromJson(about["schema"])
        there = spark.read.schema(schema).parquet(f"{self.path}/{name}")
        return checked(there.select(*schema.names), about["rows"], f"{self.path}/{name}")


def complete_runs(spark: SparkSession, root: str) -> list[Run]:
    """The complete runs below a folder, oldest first; none if there is no such folder."""
    try:
        lines = spark.read.option("wholetext", True).text(f"{root}/*/{_MANIFEST}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = [json.loads(line["value"]) for line in lines]
    runs = [Run(about["number"], f"{root}/{about['folder']}", about["tables"], about["notes"]) for about in found]
    return sorted(runs, key=lambda run: (run.number, run.path))


def newest_run(spark: SparkSession, root: str) -> Run | None:
    """The complete run with the highest number, None if there is none."""
    runs = complete_runs(spark, root)
    return runs[-1] if runs else None


class RunWriter:
    """Writes the tables of a new run, and publishes it at the end.

    Runs are numbered in the order in which they start. A root has one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        last = newest_run(spark, root)
        self.spark, self.root = spark, root
        self.number = last.number + 1 if last else 0
        self.folder = f"run-{self.number:06d}-{uuid.uuid4().hex}"
        self.path = f"{root}/{self.folder}"
        self._tables: dict[str, dict] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table of the run and return it as read back, its rows counted."""
        return self.add(write_parquet(df, f"{self.path}/{name}"), name)

    def add(self, written: DataFrame, name: str) -> DataFrame:
        """Take a table that lies in the run's folder already."""
        self._tables[name] = {"rows": written.count(), "schema": written.schema.jsonValue()}
        return written

    def publish(self, notes: Mapping[str, str] | None = None) -> Run:
        """Write the manifest: from now on readers find the run."""
        about = {"number": self.number, "folder": self.folder, "tables": self._tables, "notes": dict(notes or {})}
        line = self.spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1)
        line.write.mode("errorifexists").text(f"{self.path}/{_MANIFEST}")
        return Run(self.number, self.path, self._tables, about["notes"])
