from pathlib import Path

import pytest
from conftest import random_applications, rows_of

from creditgrade.plans import batch
from creditgrade.plans.audit import Audit
from creditgrade.sources import runs, sinks


def test_newest_complete_run(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert runs.newest_run(spark, root) is None
    first = batch.publish_batch(random_applications(spark, 41, 40), root, with_factorised=False)
    broken = runs.RunWriter(spark, root)
    broken.write(spark.range(3), "loans")
    assert runs.newest_run(spark, root) == first
    second = runs.RunWriter(spark, root)
    second.write(spark.range(2), "loans")
    second.publish()
    assert [run.path for run in runs.complete_runs(spark, root)] == [first.path, second.path]
    assert rows_of(runs.newest_run(spark, root).table(spark, "loans")) == ["(0,)", "(1,)"]
    assert first.table(spark, "records").count() == 40
    with pytest.raises(runs.IncompleteRun):
        runs.newest_run(spark, root).table(spark, "customers")


def test_lost_files_of_a_run_are_noticed(spark, tmp_path):
    writer = runs.RunWriter(spark, str(tmp_path))
    writer.write(spark.range(0, 100, 1, 4), "numbers")
    run = writer.publish()
    assert run.table(spark, "numbers").count() == 100
    part = next(Path(f"{run.path}/numbers").glob("part-*.parquet"))
    part.unlink()
    with pytest.raises(sinks.LostRows):
        run.table(spark, "numbers")


def test_audit_counts(spark, tmp_path):
    raw = random_applications(spark, 42, 60)
    batch.run_batch(raw, str(tmp_path / "out"), with_factorised=False)
    audit = spark.read.parquet(str(tmp_path / "out" / "audit")).collect()
    found = {(r["table_name"], r["filter_name"]): r["n_rows"] for r in audit}
    tables = {name: spark.read.parquet(str(tmp_path / "out" / name)).count()
              for name in ("customers", "loans", "repayments", "delinquency", "records")}
    assert found["loans", "rows"] == found["repayments", "rows"] == 60
    assert found["records", "rows"] == found["delinquency", "rows"] == 60 == tables["records"]
    assert found["customers", "income_present"] == tables["customers"]
    assert found["loans", "complete"] == tables["loans"]
    assert found["repayments", "complete"] >= found["repayments", "paid"] == tables["repayments"]
    assert found["delinquency", "delinquent"] == tables["delinquency"]


def test_audit_of_an_empty_table(spark, tmp_path):
    audit = Audit()
    with pytest.raises(ValueError):
        audit.seen(audit.seen(spark.range(0), "records"), "records")
    audit = Audit()
    sinks.write_parquet(audit.seen(spark.range(0), "records"), str(tmp_path / "none"))
    assert [tuple(row) for row in audit.counts(spark).collect()] == [("records", 0, "rows", 0)]
