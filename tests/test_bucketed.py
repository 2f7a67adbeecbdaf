"""Tables in buckets: the same rows, and no shuffle below what goes by the bucket key."""

import shutil
from dataclasses import replace

import pytest
from conftest import random_applications, rows_of
from pyspark.sql import functions as F

from creditgrade.operators import duplicates, projections
from creditgrade.operators.statistics import KeyStatistics, application_statistics
from creditgrade.plans.batch import curate_keyed, open_stored, store_bucketed
from creditgrade.sources.bucketed import open_bucketed, write_bucketed
from creditgrade.sources.sinks import LostRows, write_shared




@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    keyed = write_shared(projections.keyed_applications(random_applications(spark, 21)), "keyed")
    light = KeyStatistics(31, {"member_id": 20, "loan_id": 200})
    plain = curate_keyed(keyed, F.lit("2024-01-01").cast("timestamp"), statistics=light)
    folder = str(tmp_path_factory.mktemp("buckets"))
    return plain, store_bucketed(plain, folder, "bucketed_test", 5), folder


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_rows_and_plans(tables, no_broadcast):
    plain, stored, _ = tables
    for name, df in plain.tables().items():
        assert rows_of(stored.tables()[name]) == rows_of(df.select(*stored.tables()[name].columns))
    joined = stored.customers.join(stored.loans, "member_id", "left").join(stored.delinquency, "member_id", "left")
    joined = joined.join(stored.records, "member_id", "left")
    assert exchanges(joined) == 0
    assert exchanges(duplicates.duplicate_keys(stored.records)) == 0
    assert exchanges(duplicates.duplicate_keys(plain.records)) == 1
    bad = write_shared(plain.bad_members(), "bad")
    good = duplicates.good_customers(stored.customers, bad, statistics=stored.statistics)
    # Only the bad members are shuffled; the customers stay where they are.
    assert exchanges(good) == 1
    assert rows_of(stored.verification()) == rows_of(plain.verification())
    assert rows_of(stored.bad_members()) == rows_of(plain.bad_members())
    # Loans and their repayments meet by loan id, all else where it lies.
    assert exchanges(stored.verification()) < exchanges(plain.verification())


def test_opened_by_another_session(spark, tables, no_broadcast):
    plain, stored, folder = tables
    opened = open_stored(spark.newSession(), folder, "opened_test", statistics=plain.statistics)
    assert rows_of(opened.customers) == rows_of(plain.customers)
    assert exchanges(opened.customers.join(opened.records, "member_id")) == 0


def test_heavy_and_null_keys_and_lost_files(spark, tmp_path):
    rows = spark.range(3000).selectExpr("IF(id % 3 = 0, 'hot', nullif(string(id % 50), '7')) AS k", "id")
    heavy = KeyStatistics(31, {"k": 1000})
    for name, known in (("even", None), ("heavy", heavy)):
        path = str(tmp_path / name)
        found = write_bucketed(rows.repartition(4), path, f"keys_{name}", "k", 6, known, 500)
        assert rows_of(found) == rows_of(rows)
        assert exchanges(found.groupBy("k").count()) == 0
    part = next((tmp_path / "even").glob("part-*.parquet"))
    shutil.copy(part, tmp_path / "kept")
    part.unlink()
    with pytest.raises(LostRows):
        open_bucketed(spark, str(tmp_path / "even"), "keys_lost")
    empty = write_bucketed(rows.limit(0), str(tmp_path / "none"), "keys_none", "k", 3)
    assert empty.count() == 0


def test_crowded_members_are_still_dealt(spark, tables):
    plain, stored, _ = tables
    few = [replace(t, rows_per_task=4, statistics=None) for t in (plain, stored)]
    assert rows_of(few[1].verification()) == rows_of(few[0].verification())
    assert application_statistics(plain.records.withColumn("id", F.lit("1"))).most["member_id"] > 0
