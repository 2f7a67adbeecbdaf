"""The filter of wanted keys stops no wanted row and few others; results stay the same."""

import pytest
from conftest import random_applications, rows_of
from pyspark.sql import functions as F

from creditgrade.operators import projections, wanted
from creditgrade.operators.wanted import wanted_keys
from creditgrade.plans import scoring
from creditgrade.plans.batch import curate_keyed
from creditgrade.sources.sinks import write_shared


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_no_wanted_row_is_stopped(spark, n):
    keys = write_shared(spark.range(n).selectExpr("IF(id = 3, NULL, string(id)) AS k"), "keys")
    rows = spark.range(50_000).selectExpr("IF(id % 9 = 0, NULL, string(id)) AS k", "id AS _bits", "1 AS bits")
    kept = wanted_keys(keys, "k").keep(rows, "k")
    assert kept.columns == rows.columns
    found = {r["k"] for r in kept.collect()}
    expected = {str(i) for i in range(n) if i % 9 and i != 3}
    assert expected <= found and None not in found
    assert len(found) - len(expected) <= 0.06 * 50_000


def test_split_loses_no_row(spark):
    keys = write_shared(spark.range(100).selectExpr("string(id) AS k"), "keys")
    rows = spark.range(5_000).selectExpr("IF(id % 9 = 0, NULL, string(id)) AS k", "id AS _bits")
    likely, others = wanted_keys(keys, "k").split(rows, "k")
    assert rows_of(likely.union(others)) == rows_of(rows)
    without = {r["k"] for r in others.collect()}
    assert None not in without and not without & {str(i) for i in range(100)} and len(without) > 4_000


def test_too_many_keys(spark, monkeypatch):
    monkeypatch.setattr(wanted, "MAX_KEYS", 10)
    keys = write_shared(spark.range(11).selectExpr("id AS k"), "keys")
    rows = spark.range(20).selectExpr("id AS k")
    assert wanted_keys(keys, "k").words is None
    assert rows_of(wanted_keys(keys, "k").keep(rows, "k")) == rows_of(rows)


def test_scores_with_and_without(spark, monkeypatch):
    keyed = write_shared(projections.keyed_applications(random_applications(spark, 31)), "keyed")
    t = curate_keyed(keyed, F.lit("2024-01-01").cast("timestamp"))
    bad = write_shared(t.bad_members(), "bad")

    def scores():
        return rows_of(scoring.loan_score(t.customers, t.loans, t.repayments, bad, t.delinquency, t.records))

    filtered = scores()
    monkeypatch.setattr(wanted, "MAX_KEYS", -1)
    assert filtered and filtered == scores()


def test_split_of_too_many_keys(spark, monkeypatch):
    monkeypatch.setattr(wanted, "MAX_KEYS", 10)
    keys = write_shared(spark.range(11).selectExpr("id AS k"), "keys")
    rows = spark.range(20).selectExpr("id AS k")
    likely, others = wanted_keys(keys, "k").split(rows, "k")
    assert others is None and rows_of(likely) == rows_of(rows)
