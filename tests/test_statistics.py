"""Key statistics bound the rows of every key, and the plans they choose give the same rows."""

import random

import pytest
from conftest import random_applications, rows_of
from pyspark.sql import functions as F

from creditgrade.operators import projections, skew, statistics
from creditgrade.operators.statistics import key_statistics
from creditgrade.plans.batch import curate_keyed, run_batch
from creditgrade.plans.verification import expanded, verification_factorised
from creditgrade.sources.sinks import write_shared


def keys_of(seed, spark, n=20_000):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", None, f"warm{rng.randrange(40)}", *(f"k{rng.randrange(n)}" for _ in range(5))]),)
            for _ in range(n)]
    return write_shared(spark.createDataFrame(rows, "a string").repartition(5), "keys")


@pytest.mark.parametrize("bucket_rows", [100_000, 1000])
@pytest.mark.parametrize("listed", [64, 2])
def test_bounds_and_heavy_keys(spark, monkeypatch, bucket_rows, listed):
    monkeypatch.setattr(statistics, "LISTED", listed)
    rows = keys_of(1, spark)
    exact = {r["a"]: r["count"] for r in rows.groupBy("a").count().collect()}
    found = key_statistics(rows, {"a": "a"}, 31, bucket_rows)
    assert found.most["a"] >= max(exact.values())
    heavy = {r["a"]: r["n"] for r in found.heavy["a"].collect()}
    assert heavy == {k: n for k, n in exact.items() if n > 31} and None in heavy


def test_a_sketch_that_is_full(spark, monkeypatch):
    """More keys than the sketch tracks: no key is missed, as the bound of the rest says so."""
    monkeypatch.setattr(statistics, "TRACKED", 96)
    monkeypatch.setattr(statistics, "_SLOTS", 128)
    monkeypatch.setattr(statistics, "_EXACT_KEYS", 96)
    rows = keys_of(2, spark)
    exact = {r["a"]: r["count"] for r in rows.groupBy("a").count().collect()}
    for bucket_rows in (100_000, 200):
        found = key_statistics(rows, {"a": "a"}, 31, bucket_rows)
        assert found.most["a"] >= max(exact.values())
        heavy = {r["a"]: r["n"] for r in found.heavy["a"].collect()}
        assert heavy == {k: n for k, n in exact.items() if n > 31}


def test_no_keys_or_light_ones(spark):
    light = write_shared(spark.range(1000).selectExpr("string(id % 500) AS a", "id AS b"), "light")
    found = key_statistics(light, {"a": "a", "b": "b"})
    assert 2 <= found.most["a"] <= 31 and 1 <= found.most["b"] <= 31 and not found.heavy
    assert found.never_above("a", 4, 10**6) and not found.never_above("c", 1, 10**6)
    assert key_statistics(light.limit(0), {"a": "a"}).most == {"a": 0}


def test_crowded_keys_by_statistics(spark):
    rows = keys_of(3, spark, 4000)
    found = key_statistics(rows, {"a": "a"}, 5)
    for tables, most in (([rows], 30), ([rows, rows.limit(900)], 200), ([rows], 4)):
        plain = skew.crowded_keys(tables, "a", most)
        built = skew.crowded_keys(tables, "a", most, statistics=found)
        assert rows_of(built) == rows_of(plain)
    assert skew.crowded_keys([rows], "a", 10**6, statistics=found) is None


def jobs_of(spark, action):
    """What the action returns, and the number of Spark jobs it started."""
    group = f"counted-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    result = action()
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(found)


@pytest.fixture(scope="module", params=[11, 12])
def keyed(request, spark):
    raw = random_applications(spark, request.param)
    return write_shared(projections.keyed_applications(raw), "keyed")


@pytest.mark.parametrize("rows_per_task,array_rows", [(10**6, 4096), (30, 3), (4, 1)])
def test_factorised_verification(spark, keyed, rows_per_task, array_rows):
    time = F.lit("2024-01-01").cast("timestamp")
    plain = curate_keyed(keyed, time)
    t = curate_keyed(keyed, time, rows_per_task, statistics.application_statistics(keyed))
    expected = rows_of(plain.verification())
    assert rows_of(t.verification()) == expected
    counted = t.verification_counted()
    assert rows_of(counted) == rows_of(skew.merged(plain.verification()))
    factors = verification_factorised(*vars(t).values(), array_rows=array_rows)
    assert factors.columns == ["member_id", "customers", "loans", "delinquency", "records"]
    largest = factors.selectExpr("greatest(size(customers), size(delinquency), size(records)) AS n")
    assert largest.agg(F.max("n")).first()[0] <= 3 * array_rows + 10
    for spread in (True, False):
        assert rows_of(expanded(factors, spread)) == expected


def test_a_member_with_many_copies_is_one_small_row(spark, keyed):
    one = keyed.filter("try_cast(total_pymnt AS double) > 0 AND annual_inc IS NOT NULL").first()
    columns = [F.lit(one[f.name]).cast(f.dataType).alias(f.name) for f in keyed.schema]
    many = write_shared(spark.range(100_000).select(*columns), "many")
    t = curate_keyed(many, F.lit("2024-01-01").cast("timestamp"), statistics=statistics.application_statistics(many))
    rows = t.verification_factorised().collect()
    assert len(rows) == 1 and len(rows[0]["customers"]) == 1 and rows[0]["records"][0]["_times"] == 100_000
    assert all(x["_times"] == 100_000 for x in rows[0]["loans"] or [])


def test_few_jobs(spark, keyed):
    """With statistics, the plan of the verification table starts no job."""
    found, made = jobs_of(spark, lambda: statistics.application_statistics(keyed))
    light = statistics.KeyStatistics(found.limit, {"member_id": 20, "loan_id": 20})
    t = curate_keyed(keyed, F.current_timestamp(), statistics=light)
    assert jobs_of(spark, t.verification)[1] == 0
    assert jobs_of(spark, t.verification_factorised)[1] == 0


def test_batch_writes_the_factors(spark, tmp_path):
    raw = random_applications(spark, 13)
    run_batch(raw, str(tmp_path / "out"), with_verification=True)
    factors = spark.read.parquet(str(tmp_path / "out" / "verification_factorised"))
    counted = spark.read.parquet(str(tmp_path / "out" / "verification"))
    assert rows_of(skew.merged(expanded(factors))) == rows_of(counted.select(*skew.merged(expanded(factors)).columns))
    run_batch(raw, str(tmp_path / "less"), with_factorised=False)
    assert not (tmp_path / "less" / "verification_factorised").exists()
