import pytest
from conftest import random_applications, rows_of
from pyspark.sql import functions as F

from creditgrade import Scorecard, score_applications
from creditgrade.functions.identity import packed_key, unpacked_key
from creditgrade.operators import projections, wanted
from creditgrade.plans import direct, incremental, tables
from creditgrade.sources.runs import RunWriter, complete_runs


def ingest_time():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def parts_of(raw, n, by):
    """Parts of a table by the hash of some columns."""
    part = F.pmod(F.xxhash64(*by), F.lit(n))
    return [raw.filter(part == k) for k in range(n)]


def check(spark, root, raw):
    keyed = projections.with_member_id(raw)
    assert rows_of(incremental.current_scores(spark, root)) == rows_of(score_applications(raw))
    assert rows_of(incremental.current_bad_members(spark, root)) == rows_of(direct.bad_members(raw))
    customers = tables.clean_customers(projections.customers(keyed), ingest_time())
    assert rows_of(incremental.current_customers(spark, root, ingest_time())) == rows_of(customers)


def test_parts_give_the_rows_of_one_run(spark, tmp_path, rows_per_task=4):
    raw = random_applications(spark, 31, 240).cache()
    root = str(tmp_path / "states")
    # Copies, members and loan ids have rows in several parts.
    numbered = raw.withColumn("_n", F.monotonically_increasing_id())
    parts = [part.drop("_n") for part in parts_of(numbered, 2, ["_n"])]
    done = None
    for part in parts:
        incremental.add_applications(part, root, rows_per_task=rows_per_task)
        done = part if done is None else done.union(part)
    check(spark, root, done)


def test_only_touched_members_are_judged(spark, tmp_path):
    raw = random_applications(spark, 33, 80, hot_ids=2)
    root = str(tmp_path / "states")
    incremental.add_applications(raw, root)
    one = raw.filter("id NOT IN ('0', '1')").orderBy("id").limit(1)
    run = incremental.add_applications(one, root)
    found = run.table(spark, "judged")
    # Its own member, and members with its loan id.
    ids = [r["id"] for r in one.collect()]
    keyed = projections.with_member_id(raw)
    expected = {r["member_id"] for r in keyed.filter(F.col("id").isin(ids)).collect()}
    own = {r["member_id"] for r in projections.with_member_id(one).collect()}
    judged = {r["member_id"] for r in found.collect()}
    assert own <= judged <= expected | own and found.count() < 10
    check(spark, root, raw.union(one))


def test_empty_batch_and_no_batch(spark, tmp_path):
    root = str(tmp_path / "states")
    assert incremental.current_scores(spark, root) is None
    raw = random_applications(spark, 34, 30)
    run = incremental.add_applications(raw.limit(0), root)
    assert run.table(spark, "judged").count() == 0
    assert incremental.current_scores(spark, root).count() == 0
    incremental.add_applications(raw, root)
    check(spark, root, raw)


def test_batch_that_ended_in_the_middle(spark, tmp_path):
    root = str(tmp_path / "states")
    raw = random_applications(spark, 35, 60)
    incremental.add_applications(raw, root)
    broken = RunWriter(spark, root)
    broken.write(raw.select("id"), "members")
    assert len(complete_runs(spark, root)) == 1
    check(spark, root, raw)


def test_other_scorecard(spark, tmp_path):
    root = str(tmp_path / "states")
    raw = random_applications(spark, 36, 20)
    incremental.add_applications(raw, root)
    with pytest.raises(incremental.OtherScorecard):
        incremental.add_applications(raw, root, Scorecard(good_grade_pts=1))


def test_parts_without_filters(spark, tmp_path, monkeypatch):
    """With more keys than a Bloom filter may have, all rows go the exact way."""
    monkeypatch.setattr(wanted, "MAX_KEYS", -1)
    test_parts_give_the_rows_of_one_run(spark, tmp_path)


def test_first_batch_is_stored_once(spark, tmp_path, monkeypatch):
    """Without older states its own are the merged ones, and unused columns are not stored."""
    stored, write = {}, incremental.write_shared
    monkeypatch.setattr(incremental, "write_shared", lambda df, name: stored.setdefault(name, write(df, name)))
    raw = random_applications(spark, 37, 60)
    root = str(tmp_path / "states")
    incremental.add_applications(raw, root)
    assert list(stored) == ["new-applications"]
    assert not {"title", "purpose", "int_rate", "issue_d"} & set(stored["new-applications"].columns)
    check(spark, root, raw)


def test_last_runs_are_dealt_once(spark, tmp_path, no_broadcast):
    """They are dealt by the member for their grouping, and not again for the join."""
    root = str(tmp_path / "states")
    incremental.add_applications(random_applications(spark, 38, 60), root)
    plan = incremental.current_scores(spark, root)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning(member_id" in line]
    assert dealt and not any("run#" in line.split("hashpartitioning")[1] for line in dealt)


def test_packed_keys(spark):
    keys = ["", "0a", "0A", "abc", "00ff", "x", "ab" * 32, "\u00e9", "0", None]
    rows = spark.createDataFrame([(key,) for key in keys], "k string").select("k", packed_key("k").alias("p"))
    back = rows.select("k", "p", unpacked_key("p").alias("again")).collect()
    assert all(row["k"] == row["again"] for row in back) and len({row["p"] and bytes(row["p"]) for row in back}) == len(keys)
    assert max(len(row["p"]) for row in back if row["p"]) == 33
