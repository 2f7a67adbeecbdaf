"""Rows are not moved without need: what plans shuffle, and that it changes no result."""

from conftest import random_applications, rows_of
from pyspark.sql import functions as F

from creditgrade.operators import duplicates, skew
from creditgrade.operators.statistics import KeyStatistics, key_statistics
from creditgrade.plans import batch
from creditgrade.plans.verification import expanded


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_rows(spark, df):
    """The rows of each shuffle of a query, from its plan once it has run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        plan.executeCollect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    found, nodes = [], [plan]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return found


def test_only_rows_of_several_steps_are_moved(spark):
    df = spark.range(1000).selectExpr("id", f"IF(id = 7, 9000L, id % 3) AS {skew.TIMES}")
    repeated = skew.repeat_rows(df)
    assert sum(shuffled_rows(spark, repeated)) <= 3
    counts = dict(repeated.groupBy("id").count().collect())
    assert counts == {i: 9000 if i == 7 else i % 3 for i in range(1000) if i == 7 or i % 3}


def test_null_and_negative_times_give_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, -5), (4, 2)], f"id int, {skew.TIMES} long")
    assert [row.id for row in skew.repeat_rows(df).collect()] == [4, 4]


def test_one_shuffle_to_merge_and_group_by_a_light_key(spark):
    df = spark.range(100).selectExpr("id % 10 AS k", "id % 3 AS v").union(
        spark.createDataFrame([(None, 1), (None, 1)], "k long, v long")
    )
    light = KeyStatistics(31, {"k": 10})
    arrays = skew.merged_by(df, "k", light).groupBy("k").agg(F.sort_array(F.collect_list("v")).alias("v"))
    assert plan_of(arrays).count("Exchange hashpartitioning") == 1
    two = skew.merged(df).groupBy("k").agg(F.sort_array(F.collect_list("v")).alias("v"))
    assert rows_of(arrays) == rows_of(two)
    heavy = KeyStatistics(31, {"k": skew.ROWS_PER_TASK + 1})
    assert "REPARTITION" not in plan_of(skew.merged_by(df, "k", heavy))


def test_loans_repaid_once_are_not_shuffled(spark):
    loans = spark.range(2000).selectExpr("string(id) AS loan_id", "string(id % 500) AS member_id")
    loans = loans.union(spark.createDataFrame([("7", "x"), ("7", "x"), (None, "y")], "loan_id string, member_id string"))
    paid = spark.range(2000).selectExpr("string(id) AS loan_id").union(
        spark.createDataFrame([("7",), (None,), (None,)], "loan_id string")
    )
    found = duplicates.loans_repaid_twice(loans, paid)
    assert rows_of(found) == ["('7', 1)", "('x', 2)"]
    assert max(shuffled_rows(spark, duplicates.loans_repaid_twice(loans, paid))) < 500


def test_expanded_moves_only_members_with_very_many_rows(spark, monkeypatch):
    raw = random_applications(spark, 3)
    factors = skew.write_shared(batch.curate(raw).verification_factorised(), "factors")
    assert sum(shuffled_rows(spark, expanded(factors))) == 0
    before = rows_of(expanded(factors))
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 0)
    assert sum(shuffled_rows(spark, expanded(factors))) > 0
    assert rows_of(expanded(factors)) == before == rows_of(expanded(factors, spread=False))


def test_counted_rows_from_the_stored_factors(spark):
    curated = batch.curate(random_applications(spark, 4))
    factors = skew.write_shared(curated.verification_factorised(), "factors")
    plain = curated.verification_counted()
    assert rows_of(curated.verification_counted(factors).select(*plain.columns)) == rows_of(plain)


def test_sketch_of_many_light_keys_is_exact(spark):
    rows = skew.write_shared(spark.range(120_000).selectExpr("id DIV 3 AS k"), "light")
    assert key_statistics(rows, {"k": "k"}).most == {"k": 3}
