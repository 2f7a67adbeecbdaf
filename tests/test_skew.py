"""Joins with crowded keys give what plain joins give, and spread their rows."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_volume import shuffled_rows

from creditgrade.operators import skew
from creditgrade.operators.statistics import KeyStatistics


def table(spark, seed, n, column, keys=12, hot_share=0.5, repartition=5):
    rng = random.Random(seed)
    rows = [
        (0 if rng.random() < hot_share else rng.choice([None, *range(1, keys)]), rng.randrange(4))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, f"key int, {column} int").repartition(repartition)


def crowded(tables, rows_per_task, how="inner"):
    parts = skew.crowded_keys(tables, "key", rows_per_task, how)
    return parts and {r[0]: tuple(r)[1:] for r in parts.collect()}


def test_crowded_keys_follow_the_product_of_rows(spark):
    left = spark.createDataFrame([(1,)] * 20 + [(2,)] * 5 + [(None,)] * 300, "key int")
    right = spark.createDataFrame([(1,)] * 9 + [(2,)] * 2 + [(3,)] * 120, "key int")
    # 100 rows per task are pieces of ten rows of each side.
    assert crowded([left, right], 100) == {1: (2, 1), 3: (0, 0), None: (30, 1)}
    assert crowded([left, right], 100, "left") == {1: (2, 1), 3: (0, 0), None: (30, 1)}
    assert skew.crowded_keys([left, right], "key", 1000) is None


def test_any_number_of_keys_can_be_crowded(spark):
    df = spark.range(20_000).selectExpr("id % 5000 AS key")
    parts = skew.crowded_keys([df, df], "key", 4)
    assert parts.count() == 5000


@pytest.mark.parametrize("rows_per_task", [1, 4, 50, 10**6])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize(
    "hot", [(0.6, 0.0, 0.0), (0.0, 0.6, 0.0), (0.5, 0.5, 0.2), (0.0, 0.1, 0.6)]
)
def test_counted_join(spark, how, hot, rows_per_task):
    center = table(spark, 1, 60, "a", hot_share=hot[0])
    arms = [
        table(spark, 2, 50, "b", keys=9, hot_share=hot[1]),
        table(spark, 3, 40, "c", keys=15, hot_share=hot[2]),
    ]
    plain = center.join(arms[0], "key", how).join(arms[1], "key", how)
    joined, spread = skew.counted_join(center, arms, "key", how, rows_per_task)
    assert spread == (rows_per_task <= 50)
    assert rows_of(skew.merged(joined)) == rows_of(skew.merged(plain))
    written = skew.repeat_rows(joined, spread=spread)
    assert rows_of(written) == rows_of(plain.select(*written.columns))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_few(spark, how):
    center = table(spark, 4, 80, "a", hot_share=0.6)
    parts = skew.crowds(center, "key", 5)
    assert parts is not None
    for keys in ([0, 3, 5], [3, 5], []):
        few = spark.createDataFrame([(k, k * k) for k in keys], "key int, b int")
        few = few.select("key") if "_" in how else few
        plain = center.join(few, "key", how)
        assert rows_of(skew.join_few(center, few, "key", parts, how)) == rows_of(plain)
        assert rows_of(skew.join_few(center, few, "key", None, how)) == rows_of(plain)


def largest_cell(df):
    return df.groupBy("key", skew.CELL).count().agg(F.max("count")).first()[0]


def test_a_key_hot_on_both_sides_makes_bounded_tasks(spark):
    left = spark.range(3000).selectExpr("1 AS key", "id AS a").repartition(4)
    right = spark.range(2000).selectExpr("1 AS key", "id AS b").repartition(4)
    parts = skew.crowded_keys([left, right], "key", 10_000)
    cells = [skew.with_cells(df, "key", parts, n) for n, df in enumerate((left, right))]
    # Pieces of about a hundred rows: a task makes about ten thousand pairs, not six million.
    assert all(largest_cell(df) < 200 for df in cells)
    joined, _ = skew.counted_join(left, [right], "key", "inner", 10_000)
    assert joined.count() == joined.distinct().count() == 6_000_000


def test_a_key_in_one_input_partition_is_spread(spark):
    rows = spark.range(4000).selectExpr("1 AS key", "id AS a").coalesce(1)
    parts = skew.crowds(rows, "key", 100)
    assert parts.first()["p0"] == 40
    assert largest_cell(skew.with_cells(rows, "key", parts, 0)) < 200


def test_copies_become_counts(spark):
    copies = spark.range(4000).selectExpr("1 AS key", "7 AS a").repartition(16)
    other = copies.withColumnRenamed("a", "b")
    joined, spread = skew.counted_join(copies, [other], "key", "inner", 1000)
    assert spread and [tuple(r) for r in joined.collect()] == [(1, 7, 7, 16_000_000)]


def test_keys_that_join_nothing_are_left_out(spark):
    many = spark.range(1000).selectExpr("5 AS key", "id AS a")
    none = spark.createDataFrame([(1, 1)], "key int, b int")
    parts = skew.crowded_keys([many, none], "key", 100)
    assert skew.with_cells(many, "key", parts, 0).count() == 0


def test_repeat_rows(spark):
    df = spark.createDataFrame(
        [("a", 1), ("b", 4096), ("c", 4097), ("d", 0), ("e", 9000)], "k string, _times long"
    )
    counts = dict(skew.repeat_rows(df).groupBy("k").count().collect())
    assert counts == {"a": 1, "b": 4096, "c": 4097, "e": 9000}


def test_a_huge_count_is_made_lazily(spark):
    df = spark.createDataFrame([("a", 10**9), ("b", 10**10)], "k string, _times long")
    assert skew.repeat_rows(df, spread=False).limit(5).count() == 5


def test_unknown_join_type(spark):
    df = spark.createDataFrame([(1,)], "key int")
    with pytest.raises(ValueError):
        skew.star_join(df, [], "key", None, "outer")
    with pytest.raises(ValueError):
        skew.join_few(df, df, "key", None, "right")


@pytest.mark.parametrize("rows_per_task", [1, 4, 50])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [(0.6, 0.0, 0.0), (0.0, 0.1, 0.6), (0.4, 0.4, 0.2)])
def test_dealt_join(spark, how, hot, rows_per_task, monkeypatch):
    """Tables are dealt by the key and joined without a table being written on the way."""
    monkeypatch.setattr(skew, "write_shared", None)
    center = table(spark, 1, 60, "a", hot_share=hot[0])
    arms = [
        table(spark, 2, 50, "b", keys=9, hot_share=hot[1]),
        skew.merged(table(spark, 3, 40, "c", keys=15, hot_share=hot[2])),
    ]
    plain = skew.repeat_rows(center.join(arms[0], "key", how).join(arms[1], "key", how)
                             .withColumn(skew.TIMES, F.coalesce(skew.TIMES, F.lit(1))))
    joined, spread = skew.counted_join(center, arms, "key", how, rows_per_task, KeyStatistics(31, {"key": 60}))
    assert spread and joined.columns == ["key", "a", "b", "c", skew.TIMES]
    assert rows_of(skew.merged(joined)) == rows_of(skew.merged(plain))


def test_tables_are_dealt_by_their_key_once(spark):
    """Only rows of crowded keys are moved again."""
    left = spark.range(900).selectExpr("id DIV 3 AS key", "id AS a")
    right = spark.range(1200).selectExpr("id DIV IF(id < 800, 4, 10) AS key", "id AS b")
    joined, _ = skew.counted_join(left, [right], "key", "inner", 12, KeyStatistics(31, {"key": 14}))
    assert rows_of(joined.drop(skew.TIMES)) == rows_of(left.join(right, "key"))
    # 40 keys of 3 and 14 rows are moved to four cells, in pieces of 3 and 4 rows.
    assert sum(shuffled_rows(spark, joined)) <= 900 + 1200 + 40 * (2 + 3 * 4 + 14)


@pytest.mark.parametrize("counts, room, pieces", [
    ((1, 3, 3, 3), 4, [1, 1, 2, 2]), ((3, 3, 3, 1), 4, [1, 2, 2, 1]), ((5, 1, 0, 1), 4, [4, 1, 1, 1]),
    ((2, 2), 4, [2, 2]), ((20, 9), 100, [11, 9]), ((1000, 1000, 1000), 1000, [10, 10, 10]), ((7, 7), 1, [1, 1]),
])
def test_pieces_fill_their_room(spark, counts, room, pieces):
    row = spark.createDataFrame([counts], ", ".join(f"n{n} long" for n in range(len(counts))))
    assert list(skew._with_pieces(row, len(counts), room).first())[len(counts) :] == pieces
