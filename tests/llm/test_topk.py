"""Top-k search against all inner products."""

import random

import pytest
from pyspark.sql import functions as F

from creditgrade.llm import topk


def brute(vectors, queries, k):
    out = []
    every = sorted(set(vectors))
    for q, v in sorted(set(queries)):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in every if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, list(v)) for i, v in rows], "vec_id long, v array<long>").repartition(3)


@pytest.mark.parametrize("n, pivots, block_rows", [(400, 8, 20), (400, 1, 10_000), (4, 5, 1)])
def test_against_brute_force(spark, n, pivots, block_rows):
    rng = random.Random(n)
    centers = [[rng.randrange(-200, 200) for _ in range(6)] for _ in range(5)]
    rows = [(i, tuple(c + rng.randrange(-20, 20) for c in rng.choice(centers))) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(30 if n > 10 else 0)]
    rows += [rows[1], rows[1], (9999, (0,) * 6)]
    queries = [r for r in rows if r[0] % 7 == 0] + rows[1:2] + [(9999, (0,) * 6)]
    found = topk.top_k(table(spark, rows), table(spark, queries), 5, pivots, block_rows)
    assert sorted(map(tuple, found.collect())) == brute(rows, queries, 5)


def test_whole_numbers_and_edges(spark):
    rows = [(1, [0.5, -0.001]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, None), (5, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = df.select("vec_id", topk.whole_numbers("embedding").alias("v")).collect()
    assert {r["vec_id"]: r["v"] for r in found} == {1: [128, -1], 2: None, 3: None, 4: None, 5: None}
    none = df.select("vec_id", topk.whole_numbers("embedding").alias("v")).filter(F.lit(False))
    assert topk.top_k(none, none, 5).count() == 0
    one = df.select("vec_id", topk.whole_numbers("embedding").alias("v"))
    assert topk.top_k(one, one, 5).count() == 0


def test_vectors_of_different_lengths(spark):
    rng = random.Random(3)
    rows = [(i, tuple(rng.randrange(-50, 50) for _ in range(rng.choice([0, 2, 4, 4, 6])))) for i in range(120)]
    rows += [(500, (1, 2)), (501, (1, 2, 0, 0)), (502, ())]
    queries = [row for row in rows if row[0] % 5 == 0]
    found = topk.top_k(table(spark, rows), table(spark, queries), 5, 4, 30)
    # The score is over the components that both vectors have.
    assert sorted(map(tuple, found.collect())) == brute(rows, queries, 5)
    none = [(1, ()), (2, ())]
    assert sorted(map(tuple, topk.top_k(table(spark, none), table(spark, none), 5).collect())) == [
        (1, 1, 2, 0), (2, 1, 1, 0)
    ]
