"""Mixing: weights, bisection and budgets."""

import math

import pytest

from creditgrade.llm import mixing


def slim(spark, counts):
    rows = [(i * 1000 + j, s, 1 + (j * 7) % 20) for i, (s, n) in enumerate(counts.items()) for j in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")


COUNTS = {"hot": 600, "b": 200, "c": 60, None: 40}


@pytest.mark.parametrize("limit", [1.0, 1.5, 3.0, 50.0])
def test_repetition_limit(spark, limit):
    docs = slim(spark, COUNTS)
    plan = mixing.plan_mix(docs, max_repeats=limit, block_tokens=500)
    rows = {r["source"]: r for r in plan.collect()}
    assert sum(r["weight"] for r in rows.values()) == pytest.approx(1)
    repeats = {s: r["budget"] / r["tokens"] for s, r in rows.items()}
    assert max(repeats.values()) <= limit + 1e-2 and min(repeats.values()) == pytest.approx(1, abs=1e-3)
    weighed = mixing.with_copies(docs, plan).collect()
    assert len(weighed) == sum(COUNTS.values())
    for source, row in rows.items():
        own = [r for r in weighed if r["source"] == source]
        used = sum(r["n_tokens"] * r["copies"] for r in own)
        assert row["budget"] - 20 <= used <= row["budget"]
        assert {r["copies"] for r in own} <= {row["passes"], row["passes"] + 1}
    assert mixing.mixed(docs, plan).count() == sum(r["copies"] for r in weighed)


def test_entropy_target(spark):
    shares = slim(spark, COUNTS).groupBy("source").count().selectExpr(
        "source", "count AS tokens", "count / 900 AS share"
    )
    target = 1.2
    a = mixing.bisect_exponent(shares, target_entropy=target)
    raised = [(n / 900) ** a for n in COUNTS.values()]
    weights = [r / sum(raised) for r in raised]
    assert -sum(w * math.log(w) for w in weights) == pytest.approx(target, abs=1e-4)
    assert mixing.bisect_exponent(shares, target_entropy=9.0) == 0
    assert mixing.bisect_exponent(shares) == 1


def test_a_budget_below_the_corpus(spark):
    docs = slim(spark, COUNTS)
    plan = mixing.plan_mix(docs, budget_tokens=1000, block_tokens=100)
    used = mixing.mixed(docs, plan).agg({"n_tokens": "sum"}).first()[0]
    assert 1000 - 4 * 20 <= used <= 1000


def test_edges(spark):
    docs = slim(spark, {"a": 3})
    assert mixing.plan_mix(docs.limit(0), max_repeats=2).count() == 0
    empty = docs.selectExpr("doc_id", "source", "0L AS n_tokens", "5 AS copies")
    plan = mixing.plan_mix(empty, max_repeats=2)
    assert [r["copies"] for r in mixing.with_copies(empty, plan).collect()] == [1, 1, 1]
    texts = spark.createDataFrame([(None,), ("",), ("a  b\tc\nd",)], "text string")
    assert [r[0] for r in texts.select(mixing.n_tokens("text")).collect()] == [0, 0, 4]


def test_no_document_is_lost_to_rounding(spark):
    """Budgets of sources with up to 10**13 tokens, against whole numbers."""
    import random

    rng = random.Random(4)
    for n in range(6):
        counts = [rng.randrange(5 * 10**10, 10**13) for _ in range(5)]
        rows = [(i, f"s{i}", count) for i, count in enumerate(counts)]
        docs = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
        plan = mixing.plan_mix(docs, max_repeats=1 + rng.random())
        found = {r["source"]: r for r in plan.collect()}
        assert all(found[s]["budget"] >= t and found[s]["passes"] >= 1 for _, s, t in rows)
        assert all(r["copies"] >= 1 for r in mixing.with_copies(docs, plan).collect())


def plain_copies(rows, exponent, block_tokens, order, seed=7):
    """The mix by its definition: weights, budgets, passes and the blocks of a permutation."""
    tokens = {}
    for _, source, n in rows:
        tokens[source] = tokens.get(source, 0) + n
    total = sum(tokens.values())
    raised = {s: (n / total) ** exponent for s, n in tokens.items()}
    weight = {s: r / sum(raised.values()) for s, r in raised.items()}
    budget = max(n / weight[s] for s, n in tokens.items())
    copies = {}
    for source, n in tokens.items():
        own = max(n, int(budget * weight[source] + 1e-6))
        passes, rest = divmod(own, n)
        width = mixing._ORDER / max(1, n // block_tokens)
        placed = sorted((order[key], key, m) for key, s, m in rows if s == source)
        copies |= {key: passes for _, key, _ in placed}
        used, closed = 0, False
        for block in sorted({int(place / width) for place, _, _ in placed}):
            inside = [p for p in placed if int(p[0] / width) == block]
            for _, key, m in inside:
                closed |= used + m > rest
                if not closed:
                    used += m
                    copies[key] += 1
    return copies


@pytest.mark.parametrize("block_tokens", [200, 10**6])
def test_copies_by_definition(spark, block_tokens):
    docs = slim(spark, COUNTS)
    plan = mixing.plan_mix(docs, max_repeats=1.7, block_tokens=block_tokens)
    shares = plan.select("source", "tokens", "share")
    exponent = mixing.bisect_exponent(shares, max_repeats=1.7)
    rows = [tuple(r) for r in docs.collect()]
    order = {r[0]: r[1] for r in docs.select("doc_id", mixing.permuted("doc_id", 7)).collect()}
    expected = plain_copies(rows, exponent, block_tokens, order)
    found = {r["doc_id"]: r["copies"] for r in mixing.with_copies(docs, plan).collect()}
    assert found == expected
