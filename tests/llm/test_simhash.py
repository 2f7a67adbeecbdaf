"""SimHash components equal those of a brute force over all pairs."""

import random

import pytest
from llm_brute_force import components, fingerprint

from creditgrade.llm import simhash


def texts(n=120):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    out = [None, "", " \t ", "one", "One", "a b", "a b c", "é Ü x y", "x" * 100_000]
    while len(out) < n:
        if rng.random() < 0.5 and len(out) > 20:
            copy = rng.choice(out[9:]).split()
            for _ in range(rng.choice([0, 0, 1])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
        else:
            out.append(" ".join(rng.choice(words) for _ in range(rng.choice([5, 80, 400]))))
    return out


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_components(spark, radius):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs, radius=radius).collect()}
    prints = {i: fingerprint(text, 3) for i, text in rows}
    assert {i: r["fp"] % (1 << 64) for i, r in found.items()} == prints
    assert {i: r["component"] for i, r in found.items()} == components(prints, radius)


def test_crowded_shards_are_cut_again(spark):
    rng = random.Random(5)
    near = {sum(1 << b for b in rng.sample(range(40), 2)) for _ in range(300)}
    far = {rng.getrandbits(64) for _ in range(50)}
    values = sorted(near | far)
    prints = spark.createDataFrame([(v - (1 << 64) * (v >> 63),) for v in values], "fp long")
    pairs = simhash.links(prints, 2, every=True, most=8).distinct().collect()
    found = {frozenset((p["fp"] % (1 << 64), p["other"] % (1 << 64))) for p in pairs}
    expected = {
        frozenset((a, b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2
    }
    assert found == expected
    joined = simhash.components(simhash.links(prints, 2, most=8))
    roots = {r["node"]: r["root"] for r in joined.collect()}
    expected = components({v: v for v in values}, 2)
    signed = {v - (1 << 64) * (v >> 63): v for v in values}
    groups = {}
    for node, root in expected.items():
        groups.setdefault(root, set()).add(node)
    mine = {}
    for node in signed:
        mine.setdefault(roots.get(node, node), set()).add(signed[node])
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_bk_tree():
    rng = random.Random(1)
    values = list({rng.getrandbits(12) for _ in range(200)})
    tree = simhash.BKTree()
    for value in values:
        tree.add(value)
    for value in range(0, 4096, 97):
        near = {tree.values[i] for i in tree.near(value, 3)}
        assert near == {v for v in values if (v ^ value).bit_count() <= 3}


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0
    rows = [(1, "a b c d", "z"), (1, "a b c d", "z"), (None, "a b c d", None), (7, None, "fp")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = simhash.near_duplicates(docs).select("doc_id", "component").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, 1), (1, 1), (None, 1), (7, 7)], key=str
    )


def test_one_per_component(spark):
    rows = [(i, t, "k", i) for i, t in enumerate(texts(60))]
    rows += [rows[12], rows[12], (12, rows[13][1], "k", 0), (None, rows[13][1], "k", 0), (500, "x y " * 100_000, "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, fp long").repartition(3)
    left = simhash.one_per_component(docs)
    assert left.columns == docs.columns
    top = components({i: fingerprint(r[1], 3) for i, r in enumerate(rows)}, 2)
    groups = {}
    for i, root in top.items():
        groups.setdefault(root, []).append(rows[i])
    found = left.collect()
    # A null key is smaller than any other here: struct order has nulls first.
    smallest = [min((r[0] for r in g), key=lambda k: (k is not None, k or 0)) for g in groups.values()]
    assert sorted((r["doc_id"] for r in found), key=repr) == sorted(smallest, key=repr)
    assert {(r["doc_id"], r["text"]) for r in found} <= {r[:2] for r in rows}
    assert simhash.one_per_component(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="reserved"):
        simhash.one_per_component(docs.withColumnRenamed("_key", "_simhash_key"))
