"""Decontamination against a brute force over all windows."""

import random
from collections import Counter

import pytest

from creditgrade.llm import decontaminate as d

rng = random.Random(8)
VOCABULARY = [f"word{i}" for i in range(300)]
ITEMS = [(i, " ".join(rng.choice(VOCABULARY) for _ in range(rng.choice([12, 20, 31])))) for i in range(25)]
ITEMS += [(100, "short one"), (101, None), (102, " .,"), (103, ITEMS[0][1])]


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(text):
    words, out = d.words_of(text), {}
    for item, item_text in ITEMS:
        own = d.words_of(item_text)
        if not own:
            continue
        for i in range(len(words) - len(own) + 1):
            found = d.weighted_similarity(shingles(own), shingles(words[i : i + len(own)]))
            if found >= 0.8:
                out[item] = max(out.get(item, 0), found)
    return out


def documents():
    docs = [None, "", "?", "a short ONE here", ITEMS[3][1].upper().replace(" ", ", ")]
    for _ in range(60):
        words = [rng.choice(VOCABULARY) for _ in range(rng.randrange(5, 120))]
        if rng.random() < 0.7:
            leak = rng.choice(ITEMS[:25])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                leak[rng.randrange(len(leak))] = rng.choice(VOCABULARY)
            at = rng.randrange(len(words))
            words[at:at] = leak
        docs.append(" ".join(words))
    docs.append(" ".join(VOCABULARY) * 100 + " " + ITEMS[5][1])
    return docs


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_hits(spark, block_bytes):
    rows = list(enumerate(documents()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS hits")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = d.with_hits(docs, benchmark, block_bytes=block_bytes)
    assert found.columns == ["doc_id", "text", "hits"]
    hits = {r["doc_id"]: {h["item_id"]: h["similarity"] for h in r["hits"]} for r in found.collect()}
    assert hits == {i: pytest.approx(brute(text)) for i, text in rows}
    assert sum(map(bool, hits.values())) > 20


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.with_hits(docs, benchmark.limit(0)).first()["hits"] == []
    assert d.with_hits(docs.limit(0), benchmark).count() == 0


def test_index_guarantees_the_radius():
    index = d.ItemIndex(ITEMS, 0.8)
    for at, (_, fp, _) in enumerate(index.items[:10]):
        size = len(d.words_of(ITEMS[at][1]))
        other = fp ^ sum(1 << b for b in rng.sample(range(64), d.RADIUS))
        assert at in index.near(other, size)
