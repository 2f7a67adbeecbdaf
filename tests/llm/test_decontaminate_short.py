"""Documents shorter than an item are compared as a whole."""

import random

import pytest

from creditgrade.llm import decontaminate as d

rng = random.Random(21)
VOCABULARY = [f"word{i}" for i in range(400)]
ITEMS = [(n, " ".join(rng.choice(VOCABULARY) for _ in range(n))) for n in (3, 5, 6, 9, 12, 25, 43, 90)]


def shingles(words):
    return d.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(text):
    words, out = d.words_of(text), {}
    for item, item_text in ITEMS:
        own = d.words_of(item_text)
        for i in range(max(1, len(words) - len(own) + 1) if words else 0):
            found = d.weighted_similarity(shingles(own), shingles(words[i : i + len(own)]))
            if found >= 0.8:
                out[item] = max(out.get(item, 0), found)
    return out


def documents():
    docs = [None, "", " ".join(ITEMS[6][1].split()[:42])]
    for _, text in ITEMS:
        words = text.split()
        for left in range(max(1, len(words) // 2), len(words) + 3):
            docs.append(" ".join(words[:left] + ["more"] * max(0, left - len(words))))
            docs.append(" ".join(words[-left:]))
        docs.append(" ".join(words[: len(words) // 2] + words[len(words) // 2 + 1 :]))
    return docs


def test_short_documents(spark):
    rows = list(enumerate(documents()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = d.with_hits(docs, benchmark).collect()
    hits = {r["doc_id"]: {h["item_id"]: h["similarity"] for h in r["hits"]} for r in found}
    assert hits == {i: pytest.approx(brute(text)) for i, text in rows}
    assert hits[2] == {43: pytest.approx(38 / 39)}
