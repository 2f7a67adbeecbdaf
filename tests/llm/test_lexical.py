"""Ranked lexical search against a plain computation."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from creditgrade.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, top):
    held = [(key, Counter(terms(text))) for key, text in docs]
    held = [(key, tf, sum(tf.values())) for key, tf in held if tf]
    n_docs, n_all = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, tf, _ in held for t in tf)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    rows = []
    for item, words in wanted.items():
        scored = []
        for key, tf, n in held:
            m = 100 - 50 + (50 * n * n_docs) // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m))
                for t in words if t in tf
            )
            if score > 0:
                scored.append((-score, key is None, key))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        rows += [(item, rank, key, -s) for rank, (s, _, key) in enumerate(scored[:top], 1)]
    return sorted(rows, key=repr)


def texts(rng, n):
    words = ["The", "of", "CAFÉ", "café", "straße", "x1", "中文", "İstanbul", "don't", "a-b", "zz_top"]
    words += [f"w{i}" for i in range(60)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("top,block_bytes", [(3, 1 << 20), (50, 300)])
def test_against_brute_force(spark, monkeypatch, top, block_bytes):
    rng = random.Random(top)
    monkeypatch.setattr(lexical, "SALTS", 3)
    docs = list(enumerate(texts(rng, 150)))
    docs += [(200 + i, docs[5][1]) for i in range(40)]  # ties
    docs += [docs[7], docs[7], (None, docs[8][1]), (-3, docs[5][1]), (300, None), (301, ""), (302, " .,\t\n\x00!")]
    docs += [(303, "w1 " * 200_000 + "café"), (304, "é" * 50_000 + " the")]
    items = list(enumerate(texts(rng, 25)))
    items += [(3, "w9 the"), (None, "w4 w5"), (None, "w6"), (90, None), (91, ""), (92, "--"), (93, "absent")]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, item_id string, rank int")
    wanted = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, doc_id string")
    found = lexical.search(table.repartition(5), wanted, top=top, block_bytes=block_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, items, top)


def test_small_buffers(monkeypatch):
    """Chunks, groups of documents and the pruning of a task's best, all cut small."""
    monkeypatch.setattr(lexical, "_CHUNK", 16)
    monkeypatch.setattr(lexical, "_BUFFER", 10)
    texts_ = [b"a bb a", b"", b"ccc" * 20 + b" a", b"bb", b" A,bb;a ", b"."]
    block = lexical.item_block([7], [b"a bb"], pa.int64())
    seen = lexical.occurrences(pa.array(texts_, pa.binary()), block.automaton(), 2)
    assert seen.n_terms.tolist() == [3, 0, 2, 1, 3, 0]
    assert list(zip(seen.doc.tolist(), seen.term.tolist(), seen.tf.tolist())) == [
        (0, 0, 2), (0, 1, 1), (2, 0, 1), (3, 1, 1), (4, 0, 2), (4, 1, 1)]
    best, rng, rows = lexical.Best(3, 2), random.Random(1), []
    for _ in range(30):
        some = [(rng.randrange(3), 0, rng.randrange(50), rng.randrange(1, 6)) for _ in range(4)]
        rows += some
        kept = [r for r in some if r[3] >= best.least[r[0]]]
        if kept:
            best.add(*np.array(kept).T)
    expected = []
    for item in range(3):
        expected += sorted((r for r in rows if r[0] == item), key=lambda r: (-r[3], r[2]))[:2]
    assert [tuple(r) for r in best.kept().T.tolist()] == expected


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("doc_id > 1"), items)):
        found = lexical.search(d, i)
        assert found.count() == 0 and dict(found.dtypes)["doc_id"] == "int"
    with pytest.raises(ValueError):
        lexical.search(docs.withColumnRenamed("doc_id", "item_id"), items, key="item_id")


def test_large_scores_stay_whole():
    assert lexical.term_weight(10**10, 0) == math.floor(1000 * math.log(2 * 10**10 + 2))
