"""The n-gram model against a plain implementation of its formulas."""

import math
import random
from collections import Counter, defaultdict

import pytest

from creditgrade.llm import ngram

END, START = ("end",), ("start",)


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


def plain_model(texts):
    pairs, words = Counter(), Counter()
    for text in texts:
        own = tokens(text)
        words.update(own)
        pairs.update(zip([START, *own], own))
    before, after = defaultdict(set), defaultdict(Counter)
    for (a, b), n in pairs.items():
        before[b].add(a)
        after[a][b] = n
    different = {b: len(a) for b, a in before.items()}

    def few(counts):
        return ngram.discounts(*(sum(c == k for c in counts) for k in (1, 2, 3, 4)))

    d2, d1 = few(pairs.values()), few(different.values())

    def cut(n, d):
        return d[min(n, 3) - 1] if n else 0

    def log10(a, b):
        n = len(pairs) or 1
        held = sum(cut(c, d1) for c in different.values()) / n if pairs else 1
        lower = max(different.get(b, 0) - cut(different.get(b, 0), d1), 0) / n + held / (len(words) + 1)
        total = sum(after[a].values())
        if not total:
            return math.log10(lower)
        left = sum(cut(c, d2) for c in after[a].values()) / total
        c = after[a].get(b, 0)
        return math.log10(max(c - cut(c, d2), 0) / total + left * lower)

    def score(text):
        own = tokens(text)
        n, v = sum(words.values()), len(words)
        return {
            "n_tokens": len(own),
            "n_known": sum(words[t] > 0 for t in own),
            "base_score": sum(math.log10((words[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own),
            "score": sum(log10(a, b) for a, b in zip([START, *own], own)),
        }

    return score


def corpus(n=150):
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(n)]
    return [*texts, None, "", " \n", "The THE the", "é É", texts[0], "x " * 50_000]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 500])
def test_scores(spark, shard_bytes):
    texts = corpus()
    held_out = ["w1 w2 unknown", None, "w1"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    model = ngram.train(docs, shard_bytes=shard_bytes)
    plain = plain_model(texts)
    rows = list(enumerate(texts + held_out))
    scored = ngram.score(
        spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string"), model
    )
    assert scored.columns == ["doc_id", "text", "n_tokens", "n_known", "base_score", "score"]
    found = {r["doc_id"]: r.asDict() for r in scored.collect()}
    for i, text in rows:
        expected = plain(text)
        assert {k: found[i][k] for k in expected} == pytest.approx(expected, rel=1e-9)
    assert model.tokens == sum(len(tokens(t)) for t in texts)




def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = ngram.train(docs.limit(0))
    row = ngram.score(docs, model).first()
    assert (row["n_tokens"], row["n_known"]) == (3, 0) and math.isfinite(row["score"])
    assert ngram.score(docs.limit(0), model).count() == 0


def test_the_shared_folder_has_to_be_mounted():
    from creditgrade.llm.common import mounted

    assert mounted("file:///a/b") == mounted("file:/a/b") == mounted("/a/b") == "/a/b"
    with pytest.raises(ValueError):
        mounted("hdfs://x/y")


def test_a_lost_file_raises(spark, sf_dir):
    import glob
    import os

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = ngram.train(docs, shard_bytes=40_000)
    assert model.word_shards > 1
    for table in ("words", "pairs", "contexts"):
        path = sorted(glob.glob(f"{model.folder}/{table}/*-hash.npy"))[1]
        os.rename(path, path + ".gone")
        with pytest.raises(Exception, match="No such file"):
            ngram.score(docs, model).collect()
        os.rename(path + ".gone", path)
