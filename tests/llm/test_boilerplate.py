"""Line labels, counts and verdicts against plain versions."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from creditgrade.llm import boilerplate as b

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def texts(seed, n=60):
    rng = random.Random(seed)
    out = [None, "", "\n", " \t\r\n\x0b\x0c ", "a", "x\n" * 5, "é ü中 文\x00   z y", "||| <b> #1 $%&*"]
    out += ["a b c d e f g h " * 2, "a b c d e f g h i a b c d e f g h", "a a a a a a a a", "a " * 9, "a\r\na\r\na"]
    out += [("w%d " * 9) % tuple(range(9)) * 30_000, "one two\n" * 50_000]
    for _ in range(n):
        words = [rng.choice(["The", "of", "$$", "é", "x,", "END.", "12"]) for _ in range(rng.randrange(40))]
        out.append("".join(w + rng.choice([" ", " ", "\n", "\t", "\n\n"]) for w in words))
    return out


def test_counts(spark):
    rows = [(i, t, "extra", i) for i, t in enumerate(texts(1))]
    docs = spark.createDataFrame([*rows, rows[9], (None, "q " * 30, None, 0)], "doc_id long, text string, kept string, n_words int")
    found = b.judge(docs.repartition(3), None)
    assert found.columns == ["doc_id", "text", *b._ADDED]
    for r in found.collect():
        expected = counts(r["text"])
        assert tuple(r[c] for c in b._COUNTS[:5]) == expected, r["doc_id"]
        failed = expected[0] < 20 or 100 * expected[4] > 30 * expected[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed)
        assert r["n_lines"] == r["n_content"] == len([x for x in (r["text"] or "").split("\n") if WORD.search(x)])
    assert found.count() == len(rows) + 2
    assert b.judge(docs.select("text").limit(0), None).count() == 0
    batch = b.measure(pa.array([(t or "").encode() for t in texts(2)], pa.binary()))
    assert batch.features.max() < b.N_FEATURES and len(batch.features) == len(batch.line_doc)


def random_model(rng):
    return b.LineModel(np.array([rng.gauss(0, 1) for _ in range(b.N_FEATURES)]),
                       np.array([[rng.gauss(0, 1) for _ in "ab"] for _ in "ab"]), rng.gauss(0, 1))


def path_score(model, features, labels):
    score = model.start * labels[0] + sum(model.steps[a, c] for a, c in zip(labels, labels[1:]))
    return score + sum(model.weights[f].sum() * y for f, y in zip(features, labels, strict=True))


def test_viterbi_and_likelihood():
    """All labellings of short texts: the best one, and the sum over them."""
    rng = random.Random(5)
    sequences, all_labels, value = [], [], 0.0
    model = random_model(rng)
    for length in (1, 2, 5, 7, 7):
        features = np.array([[o + rng.randrange(s) for o, s in zip(b._OFFSETS, b._SIZES)] for _ in range(length)])
        paths = list(itertools.product((0, 1), repeat=length))
        scores = [path_score(model, features, p) for p in paths]
        assert tuple(model.decode(features)) == paths[int(np.argmax(scores))]
        labels = [rng.randrange(2) for _ in range(length)]
        value += path_score(model, features, labels) - math.log(sum(map(math.exp, scores)))
        sequences.append(features)
        all_labels.append(labels)
    inside = np.arange(7) < np.array([len(s) for s in sequences])[:, None]
    features, labels = np.zeros((5, 7, len(b._SIZES)), np.int64), np.zeros((5, 7), np.int64)
    features[inside], labels[inside] = np.concatenate(sequences), np.concatenate(all_labels)
    ridge = b._RIDGE / 2 * ((model.weights**2).sum() + (model.steps**2).sum() + model.start**2)
    found, by_weight, by_step, by_start = b.objective(model, features, inside, labels)
    assert found == pytest.approx(value - ridge)

    def moved(weights=0.0, steps=0.0, start=0.0):
        return b.objective(b.LineModel(model.weights + weights, model.steps + steps, model.start + start), features, inside, labels)[0]

    small = 1e-5
    for k in range(0, b.N_FEATURES, 7):
        one = np.eye(b.N_FEATURES)[k] * small
        assert (moved(weights=one) - moved(weights=-one)) / (2 * small) == pytest.approx(by_weight[k], abs=1e-4)
    for a, c in itertools.product((0, 1), repeat=2):
        one = np.zeros((2, 2))
        one[a, c] = small
        assert (moved(steps=one) - moved(steps=-one)) / (2 * small) == pytest.approx(by_step[a, c], abs=1e-4)
    assert (moved(start=small) - moved(start=-small)) / (2 * small) == pytest.approx(by_start, abs=1e-4)


def test_learns_from_documents(spark):
    """Labels of the larger table: documents that were not learned from are told apart."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = b.train(docs, labels.filter("doc_id % 5 <> 0"))
    rest = docs.join(labels.filter("doc_id % 5 = 0"), "doc_id").drop("toxic")
    found = [r for r in b.judge(rest, model).collect() if not r["base_failed"]]
    good = [r["kept"] for r in found if r["quality"] == 1]
    bad = [r["kept"] for r in found if r["quality"] == 0]
    print(len(good), sum(good), len(bad), sum(bad))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_labels_that_teach_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (2, 5), (None, 0)], "doc_id long, quality int")
    assert b.train(docs, labels) is None
    assert b.train(docs.limit(0), labels.limit(0)) is None
