"""Toxicity: the kernel against its definition, and held-out accuracy."""

import random
from itertools import combinations

import numpy as np
import pytest

from creditgrade.llm import toxicity as t

INSULTS = ["dunderhead", "blockhead", "numskull"]


def word(rng):
    return "".join(rng.choice("aeiourstlnmcd") for _ in range(rng.randrange(2, 9)))


def corpus(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [word(rng) for _ in range(rng.randrange(10, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            insult = rng.choice(INSULTS)
            form = rng.choice(["{}", "{},", "{}s", "*{}*"])
            words.insert(rng.randrange(len(words)), form.format(insult))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus(900, 1)
    return t.train(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int"),
    )


def test_held_out_accuracy(spark, model):
    docs, labels = corpus(300, 2)
    scored = t.score(spark.createDataFrame(docs, "doc_id long, text string"), model)
    found = {r["doc_id"]: r["toxicity"] for r in scored.collect()}
    right = sum((found[i] >= 0.5) == bool(toxic) for i, toxic in labels)
    assert right >= 285 and all(0 <= p <= 1 for p in found.values())


def test_gaps_and_insertions(spark, model):
    plain = t.Scorer(model).probabilities(["a nice calm day"])[0]
    for form in ("num-skull", "nuxmskull", "n u m s k u l l", "NUMSKULL!!", "numskullish"):
        assert t.Scorer(model).probabilities([f"a nice {form} day"])[0] > max(0.5, plain)


def test_edges(spark, model):
    rows = [(1, None, 2.0), (2, "", 2.0), (3, "12 !", 2.0), (None, "numskull " * 20_000, 2.0),
            (4, "x" * 50_000 + "blockhead", 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity double")
    found = {r["doc_id"]: r["toxicity"] for r in t.score(docs, model).collect()}
    assert found[1] == found[2] == found[3] < 0.01 and found[None] > 0.9 and 0 <= found[4] <= 1
    assert t.score(docs.limit(0), model).count() == 0
    for some in ([], [(1, 0)], [(2, 1)]):
        few = t.train(docs.select("doc_id", "text"), spark.createDataFrame(some, "doc_id long, toxic int"))
        assert 0 <= t.score(docs, few).first()["toxicity"] <= 1


def test_kernel_values_follow_the_definition():
    kernel = t.Kernel([ord(c) for c in "abcdefg"])
    words = ["abcdefg", "abxcd", "gfedcba", "ace"]
    units, owner = kernel.units(words)
    assert owner.tolist() == [0, 1, 2, 3]

    def features(unit):
        symbols, out = unit[unit > 0].tolist(), {}
        for i, j, k in combinations(range(len(symbols)), 3):
            if k - i < t.SPAN:
                key = symbols[i], symbols[j], symbols[k]
                out.setdefault(key, []).append(t.DECAY ** (k - i - 2))
        return out

    for i, a in enumerate(units):
        for j, b in enumerate(units):
            x, y = features(a), features(b)
            size = [sum(w * w for ws in f.values() for w in ws) ** 0.5 for f in (x, y)]
            expected = sum(sum(x[k]) * sum(y[k]) for k in x if k in y) / max(size[0], 1) / max(size[1], 1)
            assert kernel.values(units[i : i + 1], units[j : j + 1])[0, 0] == pytest.approx(expected, rel=1e-5)


def test_long_words_are_read_in_pieces():
    kernel = t.Kernel([ord(c) for c in "abcdefg"])
    units, owner = kernel.units(["a" * 40, "", "!!", "bcd"])
    assert owner.tolist() == [0, 0, 0, 0, 3] and (units[:4] > 0).all()
    assert np.array_equal(units[4][:3] > 0, [True] * 3)


def test_values_do_not_depend_on_how_other_letters_are_numbered():
    """Only letters of landmarks matter: a kernel of these alone equals one of all letters."""
    rng = random.Random(9)
    letters = [chr(0x4E00 + i) for i in range(700)]
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 12))) for _ in range(300)]
    marks = words[:40]
    few, many = t.Kernel(t._alphabet(marks)), t.Kernel([ord(c) for c in letters])
    assert len(t._alphabet(marks)) > 150
    found = [k.values(k.units(words)[0], k.units(marks)[0]) for k in (few, many)]
    assert np.allclose(*found) and (found[0] > 0.99).sum() >= 40


def test_different_texts_are_not_merged(spark):
    """Texts that share their rarest words still count by themselves; copies count as one."""
    rows = [(i, " ".join(f"w{i}{j}" for j in "abcdefghijkl") + " the and of") for i in range(50)]
    rows += [(100 + i, rows[0][1]) for i in range(20)]
    sample = spark.createDataFrame([(text, 1, 1) for _, text in rows], "text string, label int, part int")
    toxic, clean = t._bags(sample)
    assert toxic["id"].nunique() == 50 and clean.empty and len(toxic) == 50 * 15
