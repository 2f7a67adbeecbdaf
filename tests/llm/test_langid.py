"""Language identification: the model against plain formulas, and held-out accuracy."""

import random
from collections import Counter

import numpy as np
import pytest

from creditgrade.llm import langid

LETTERS = {"xx": "abcdefgh", "yy": "fghijklm", "zz": "zyxwvuab"}


def word(rng, lang):
    return "".join(rng.choice(LETTERS[lang]) for _ in range(rng.randrange(2, 7)))


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(LETTERS))
        out.append((i, " ".join(word(rng, lang) for _ in range(rng.randrange(4, 60))), lang))
    return out


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(texts(300, 1), "doc_id long, text string, lang string")
    return langid.train(docs)


def test_held_out_accuracy(spark, model):
    rows = texts(200, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.identify(docs, model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 190
    assert sum(r["lang_rejected"] for r in found) <= 2
    assert all(0 <= r["lang_score"] <= 1 for r in found)


def test_edges(spark, model):
    rows = [(1, None), (2, ""), (3, "12 .,! 3"), (4, "ÄÖÜ ßéñ"), (None, "zyx wvu " * 30_000),
            (5, "qqqq pppp rrrr qprq tttt " * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang_pred", docs_lit())
    found = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    for key in (1, 2, 3):
        assert (found[key]["lang_pred"], found[key]["lang_score"]) == ("und", 0.0)
        assert found[key]["lang_rejected"]
    assert found[4]["lang_pred"] in LETTERS
    assert found[5]["lang_rejected"]
    assert found[None]["lang_pred"] == "zz" and not found[None]["lang_rejected"]
    assert langid.identify(docs.limit(0), model).count() == 0


def docs_lit():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.languages == []
    assert langid.identify(docs, model).first()["lang_pred"] == "und"


def test_kneser_ney_sums_to_one_and_follows_the_formula():
    rng = random.Random(4)
    grams = Counter(
        langid.packed(rng.choice([0, 2, 3]), rng.choice([2, 3, 4]), rng.choice([0, 2, 3, 4, 5]))
        for _ in range(400)
    )
    keys = np.array(sorted(grams), np.int64)
    counts = np.array([grams[k] for k in keys.tolist()])
    model = langid.CharModel.fit(keys, counts, 256)
    for context in ((2, 2), (0, 3), (9, 9)):
        every = langid.packed(*context, np.arange(256, dtype=np.int64))
        assert np.exp(-model.surprise(every)).sum() == pytest.approx(1)
    d = langid._discount(counts)
    context = int(keys[0]) >> langid._BITS
    own = {k: c for k, c in grams.items() if k >> langid._BITS == context}
    lower = model.after_one(keys[:1] & langid._PAIR)[0]
    expected = (max(own[int(keys[0])] - d, 0) + d * len(own) * lower) / sum(own.values())
    assert np.exp(-model.surprise(keys[:1]))[0] == pytest.approx(expected)


class PlainModel:
    """Interpolated Kneser-Ney over symbols, from the texts themselves and by its definition."""

    def __init__(self, texts, n_symbols):
        self.grams = Counter(gram for text in texts for gram in plain_grams(text))
        self.pairs = Counter(gram[1:] for gram in self.grams)
        self.ones = Counter(pair[1:] for pair in self.pairs)
        self.n_symbols = n_symbols

    def part(self, counts, gram, lower):
        kinds = Counter(counts.values())
        d = kinds[1] / (kinds[1] + 2 * kinds[2]) if kinds[1] else 0.5
        own = [n for other, n in counts.items() if other[:-1] == gram[:-1]]
        if not own:
            return lower
        return (max(counts[gram] - d, 0) + d * len(own) * lower) / sum(own)

    def nats(self, text):
        total = []
        for gram in plain_grams(text):
            lower = 1 / self.n_symbols
            for counts, tail in ((self.ones, gram[2:]), (self.pairs, gram[1:]), (self.grams, gram)):
                lower = self.part(counts, tail, lower)
            total.append(-np.log(lower))
        return sum(total) / len(total)


def plain_grams(text):
    """Each letter and word end with the two symbols before it in its word."""
    out = []
    for word in "".join(c.lower() if c.isalpha() else " " for c in text).split():
        marked = ["", "", *word, ""]
        out += [tuple(marked[i - 2 : i + 1]) for i in range(2, len(marked))]
    return out


def many_letters(first, n):
    return [c for c in map(chr, range(first, first + 3 * n)) if c.isalpha()][:n]


def scripts(n, seed):
    """Two languages of 1,500 letters each beside one of 240 letters that is ten times as frequent."""
    rng = random.Random(seed)
    letters = {"han": many_letters(0x4E00, 3000)[::2], "kan": many_letters(0x4E00, 3000)[1::2],
               "yi": many_letters(0xA000, 240)}
    rows = []
    for i in range(n):
        lang = ("han", "kan", "yi")[i % 3]
        words = 40 if lang != "yi" else 400
        text = " ".join(
            "".join(rng.choice(letters[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words)
        )
        rows.append((i, text, lang))
    return rows


def test_scripts_of_many_letters(spark):
    kinds = "doc_id long, text string, lang string"
    model = langid.train(spark.createDataFrame(scripts(450, 5), kinds))
    assert len(model.alphabet) >= 3000
    found = langid.identify(spark.createDataFrame(scripts(150, 6), kinds), model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.95 * len(found)


def test_entropies_equal_a_plain_scorer(spark, monkeypatch):
    """Also with symbols beyond the frequent ones and where values are forgotten."""
    rows = [r for r in scripts(24, 7) if r[2] != "yi"] + texts(40, 8)
    docs = spark.createDataFrame(
        [(i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, text string, lang string"
    )
    model = langid.train(docs)
    assert len(model.alphabet) > 300
    own = {lang: [] for lang in model.languages}
    for row in langid._sample(docs, "doc_id", "text", "lang", langid.SAMPLE_PER_LANGUAGE).filter("part > 0").collect():
        own[row["lang"]].append(row["text"])
    plain = [PlainModel(own[lang], langid._FIRST + len(model.alphabet)) for lang in model.languages]
    tried = [rows[0][1][:60], rows[-1][1][:60], "abc, ABC! " + rows[1][1][:20]]
    scanner = model.scanner()
    for _ in range(2):
        entropy, n, letters = scanner.entropies(tried)
        for i, text in enumerate(tried):
            assert (n[i], letters[i]) == (len(plain_grams(text)), sum(c.isalpha() for c in text))
            assert entropy[i] == pytest.approx([one.nats(text) for one in plain], rel=1e-4)
        monkeypatch.setattr(langid, "_MEMORY_BYTES", 0)
