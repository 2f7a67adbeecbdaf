"""Language identification by character models with interpolated Kneser-Ney smoothing.

One model per language, fitted on a bounded sample of labelled texts. A text is read as
words of letters; every letter and word end is predicted from the two symbols before it
within the word. The language with the lowest cross-entropy per symbol wins. Its value is
also held against what texts of that language and of the others had in a part of the sample
that was not used for fitting: a text that is farther from its language than all of these
were, and nearer to what foreign texts have, is rejected.

Every letter of the sample is a symbol of its own, whatever its script and however rare; only
letters that no sampled text has share one. Symbols are numbered by frequency.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditgrade.llm.common import bounded_sample, letter_table, pieces, released, schema_text, stored

SAMPLE_PER_LANGUAGE = 1000
MAX_LANGUAGES = 500
CALIBRATION_PART = 4
SLACK = 1.5
LONG_TEXT = 2000
UNDETERMINED = "und"
_OTHER, _FIRST = 1, 2
_BITS = 21  # as many as a code point has, so that any alphabet fits
_SYMBOL, _PAIR = (1 << _BITS) - 1, (1 << 2 * _BITS) - 1
# Grams of the 256 most frequent symbols are found by place, the others in sorted arrays.
_FREQUENT = 8
_RARE = sum((_SYMBOL >> _FREQUENT << _FREQUENT) << _BITS * i for i in range(3))
_BATCH_BYTES = 1 << 18
_MEMORY_BYTES = 32 << 20


def packed(far: np.ndarray, before: np.ndarray, own: np.ndarray) -> np.ndarray:
    """One number for three symbols, in their order."""
    return (far << 2 * _BITS) | (before << _BITS) | own


def _alphabet_table(alphabet: np.ndarray) -> np.ndarray:
    """For each code point its symbol: 0 no letter, 1 a letter outside the alphabet."""
    symbol = np.full(0x110000, _OTHER, np.int32)
    symbol[0] = 0
    symbol[alphabet] = np.arange(_FIRST, _FIRST + len(alphabet))
    return symbol[letter_table()]


def _find(array: np.ndarray, values: np.ndarray, wanted: np.ndarray, other: float) -> np.ndarray:
    """The values beside the wanted keys in a sorted array, ``other`` for keys not in it."""
    at = np.minimum(np.searchsorted(array, wanted), len(array) - 1)
    return np.where(array[at] == wanted, values[at], other)


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, a line end after each, and where each starts."""
    flat = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum([len(text) + 1 for text in texts])])


def _grams(texts: list[str], symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the predicted symbols with their contexts, where each text starts among
    them, and how many letters each text has. A key is the packed symbols: context symbols
    before the word are 0, runs of other characters are one word end."""
    flat, starts = _code_points(texts)
    symbol = symbols[flat]
    kept = symbol > 0
    kept[1:] |= symbol[:-1] > 0
    places = np.concatenate([[0], np.cumsum(kept)])[starts]
    letters = np.concatenate([[0], np.cumsum(symbol > 0)])[starts]
    own = symbol[kept].astype(np.int64)
    before = np.concatenate([[0], own[:-1]])[: len(own)]
    far = np.concatenate([[0, 0], own[:-2]])[: len(own)]
    far = np.where(before == 0, 0, far)
    return packed(far, before, own), places, np.diff(letters)


def _discount(counts: np.ndarray) -> float:
    """Kneser-Ney discount from the numbers of counts of one and two."""
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return ones / (ones + 2 * twos) if ones else 0.5


@dataclass(frozen=True)
class CharModel:
    """A language's model: sorted arrays of keys, each with its value."""

    grams: np.ndarray
    gram_part: np.ndarray
    contexts: np.ndarray
    context_part: np.ndarray
    pairs: np.ndarray
    pair_part: np.ndarray
    firsts: np.ndarray
    first_part: np.ndarray
    seconds: np.ndarray
    second_part: np.ndarray
    unseen: float  # probability of a symbol that the language does not have

    @classmethod
    def fit(cls, keys: np.ndarray, counts: np.ndarray, n_symbols: int) -> CharModel:
        """From the sorted keys of the three-symbol grams and their counts."""
        contexts, of_context = np.unique(keys >> _BITS, return_inverse=True)
        total = np.bincount(of_context, counts)
        kinds = np.bincount(of_context)
        three = _discount(counts)
        # The number of different symbols before a pair, and before a symbol.
        pairs, before_pair = np.unique(keys & _PAIR, return_counts=True)
        two = _discount(before_pair)
        firsts, of_first = np.unique(pairs >> _BITS, return_inverse=True)
        all_after = np.bincount(of_first, before_pair)
        seconds, before_one = np.unique(pairs & _SYMBOL, return_counts=True)
        one = _discount(before_one)
        unseen = one * len(seconds) / len(pairs) / n_symbols
        return cls(
            keys, np.maximum(counts - three, 0) / total[of_context],
            contexts, three * kinds / total,
            pairs, np.maximum(before_pair - two, 0) / all_after[of_first],
            firsts, two * np.bincount(of_first) / all_after,
            seconds, np.maximum(before_one - one, 0) / len(pairs) + unseen, unseen,
        )

    def after_one(self, pairs: np.ndarray) -> np.ndarray:
        """Probability of each pair's second symbol after its first."""
        single = _find(self.seconds, self.second_part, pairs & _SYMBOL, self.unseen)
        left = _find(self.firsts, self.first_part, pairs >> _BITS, 1.0)
        return _find(self.pairs, self.pair_part, pairs, 0.0) + left * single

    def surprise(self, keys: np.ndarray) -> np.ndarray:
        """Nats of each gram's last symbol after its first two."""
        lower = _find(self.contexts, self.context_part, keys >> _BITS, 1.0)
        return -np.log(_find(self.grams, self.gram_part, keys, 0.0) + lower * self.after_one(keys & _PAIR))


@dataclass(frozen=True)
class LanguageModel:
    """Models of all languages, in the order of their names."""

    alphabet: np.ndarray  # letters, the most frequent first
    languages: list[str]
    models: list[CharModel]
    usual: np.ndarray  # mean cross-entropy of each language's own texts
    worst: np.ndarray  # the farthest that one of them was above, times the root of its length
    foreign: np.ndarray  # mean cross-entropy of the other languages' texts

    def scanner(self) -> Scanner:
        return Scanner(self)


class Scanner:
    """Cross-entropies of texts; remembers the values of grams seen so far."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.symbols = _alphabet_table(model.alphabet)
        self.forget()

    def forget(self) -> None:
        # From 1, 0 for grams not seen: pages of the table that hold none take no memory.
        self.place = np.zeros(1 << 3 * _FREQUENT, np.int32)
        self.rare, self.rare_place = np.zeros(1, np.int64), np.zeros(1, np.int32)
        self.values = np.empty((0, len(self.model.languages)), np.float32)

    def remembered(self, keys: np.ndarray) -> np.ndarray:
        """Where each gram's values are, from 1, and 0 for new grams."""
        dense = (
            (keys >> 2 * (_BITS - _FREQUENT) & 0xFF0000) | (keys >> _BITS - _FREQUENT & 0xFF00) | keys & 0xFF
        )
        found = self.place[dense]
        if len(rare := np.flatnonzero(keys & _RARE)):
            found[rare] = _find(self.rare, self.rare_place, keys[rare], 0)
        return found

    def remember(self, keys: np.ndarray) -> None:
        """Add values of new grams, given once each."""
        places = np.arange(len(self.values), len(self.values) + len(keys), dtype=np.int32) + 1
        rare = keys & _RARE > 0
        far, before, own = (keys[~rare] >> _BITS * i & _SYMBOL for i in (2, 1, 0))
        self.place[far << 2 * _FREQUENT | before << _FREQUENT | own] = places[~rare]
        if rare.any():
            every = np.concatenate([self.rare, keys[rare]])
            order = np.argsort(every, kind="stable")
            self.rare = every[order]
            self.rare_place = np.concatenate([self.rare_place, places[rare]])[order]
        fresh = [model.surprise(keys).astype(np.float32) for model in self.model.models]
        self.values = np.concatenate([self.values, np.stack(fresh, axis=1)])

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the nats per symbol in each language, its symbols and its letters."""
        keys, starts, letters = _grams(texts, self.symbols)
        if self.values.nbytes > _MEMORY_BYTES:
            self.forget()
        places = self.remembered(keys)
        if len(new := np.unique(keys[places == 0])):
            self.remember(new)
            places = self.remembered(keys)
        n = np.diff(starts)
        sums = np.zeros((len(texts), len(self.model.languages)))
        some = np.flatnonzero(n)
        if len(some):
            nats = self.values[places - 1]
            sums[some] = np.add.reduceat(nats, starts[some], axis=0, dtype=np.float64)
        return sums / np.maximum(n, 1)[:, None], n, letters

    def identify(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score from 0 to 1 and rejection of each text."""
        if not self.model.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropy, n, letters = self.entropies(texts)
        best = entropy.argmin(axis=1)
        lowest = entropy.min(axis=1)
        root = np.sqrt(np.maximum(n, 1))
        score = 1 / np.exp(-(entropy - lowest[:, None]) * root[:, None]).sum(axis=1)
        usual, worst = self.model.usual[best], self.model.worst[best]
        limit = np.maximum(
            usual + SLACK * worst / np.minimum(root, LONG_TEXT**0.5),
            (usual + self.model.foreign[best]) / 2,
        )
        none = letters == 0
        names = [UNDETERMINED if no else self.model.languages[b] for no, b in zip(none, best)]
        return names, np.where(none, 0.0, score), none | (lowest > limit)


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [text or "" for text in batch.column(column).to_pylist()]


def _sample(docs: DataFrame, key: str, text: str, lang: str, per_language: int) -> DataFrame:
    """At most ``per_language`` labelled texts of each language, the same ones each time."""
    labelled = docs.filter(f"{lang} IS NOT NULL AND {text} IS NOT NULL").select(lang, key)
    ids = (
        bounded_sample(labelled, lang, key, per_language, 5)
        .selectExpr(f"{key} AS _id", f"{lang} AS _lang", f"n % {CALIBRATION_PART} AS _part")
        .dropDuplicates(["_id", "_lang"])
    )
    ids = stored(ids, "langid-ids")
    whole = docs.join(ids, F.col(key).eqNullSafe(F.col("_id")) & (F.col(lang) == F.col("_lang")))
    whole = whole.select(F.col("_lang").alias("lang"), F.col("_part").alias("part"), F.col(text).alias("text"))
    return stored(whole, "langid-sample")


def train(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """Fit the models on at most ``per_language`` texts of each language.

    Grams are counted in Spark. What comes to the driver is bounded by the sample: its
    letters, and the different grams of each language's texts. Three of four sampled texts fit, the fourth
    calibrates. Without labelled texts there are no languages.
    """
    sample = _sample(docs, key, text, lang, per_language)

    def characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0x110000, np.int64)
        for batch in pieces(batches, "text", _BATCH_BYTES):
            seen += np.bincount(letter_table()[_code_points(_texts(batch, "text"))[0]], minlength=0x110000)
        seen[0] = 0
        codes = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(seen[codes])], ["code", "n"])

    most = (
        sample.select("text")
        .mapInArrow(lambda batches: released(characters(batches)), "code long, n long")
        .groupBy("code").agg(F.sum("n").alias("n"))
    )
    alphabet = most.orderBy(F.desc("n"), "code").toArrow()["code"].to_numpy()

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = _alphabet_table(alphabet)
        for batch in pieces(batches, "text", _BATCH_BYTES):
            langs, texts = batch.column("lang").to_pylist(), _texts(batch, "text")
            keys, starts, _ = _grams(texts, symbols)
            for lang in sorted(set(langs)):
                own = [keys[a:b] for name, a, b in zip(langs, starts, starts[1:]) if name == lang]
                found, counts = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found)), pa.array(found), pa.array(counts)],
                    ["lang", "gram", "n"],
                )

    counted = (
        sample.filter("part > 0").select("lang", "text")
        .mapInArrow(lambda batches: released(grams(batches)), "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .orderBy("lang", "gram").toArrow().to_pandas()
    )
    languages = sorted(counted["lang"].unique().tolist())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    models = []
    for name in languages:
        own = counted[counted["lang"] == name]
        keys, counts = own["gram"].to_numpy(np.int64), own["n"].to_numpy(np.int64)
        models.append(CharModel.fit(keys, counts, _FIRST + len(alphabet)))
    n = len(languages)
    model = LanguageModel(
        alphabet, languages, models, np.full(n, np.inf), np.zeros(n), np.full(n, -np.inf)
    )
    return _calibrated(model, sample.filter("part = 0")) if languages else model


def _calibrated(model: LanguageModel, texts: DataFrame) -> LanguageModel:
    """The model with what is usual for texts of each language."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value.scanner()
        for batch in pieces(batches, "text", _BATCH_BYTES):
            entropy, n, letters = scanner.entropies(_texts(batch, "text"))
            some = np.flatnonzero(letters)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(some)), pa.array(n[some]),
                 pa.array(list(entropy[some]), pa.list_(pa.float64()))],
                ["lang", "n", "entropy"],
            )

    found = texts.select("lang", "text").mapInArrow(
        lambda batches: released(entropies(batches)), "lang string, n long, entropy array<double>"
    ).toArrow().to_pandas()
    usual, worst, foreign = model.usual.copy(), model.worst.copy(), model.foreign.copy()
    for i, name in enumerate(model.languages):
        value = np.array([row[i] for row in found["entropy"]])
        own = (found["lang"] == name).to_numpy()
        root = np.sqrt(np.minimum(found["n"].to_numpy(), LONG_TEXT))
        if own.any():
            usual[i] = value[own].mean()
            worst[i] = ((value - usual[i]) * root)[own].max()
        if not own.all():
            foreign[i] = value[~own].mean()
    return LanguageModel(model.alphabet, model.languages, model.models, usual, worst, foreign)


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", prefix: str = "lang_"
) -> DataFrame:
    """Add ``lang_pred``, ``lang_score`` and ``lang_rejected``; such columns are replaced.

    A null text and one without letters is ``und``, has the score 0 and is rejected; ties
    go to the first language by name. Whole texts are read and nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [f"{prefix}pred", f"{prefix}score", f"{prefix}rejected"]
    columns = [name for name in docs.columns if name not in added]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value.scanner()
        for batch in pieces(batches, text, _BATCH_BYTES):
            names, score, rejected = scanner.identify(_texts(batch, text))
            found = [pa.array(names, pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*columns, *added])

    schema = schema_text(docs, columns)
    kinds = zip(added, ("string", "double", "boolean"), strict=True)
    return docs.select(*columns).mapInArrow(
        lambda batches: released(scan(batches)),
        ", ".join([schema, *(f"`{name}` {kind}" for name, kind in kinds)]),
    )
