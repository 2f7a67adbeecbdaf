"""Toxicity by a support vector machine over a string kernel.

A sentence is a bag of words, and a document is as toxic as its most toxic word. Words are
compared by a subsequence kernel: the letter triples they share, in order but with gaps,
a triple weighing less the wider it is spread. So an insult with letters left out of place,
inserted or appended is still near to the insult. Other characters than letters are left
out before, and letters that stand alone are read as one word.

The kernel is approximated by Nyström landmarks: words are described by their kernel values
with some landmark words, and the machine is linear in that space. As a kernel value is a
sum over triples, so is the machine's value: after training it is a table of triples, and
scoring a text needs no landmark. Each letter of a landmark is a symbol of its own; all other
letters share one, which changes no value, as no triple with them is in the table.

Labels are per document. Training alternates between picking each toxic document's witness,
its most toxic word so far, and fitting the machine to tell the witnesses from the words of
other documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditgrade.llm.common import bounded_sample, letter_table, pieces, schema_text, stored

SAMPLE_PER_CLASS = 2000
CALIBRATION_PART = 4
LANDMARKS = 160
NEGATIVES = 12_000
ROUNDS = 4
SPAN = 6
DECAY = 0.7
COST = 10.0
UNIT = 16
_BITS = 21  # as many as a code point has, so that any alphabet fits
COPY_HASHES = 8
_OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_BATCH_BYTES = 2 << 20
_MEMORY = 500_000
_SPACED = re.compile(r"(?<!\S)\w(?:[ .*_-]\w){2,}(?!\S)")
_NONE = -1e9


def words_of(text: str) -> set[str]:
    """The different words of a text, and words written letter by letter."""
    lower = text.lower()
    found = set(lower.split())
    if spaced := _SPACED.findall(lower):
        found.update(re.sub(r"[\W_]", "", word) for word in spaced)
    return found


def _alphabet(words: list[str]) -> list[int]:
    """The different letters of words."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32)
    return [code for code in np.unique(letter_table()[flat]).tolist() if code]


def _places(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key is among the sorted known ones, from 1; 0 if it is not."""
    if not len(known):
        return np.zeros(keys.shape, np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, at + 1, 0)


class Kernel:
    """Symbols of words and sums over their triples."""

    def __init__(self, alphabet: list[int]) -> None:
        symbol = np.ones(0x110000, np.int32)
        symbol[0] = 0
        symbol[alphabet] = np.arange(2, 2 + len(alphabet))
        self.symbols = symbol[letter_table()]

    def units(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of at most UNIT symbols, padded with 0, and the word each comes from.

        A longer word is read in overlapping pieces. A word without letters has no row.
        """
        flat = np.frombuffer("\n".join([*words, ""]).encode("utf-32-le", "replace"), np.uint32)
        word = np.concatenate([[0], np.cumsum(flat == 10)])[: len(flat)]
        symbol = self.symbols[flat]
        kept = symbol > 0
        symbol, word = symbol[kept], word[kept]
        n = np.bincount(word, minlength=len(words))
        first = np.cumsum(n) - n
        rows = np.where(n > 0, 1 + np.maximum(0, -(-(n - UNIT) // (UNIT // 2))), 0)
        owner = np.repeat(np.arange(len(words)), rows)
        step = (np.arange(len(owner)) - np.repeat(np.cumsum(rows) - rows, rows)) * (UNIT // 2)
        start = first[owner] + step
        place = start[:, None] + np.arange(UNIT)
        inside = place < (first + n)[owner][:, None]
        table = np.where(inside, np.append(symbol, 0)[np.minimum(place, len(symbol))], 0)
        return table.astype(np.int64), owner

    @staticmethod
    def triples(units: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
        """Packed triples and their weight, for each way to spread one; 0 is no triple."""
        for a, b in _OFFSETS:
            x, y, z = units[:, :-b], units[:, a : UNIT - b + a], units[:, b:]
            yield np.where(z > 0, (x << 2 * _BITS) | (y << _BITS) | z, 0), DECAY ** (b - 2)

    @classmethod
    def sizes(cls, units: np.ndarray) -> np.ndarray:
        """What a unit's sums are divided by: the length of its triples' weights."""
        total = sum(weight**2 * (keys > 0).sum(axis=1) for keys, weight in cls.triples(units))
        return np.sqrt(np.maximum(total, 1.0))

    @classmethod
    def known(cls, units: np.ndarray) -> np.ndarray:
        """The different triples of units, sorted."""
        every = np.unique(np.concatenate([keys.ravel() for keys, _ in cls.triples(units)]))
        return every[every > 0]

    @classmethod
    def sums(cls, units: np.ndarray, known: np.ndarray, table: np.ndarray) -> np.ndarray:
        """The machine's value of each unit from its known triples; ``table`` starts with 0
        for the others."""
        total = sum(weight * table[_places(known, keys)].sum(axis=1) for keys, weight in cls.triples(units))
        return total / cls.sizes(units)

    @classmethod
    def values(cls, units: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
        """Kernel values of units with landmarks, both as rows of symbols."""
        known = cls.known(landmarks)
        weights = np.zeros((len(known) + 1, len(landmarks)), np.float32)
        of = np.arange(len(landmarks))[:, None]
        for keys, weight in cls.triples(landmarks):
            np.add.at(weights, (_places(known, keys), np.broadcast_to(of, keys.shape)), weight)
        weights[0] = 0
        weights /= cls.sizes(landmarks)
        out = np.zeros((len(units), len(landmarks)), np.float32)
        for start in range(0, len(units), 4096):
            some = units[start : start + 4096]
            for keys, weight in cls.triples(some):
                for column in _places(known, keys).T:
                    out[start : start + 4096] += np.float32(weight) * weights[column]
        return out / cls.sizes(units)[:, None]


@dataclass(frozen=True)
class ToxicityModel:
    """The machine as triples with weights; ``slope`` and ``shift`` give the probability."""

    alphabet: list[int]
    triples: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float


class Scorer:
    """Values of words, remembered, and of documents."""

    def __init__(self, model: ToxicityModel) -> None:
        self.model = model
        self.kernel = Kernel(model.alphabet)
        self.table = np.concatenate([np.zeros(1, np.float32), model.weights])
        self.known: dict[str, float] = {}

    def values(self, texts: list[str | None]) -> np.ndarray:
        """The value of each text's most toxic word; a very low one without words."""
        bags = [words_of(text or "") for text in texts]
        new = [word for word in set().union(*bags) if word not in self.known]
        if len(self.known) + len(new) > _MEMORY:
            self.known.clear()
            new = list(set().union(*bags))
        self.known.update(zip(new, self.word_values(new).tolist(), strict=True))
        return np.array([max(map(self.known.__getitem__, bag), default=_NONE) for bag in bags])

    def word_values(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), _NONE)
        for start in range(0, len(words), 65536):
            units, owner = self.kernel.units(words[start : start + 65536])
            np.maximum.at(out, owner + start, self.kernel.sums(units, self.model.triples, self.table))
        return out

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(-self.model.slope * self.values(texts) - self.model.shift, -500, 500)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps; the last weight is the bias."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-6
    cost = COST * weight

    def loss(w: np.ndarray) -> float:
        return 0.5 * (ridge * w * w).sum() + (cost * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(100):
        active = y * (x @ w) < 1
        a, c = x[active], 2 * cost[active]
        slope = ridge * w + a.T @ (c * (a @ w - y[active]))
        step = np.linalg.solve(np.diag(ridge) + (a * c[:, None]).T @ a, slope)
        size = 1.0
        while size > 1e-6 and (new := loss(w - size * step)) > now - 1e-4 * size * slope @ step:
            size /= 2
        if size <= 1e-6 or now - new < 1e-7 * now:
            break
        w, now = w - size * step, new
    return w


def _platt(value: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through labelled values."""
    n = np.array([(label == 0).sum(), (label == 1).sum()])
    target = np.where(label == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    x = np.column_stack([value, np.ones(len(value))])
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (target - p)) - 1e-4 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w = w + step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` labelled texts of each class, and the classes' whole numbers."""
    each = labels.filter(f"{key} IS NOT NULL AND {label} IS NOT NULL").groupBy(key).agg(
        F.max(F.col(label).cast("int")).alias("label")
    )
    each = stored(each, "toxicity-labels")
    numbers = {r["label"]: r["count"] for r in each.groupBy("label").count().collect()}
    chosen = bounded_sample(each.filter("label IN (0, 1)"), "label", key, per_class, 9)
    chosen = chosen.selectExpr(f"{key} AS _id", "label", f"n % {CALIBRATION_PART} AS part")
    chosen = stored(chosen, "toxicity-ids")
    texts = docs.join(chosen, F.col(key) == F.col("_id")).select("_id", "label", "part", text)
    return stored(texts.withColumnRenamed(text, "text"), "toxicity-sample"), numbers


def _bags(sample: DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Words of each toxic text, and words of the others with their number of texts.

    Copies of a text would make all of its words look toxic. Texts whose words have the
    same COPY_HASHES smallest hashes, as copies and most near copies do, count as one text.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", _BATCH_BYTES):
            rows = []
            labels = batch.column("label").to_pylist()
            for label, text in zip(labels, batch.column("text").to_pylist(), strict=True):
                words = words_of(text or "")
                least = sorted(map(xxhash.xxh3_64_intdigest, words))[:COPY_HASHES]
                copy = xxhash.xxh3_64_intdigest(np.array(least, np.uint64).tobytes()) >> 1
                rows += [(copy, label, word) for word in words]
            i, label, word = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int64()), pa.array(label, pa.int32()), pa.array(word, pa.string())],
                ["id", "label", "word"],
            )

    words = stored(
        sample.filter("part > 0")
        .select("label", "text")
        .mapInArrow(scan, "id long, label int, word string"),
        "toxicity-words",
    )
    words = words.distinct()
    toxic = words.filter("label = 1").select("id", "word").toArrow().to_pandas()
    clean = words.filter("label = 0").groupBy("word").count().toArrow().to_pandas()
    return toxic.sort_values(["id", "word"]), clean.sort_values("word").reset_index(drop=True)


def _fit(toxic: pd.DataFrame, clean: pd.DataFrame) -> ToxicityModel:
    """The machine without its probability curve."""
    rng = np.random.default_rng(11)

    of_toxic = toxic.groupby("word").size()
    in_clean = clean.set_index("word")["count"]
    of_clean = in_clean.reindex(of_toxic.index, fill_value=0)
    odds = np.log(of_toxic + 0.5) - np.log(of_clean + 0.5)
    # A witness has to be more frequent in toxic texts than in others.
    toxic = toxic[toxic["word"].map(odds).to_numpy() > 0.5]
    # What surely is: odds less their own uncertainty.
    odds -= 1.5 * np.sqrt(1 / (of_toxic + 0.5) + 1 / (of_clean + 0.5))
    odds = odds[[len(word) > 2 for word in odds.index]].sort_values(ascending=False, kind="stable")
    names = clean["word"].to_numpy()
    some = rng.choice(len(names), min(len(names), NEGATIVES), replace=False) if len(names) else []
    often = clean.sort_values(["count", "word"], ascending=[False, True])["word"].tolist()
    negative = set(names[some]) | set(often[: NEGATIVES // 4])
    half = LANDMARKS // 2
    chosen = [*odds.index[:half], *often[: half // 2], *sorted(negative)[: half - half // 2]]
    alphabet = _alphabet(chosen)
    kernel = Kernel(alphabet)
    marks, _ = kernel.units(list(dict.fromkeys(chosen)))
    marks = np.unique(marks, axis=0)
    triples = kernel.known(marks)
    value, base = np.linalg.eigh(kernel.values(marks, marks).astype(np.float64))
    kept = value > 1e-6 * value.max()
    whiten = base[:, kept] / np.sqrt(value[kept])

    score = odds.to_dict()
    model = None
    for _ in range(ROUNDS):
        best = toxic.assign(score=toxic["word"].map(score).fillna(_NONE))
        best = best[best["score"] > _NONE].sort_values("score", kind="stable")
        times = best.groupby("id")["word"].last().value_counts().to_dict()
        # Words that are surely toxic stay, also where no text needs them as a witness.
        times |= {word: times.get(word, 0) + 1 for word in odds.index[(odds > 1).to_numpy()]}
        positive = sorted(times)
        units, owner = kernel.units(positive + (others := sorted(negative)))
        x = kernel.values(units, marks) @ whiten
        y = np.where(owner < len(positive), 1.0, -1.0)
        witnessed = np.array([times[word] for word in positive])
        weight = np.ones(len(y))
        weight[y > 0] = np.sqrt(witnessed[owner[y > 0]])
        weight[y < 0] = np.sqrt(in_clean[others].to_numpy()[owner[y < 0] - len(positive)])
        for side in (1, -1):
            weight[y == side] *= 2000 / max(1.0, weight[y == side].sum())
        w = _svm(x, y, weight)
        table = np.zeros(len(triples) + 1)
        of_mark = whiten @ w[:-1] / kernel.sizes(marks)
        for keys, spread in kernel.triples(marks):
            np.add.at(table, _places(triples, keys), of_mark[:, None] * spread)
        model = ToxicityModel(alphabet, triples, table[1:].astype(np.float32), 1.0, 0.0)
        scorer = Scorer(model)
        score = dict(zip(odds.index, scorer.word_values(odds.index.tolist()), strict=True))
        if len(names):
            hardest = np.argsort(-scorer.word_values(names.tolist()), kind="stable")
            negative |= set(names[hardest[: NEGATIVES // 4]])
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = SAMPLE_PER_CLASS,
) -> ToxicityModel:
    """Fit on at most ``per_class`` labelled texts of each class.

    The sample bounds what comes to the driver: the different words of these texts. Three
    of four sampled texts fit the machine, the fourth its probabilities, weighed as often as
    their class occurs among all labels. Of several labels of a text the higher one counts.
    If a class is missing, every text gets the share of the other one.
    """
    sample, numbers = _sample(docs, labels, key, text, label, per_class)
    toxic, clean = _bags(sample)
    if toxic.empty or clean.empty:
        share = (numbers.get(1, 0) + 0.5) / (numbers.get(0, 0) + numbers.get(1, 0) + 1)
        if not numbers:
            share = 0.0 + 1e-9
        return ToxicityModel([], np.empty(0, np.int64), np.empty(0, np.float32), 0.0, float(np.log(share / (1 - share))))
    model = _fit(toxic, clean)
    found = valued(sample.filter("part = 0"), model, "text").select("label", "value").toArrow().to_pandas()
    found = found[found["value"] > _NONE]
    if found["label"].nunique() < 2:
        found = valued(sample, model, "text").select("label", "value").toArrow().to_pandas()
        found = found[found["value"] > _NONE]
    weight = found["label"].map(lambda c: numbers[c] / max(1, (found["label"] == c).sum()))
    weight = (weight / weight.mean()).to_numpy()
    slope, shift = _platt(found["value"].to_numpy(), found["label"].to_numpy(), weight)
    return ToxicityModel(model.alphabet, model.triples, model.weights, max(slope, 0.0), shift)


def _scan(docs: DataFrame, model: ToxicityModel, text: str, name: str, probability: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [column for column in docs.columns if column != name]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in pieces(batches, text, _BATCH_BYTES):
            texts = batch.column(text).to_pylist()
            found = scorer.probabilities(texts) if probability else scorer.values(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*columns, name])

    return docs.select(*columns).mapInArrow(scan, f"{schema_text(docs, columns)}, {name} double")


def valued(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add ``value``, what the machine says of the most toxic word."""
    return _scan(docs, model, text, "value", False)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add ``toxicity``, from 0 to 1; a column of that name is replaced.

    Null and empty texts and texts without letters are scored 0, or the share of toxic
    texts where the model could not be fitted. Whole texts are read, nothing is shuffled.
    """
    return _scan(docs, model, text, "toxicity", True)
