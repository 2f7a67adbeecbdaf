"""Quality rules over labelled lines: a linear-chain conditional random field marks each line of
a text as content or boilerplate, and the share of content decides whether the text is kept.

A line is described by measures of its own (words, symbols, capitals, repeats, how it ends) and
of its place, each cut into a few classes. The field weighs the classes and the step from one
line's label to the next one's; Viterbi decoding gives the most likely labels of all lines of a
text together. Blank lines have no label.

Labels are per document. Lines of good documents are content; those of bad ones begin as
boilerplate and are labelled anew by the field, round after round, but never all as content.

Some plain rules come first: texts of few words, and texts that repeat themselves, fail.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditgrade.llm.common import bounded_sample, byte_rows, pieces, schema_text, stored, utf8

SAMPLE_PER_CLASS = 2000
SEQUENCES_PER_CLASS = 8000
SEQUENCE_LINES = 64
ROUNDS = 3
STEPS = 120
MIN_CONTENT = 0.5
MIN_WORDS = 20
MAX_REPEATED = 30
WINDOW = 8
_RIDGE = 0.5
_RATE = 0.1
_BATCH_BYTES = 2 << 20

# Upper bounds of the classes of each measure of a line; the last class has none.
_WORDS = (1, 2, 4, 8, 16, 32, 64)
_SYMBOLS = (0, 0.01, 0.03, 0.1, 0.2)
_CAPITALS = (0, 0.02, 0.05, 0.1, 0.3, 0.6)
_DIGITS = (0, 0.02, 0.1, 0.3)
_MARKS = (0, 0.01, 0.03, 0.06, 0.12)
_ECHOES = (0, 0.05, 0.2, 0.5)
_DIFFERENT = (0.3, 0.5, 0.7, 0.9)
_LENGTH = (2, 3, 4, 6, 8, 12)
# How a line may end and begin; anything else is the last class.
_LAST = (b".", b"!", b"?", b":", b",")
_SIZES = tuple(len(b) + 1 for b in (_WORDS, _SYMBOLS, _CAPITALS, _DIGITS, _MARKS, _ECHOES, _DIFFERENT, _LENGTH, _LAST))
_SIZES += (4, 2, 3)  # first character, repeats an earlier line, place in the text
_OFFSETS = np.cumsum([0, *_SIZES[:-1]])
N_FEATURES = sum(_SIZES)


def _bytes(codes: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(codes)] = True
    return table


_SPACE = _bytes(b"\x20\x09\x0a\x0b\x0c\x0d")
_SYMBOL = _bytes(b"#*$%&|<>")
_UPPER, _LOWER, _DIGIT = (_bytes(bytes(range(a, b))) for a, b in ((0x41, 0x5B), (0x61, 0x7B), (0x30, 0x3A)))
_MARK = _bytes(bytes(range(0x21, 0x7F))) & ~(_SYMBOL | _UPPER | _LOWER | _DIGIT)


@dataclass(frozen=True)
class Measured:
    """Counts of a batch of texts, and their lines with words: features, owner, characters."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_doc: np.ndarray
    line_chars: np.ndarray
    features: np.ndarray


def _repeated(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a word lies in a window of WINDOW words that its text has twice or more.

    Runs of two, four and eight words are numbered one after another, so equal numbers are
    equal words and not only equal hashes.
    """
    covered = np.zeros(len(ids) + 1, np.int64)
    run, width = ids, 1
    while width < WINDOW and len(run) > width:
        both = run[:-width] * (int(run.max()) + 1) + run[width:]
        run = np.unique(both, return_inverse=True)[1]
        width *= 2
    if width == WINDOW and len(run):
        own = np.flatnonzero(doc[: len(run)] == doc[WINDOW - 1 : WINDOW - 1 + len(run)])
        if len(own):
            key = doc[own] * (int(run.max()) + 1) + run[own]
            _, place, times = np.unique(key, return_inverse=True, return_counts=True)
            again = own[times[place] > 1]
            np.add.at(covered, again, 1)
            np.add.at(covered, again + WINDOW, -1)
    return np.cumsum(covered[:-1]) > 0


def measure(texts: pa.Array) -> Measured:
    """Counts and line features of UTF-8 texts; words are cut at ASCII white space."""
    flat, offsets = byte_rows(texts)
    n_docs = len(offsets) - 1
    # Each text is closed by a line end.
    owner = np.repeat(np.arange(n_docs, dtype=np.int32), np.diff(offsets))
    joined = np.full(len(flat) + n_docs, 10, np.uint8)
    joined[np.arange(len(flat)) + owner] = flat
    del owner
    ends = np.flatnonzero(joined == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    doc = np.searchsorted(offsets[1:] + np.arange(n_docs), ends)
    data = joined.tobytes()

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int64) if len(starts) else np.empty(0, np.int64)

    space = _SPACE[joined]
    chars = per_line(((joined & 0xC0) != 0x80) & ~space)
    symbols, upper, digits = (per_line(table[joined]) for table in (_SYMBOL, _UPPER, _DIGIT))
    letters, marks = upper + per_line(_LOWER[joined]), per_line(_MARK[joined])
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])[: len(space)])
    stops = np.flatnonzero(~space & np.append(space[1:], True)[: len(space)])
    line = np.searchsorted(ends, begins)
    words = np.bincount(line, minlength=len(ends))
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    ids = np.fromiter(map(known.__getitem__, data.split()), np.int64, len(begins))
    word_doc = doc[line]
    repeated = _repeated(ids, word_doc)

    dup = np.zeros(len(ends), np.int64)
    seen: set[bytes] = set()
    last = -1
    for n, (one, of, many) in enumerate(zip(data.split(b"\n"), doc.tolist(), words.tolist(), strict=False)):
        if of != last:
            seen, last = set(), of
        if many:
            if one in seen:
                dup[n] = 1
            else:
                seen.add(one)

    def total(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        out = np.zeros(n_docs, np.int64)
        np.add.at(out, of, values)
        return out

    kept = np.flatnonzero(words)
    echo = np.zeros(len(ids), bool)
    echo[1:] = (ids[1:] == ids[:-1]) & (line[1:] == line[:-1])
    pair = np.unique(line * max(1, len(known)) + ids)
    different = np.bincount(pair // max(1, len(known)), minlength=len(ends))
    final = np.cumsum(words)[kept] - 1
    head, tail = joined[begins[final - words[kept] + 1]], joined[stops[final]]
    ending = np.full(256, len(_LAST))
    ending[[code[0] for code in _LAST]] = np.arange(len(_LAST))
    start = np.select([_UPPER[head], _LOWER[head] | (head >= 0x80), _DIGIT[head]], [0, 1, 2], 3)
    line_doc = doc[kept]
    change = line_doc[1:] != line_doc[:-1] if len(kept) else np.empty(0, bool)
    place = np.where(np.append(change, True)[: len(kept)], 2, 1)
    place[np.concatenate([[True], change])[: len(kept)]] = 0

    n, size = words[kept], np.maximum(chars[kept], 1)
    shares = [
        (n, _WORDS), (symbols[kept] / size, _SYMBOLS), (upper[kept] / np.maximum(letters[kept], 1), _CAPITALS),
        (digits[kept] / size, _DIGITS), (marks[kept] / size, _MARKS),
        (np.bincount(line[echo], minlength=len(ends))[kept] / n, _ECHOES),
        (np.where(n < 8, 1.0, different[kept] / n), _DIFFERENT), (size / n, _LENGTH),
    ]
    columns = [np.searchsorted(bounds, value) for value, bounds in shares]
    columns += [ending[tail], start, dup[kept], place]
    features = (np.stack(columns, axis=1) + _OFFSETS).astype(np.uint8)
    return Measured(
        total(words, doc), total(chars, doc), total(symbols, doc), total(dup, doc),
        total(repeated, word_doc), line_doc, chars[kept], features,
    )


@dataclass(frozen=True)
class LineModel:
    """Weights for boilerplate against content, and for the steps between labels."""

    weights: np.ndarray
    steps: np.ndarray  # from label (0 content, 1 boilerplate) to label
    start: float

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The most likely labels of a text's lines; content where two are as likely."""
        (stay0, to1), (to0, stay1) = self.steps.tolist()
        lead, from1 = 0.0, []
        for n, value in enumerate(self.weights[features].sum(axis=1).tolist()):
            # By how much boilerplate is ahead of content, and where each comes from.
            if n:
                best0, best1 = max(stay0, lead + to0), max(to1, lead + stay1)
                from1.append((lead + to0 > stay0, lead + stay1 > to1))
                lead = best1 - best0 + value
            else:
                lead = self.start + value
        labels = [lead > 0]
        for back in reversed(from1):
            labels.append(back[labels[-1]])
        return np.array(labels[::-1] if len(features) else [], np.int64)


def _forward_backward(
    scores: np.ndarray, inside: np.ndarray, steps: np.ndarray, start: float
) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum of the logarithms of the partition functions of padded sequences, each line's
    probability of boilerplate, and the expected steps. ``scores`` are those of boilerplate."""
    n, length = scores.shape
    emit = np.stack([np.zeros_like(scores), scores], axis=2)
    ahead, behind = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    ahead[:, 0] = emit[:, 0] + [0.0, start]
    for t in range(1, length):
        now = np.logaddexp.reduce(ahead[:, t - 1, :, None] + steps, axis=1) + emit[:, t]
        ahead[:, t] = np.where(inside[:, t, None], now, ahead[:, t - 1])
    total = np.logaddexp.reduce(ahead[:, -1], axis=1)
    for t in range(length - 2, -1, -1):
        now = np.logaddexp.reduce(steps + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
        behind[:, t] = np.where(inside[:, t + 1, None], now, behind[:, t + 1])
    likely = np.exp(ahead[..., 1] + behind[..., 1] - total[:, None]) * inside
    pairs = np.zeros((2, 2))
    for t in range(1, length):
        joint = ahead[:, t - 1, :, None] + steps + (emit[:, t] + behind[:, t])[:, None, :]
        pairs += (np.exp(joint - total[:, None, None]) * inside[:, t, None, None]).sum(axis=0)
    return float(total.sum()), likely, pairs


def objective(
    model: LineModel, features: np.ndarray, inside: np.ndarray, labels: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray, float]:
    """The labels' log likelihood less a ridge, and its gradient by weights, steps and start.

    ``features`` are padded to sequences x lines x features, ``inside`` says which lines are there.
    """
    scores = model.weights[features].sum(axis=2) * inside
    total, likely, pairs = _forward_backward(scores, inside, model.steps, model.start)
    own = labels * inside
    both = inside[:, 1:]
    seen = np.array([[((labels[:, :-1] == a) & (labels[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)])
    value = (scores * own).sum() + (seen * model.steps).sum() + model.start * own[:, 0].sum() - total
    left = np.repeat((own - likely)[inside], features.shape[2])
    by_weight = np.bincount(features[inside].ravel(), left, N_FEATURES)
    value -= _RIDGE / 2 * ((model.weights**2).sum() + (model.steps**2).sum() + model.start**2)
    return (
        value, by_weight - _RIDGE * model.weights, seen - pairs - _RIDGE * model.steps,
        float((own - likely)[:, 0].sum()) - _RIDGE * model.start,
    )


def _climb(model: LineModel, features: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> LineModel:
    """Gradient ascent with steps scaled by the gradients seen so far (Adam)."""
    vector = np.concatenate([model.weights, model.steps.ravel(), [model.start]])
    mean, square = np.zeros_like(vector), np.zeros_like(vector)
    for n in range(1, STEPS + 1):
        _, weights, steps, start = objective(model, features, inside, labels)
        gradient = np.concatenate([weights, steps.ravel(), [start]]) / max(1, len(features))
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        vector = vector + _RATE * (mean / (1 - 0.9**n)) / (np.sqrt(square / (1 - 0.99**n)) + 1e-8)
        model = LineModel(vector[:N_FEATURES], vector[N_FEATURES:-1].reshape(2, 2), float(vector[-1]))
    return model


def fit(sequences: list[np.ndarray], bad: np.ndarray) -> LineModel:
    """The field from sequences of lines of good and bad documents; see the module's docstring."""
    lengths = np.array([len(one) for one in sequences])
    inside = np.arange(lengths.max()) < lengths[:, None]
    features = np.zeros((*inside.shape, len(_SIZES)), np.uint8)
    features[inside] = np.concatenate(sequences)
    labels = np.where(inside, bad[:, None], 0).astype(np.int64)
    model = LineModel(np.zeros(N_FEATURES), np.zeros((2, 2)), 0.0)
    for n in range(ROUNDS):
        model = _climb(model, features, inside, labels)
        if n < ROUNDS - 1:
            for i in np.flatnonzero(bad):
                found = model.decode(sequences[i])
                labels[i, : lengths[i]] = found if found.any() else 1
    return model


def _packed_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences of at most SEQUENCE_LINES lines: the document's hash, their number, features."""
    for batch in pieces(batches, "_text", _BATCH_BYTES):
        found = measure(batch.column("_text"))
        bounds = np.searchsorted(found.line_doc, np.arange(batch.num_rows + 1))
        rows = []
        for n, (bad, doc) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("bad", "doc")), strict=True)):
            for k in range(bounds[n], bounds[n + 1], SEQUENCE_LINES):
                own = found.features[k : min(k + SEQUENCE_LINES, bounds[n + 1])]
                rows.append((bad, f"{doc}:{k - bounds[n]}", own.tobytes()))
        names, kinds = ["bad", "place", "lines"], [pa.int32(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_class: int = SAMPLE_PER_CLASS, sequences_per_class: int = SEQUENCES_PER_CLASS,
) -> LineModel | None:
    """The field, from labels 1 (good) and 0 (bad) of documents; None unless there are both.

    Learns from at most ``per_class`` documents of each label, and of these from at most
    ``sequences_per_class`` runs of SEQUENCE_LINES lines. Documents whose labels are null,
    other numbers or contradict each other teach nothing.
    """
    each = labels.groupBy(F.col(key).alias("_labelled")).agg(F.min(label).alias("low"), F.max(label).alias("high"))
    each = each.filter("_labelled IS NOT NULL AND low = high AND low IN (0, 1)")
    each = each.selectExpr("_labelled", "1 - int(low) AS bad")
    chosen = stored(bounded_sample(each, "bad", "_labelled", per_class, 13), "lines-labelled").drop("n")
    texts = docs.select(F.col(key).alias("_key"), utf8(text).alias("_text"))
    own = texts.join(chosen, F.col("_key") == F.col("_labelled"))
    own = own.select(F.xxhash64("_key", "_text").alias("doc"), "bad", "_text")
    packed = stored(own.mapInArrow(_packed_lines, "bad int, place string, lines binary"), "lines-sequences")
    rows = bounded_sample(packed.distinct(), "bad", "place", sequences_per_class, 17)
    rows = rows.select("bad", "place", "lines").toArrow().sort_by([("place", "ascending"), ("bad", "ascending")])
    bad = rows.column("bad").to_numpy()
    if len(set(bad.tolist())) < 2:
        return None
    width = len(_SIZES)
    sequences = [np.frombuffer(one, np.uint8).reshape(-1, width) for one in rows.column("lines").to_pylist()]
    return fit(sequences, bad)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_content")
_ADDED = (*_COUNTS, "content_share", "base_failed", "kept")


def judge(
    docs: DataFrame, model: LineModel | None, text: str = "text", min_content: float = MIN_CONTENT,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all, if not given) with the counts, ``content_share``, ``base_failed`` and ``kept``.

    ``content_share`` is the share of the characters of a text's words that lie in lines marked
    as content, 0 without words; ``n_lines`` and ``n_content`` count lines with words. A text
    fails with less than MIN_WORDS words, or if more than MAX_REPEATED per cent of its words
    lie in windows of WINDOW words that it has twice. It is kept if it does not fail and the
    share reaches ``min_content``. Without a model all lines are content. Null texts are empty;
    columns of these names are replaced. Nothing is shuffled.
    """
    columns = [name for name in (docs.columns if keep is None else keep) if name not in _ADDED]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", _BATCH_BYTES):
            found = measure(batch.column("_text"))
            rows = np.arange(batch.num_rows)
            bounds = np.searchsorted(found.line_doc, np.append(rows, batch.num_rows))
            marked = np.zeros(len(found.line_doc), np.int64)
            if model is not None:
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    if a < b:
                        marked[a:b] = model.decode(found.features[a:b])
            content = np.bincount(found.line_doc, found.line_chars * (1 - marked), len(rows))
            share = content / np.maximum(found.word_chars, 1)
            failed = (found.n_words < MIN_WORDS) | (100 * found.n_repeat_words > MAX_REPEATED * found.n_words)
            n_lines = np.bincount(found.line_doc, minlength=len(rows))
            n_content = n_lines - np.bincount(found.line_doc[marked == 1], minlength=len(rows))
            values = [
                found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words,
                n_lines, n_content, share, failed, ~failed & (share >= min_content),
            ]
            own = [batch.column(n) for n in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*own, *map(pa.array, values)], [*columns, *_ADDED])

    schema = ", ".join([schema_text(docs, columns), *(f"{name} long" for name in _COUNTS)][not columns :])
    wide = docs.select(*columns, utf8(text).alias("_text"))
    return wide.mapInArrow(scan, f"{schema}, content_share double, base_failed boolean, kept boolean")
