"""Texts scored by a word model with interpolated modified Kneser-Ney smoothing.

The model predicts each word from the one before it. Words and word pairs are counted in
Spark and kept as arrays sorted by hash in the shared folder, cut into shards by hash. The
tasks that score texts map these files into memory, so that a task reads the pages it looks
at, and all tasks of a machine share them.

Counting never sends single words around: a task merges what it has read into sorted arrays
of hashes with counts, one piece per shard. Words are told apart by 64-bit hashes.

Everything that is kept of a word is a sum over pairs, so it doesn't matter in which shard a
pair lies. Pairs are dealt by their first word, which keeps the pieces small, but those of
very frequent first words by the whole pair: no shard gets all pairs of one word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditgrade.llm.common import (
    in_every_shard,
    mix,
    mounted,
    pieces,
    save_array,
    schema_text,
    scratch_path,
    shards_for,
    stored,
    text_bytes,
)

SHARD_BYTES = 16 << 20
FREQUENT = 4
_FLUSH = 3_000_000
_BATCH_BYTES = 4 << 20
_MEMORY = 1_000_000
# Hashes of what stands for the start and the end of a text; no word has these as bytes.
_START, _END = (np.uint64(xxhash.xxh3_64_intdigest(name)) for name in (b" start", b" end"))
_PIECE = "shard int, piece binary"
# Of a word: different words before it; pairs it begins, and how many occur once, twice, more.
_SUMS = ("before", "total", "one", "two", "more")


class _WordHashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMORY:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def word_hashes(texts: list, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' words, each text closed by the end, and where texts start.

    Words are cut at ASCII white space, A-Z lower-cased.
    """
    parts, starts, n = [], np.zeros(len(texts) + 1, np.int64), 0
    for i, text in enumerate(texts):
        words = (text or "").encode("utf-8", "replace").lower().split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        parts.append(np.array([_END], np.uint64))
        n += len(words) + 1
        starts[i + 1] = n
    return np.concatenate([*parts, np.empty(0, np.uint64)]), starts


def contexts(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The word before each word, the start before the first of a text."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[starts[:-1]] = _START
    return before


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash of two."""
    return mix(mix(first) + second)


def _shard(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Equal ranges of hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(n_shards) >> np.uint64(32)).astype(np.int64)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted different keys, and the sums of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    sums = [np.add.reduceat(value[order], heads) if len(keys) else value for value in values]
    return keys[heads], *sums


def _packed(columns: dict[str, np.ndarray]) -> bytes:
    """Arrays of one length as one compressed value, counts in as few bytes as they need."""
    arrays = {}
    for name, array in columns.items():
        if array.dtype == np.int64:
            array = array.astype(np.min_scalar_type(int(array.max(initial=0))))
        arrays[name] = pa.array(array)
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pydict(arrays)
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


_NONE = {"h": np.empty(0, np.uint64), "n": np.empty(0, np.int64)}
_NO_WORDS = _packed(_NONE)
_NO_PAIRS = _packed({"h1": _NONE["h"], "h2": _NONE["h"], "n": _NONE["n"]})
_NO_CONTEXTS = _packed({"h": _NONE["h"]} | {name: _NONE["n"] for name in _SUMS})


def _unpacked(pieces_: list[bytes]) -> dict[str, np.ndarray]:
    tables = [pa.ipc.open_stream(piece).read_all() for piece in pieces_]
    names = tables[0].column_names
    out = {}
    for name in names:
        parts = [table.column(name).to_numpy() for table in tables]
        wide = np.uint64 if parts[0].dtype == np.uint64 and name.startswith("h") else np.int64
        out[name] = np.concatenate([part.astype(wide) for part in parts])
    return out


def _dealt(columns: dict[str, np.ndarray], shard: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One packed piece per shard; ``shard`` need not be sorted."""
    order = np.argsort(shard, kind="stable")
    ids, heads = np.unique(shard[order], return_index=True)
    bounds = [*heads.tolist(), len(order)]
    for n, shard_id in enumerate(ids.tolist()):
        own = order[bounds[n] : bounds[n + 1]]
        piece = _packed({name: array[own] for name, array in columns.items()})
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard_id], pa.int32()), pa.array([piece], pa.binary())], ["shard", "piece"]
        )


def _flushes(
    batches: Iterator[pa.RecordBatch], text: str
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words and the words before them, some millions at a time."""
    known, words, before, n = _WordHashes(), [], [], 0
    for batch in pieces(batches, text, _BATCH_BYTES):
        own, starts = word_hashes(batch.column(text).to_pylist(), known)
        words.append(own)
        before.append(contexts(own, starts))
        n += len(own)
        if n >= _FLUSH:
            yield np.concatenate(words), np.concatenate(before)
            words, before, n = [], [], 0
    if n:
        yield np.concatenate(words), np.concatenate(before)


def _kinds(counts: np.ndarray) -> list[np.ndarray]:
    """Ones for counts of one, of two and of more."""
    return [(counts == 1).astype(np.int64), (counts == 2).astype(np.int64), (counts > 2).astype(np.int64)]


@dataclass(frozen=True)
class NgramModel:
    """Where the arrays lie, and the totals over all shards."""

    folder: str
    word_shards: int
    pair_shards: int
    frequent: np.ndarray  # first words whose pairs are dealt by the whole pair
    tokens: int
    words: int
    pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_kinds: tuple[int, int, int]  # words with one, two, more different words before them

    def pair_shard(self, first: np.ndarray, pair: np.ndarray) -> np.ndarray:
        return pair_shards(first, pair, self.frequent, self.pair_shards)


def pair_shards(
    first: np.ndarray, pair: np.ndarray, frequent: np.ndarray, n_shards: int
) -> np.ndarray:
    often = np.isin(first, frequent)
    return _shard(np.where(often, pair, mix(first)), n_shards)


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """Discounts of counts of one, two and more, from the numbers of counts 1 to 4.

    Where a number is missing they fall back to a half of it, one, and one and a half.
    """
    if not (ones and twos and threes):
        return 0.5, 1.0, 1.5
    y = ones / (ones + 2 * twos)
    found = (1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, start=1))


def _discount_of(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.asarray([0.0, *by])[np.minimum(counts, 3)]


def train(docs: DataFrame, text: str = "text", shard_bytes: int = SHARD_BYTES) -> NgramModel:
    """Count words and pairs of all texts and write the model to the shared folder.

    Null texts count as empty: each text has an end. Without texts the model knows no word.
    """
    spark = docs.sparkSession
    folder = mounted(scratch_path(spark, "ngram"))
    n_shards = shards_for(text_bytes(docs, text), shard_bytes)
    texts = docs.select(text)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in _flushes(batches, text):
            keys, n = _summed(words, np.ones(len(words), np.int64))
            yield from _dealt({"h": keys, "n": n}, _shard(keys, n_shards))

    def merge_words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        own = _unpacked(table.column("piece").to_pylist())
        keys, n = _summed(own["h"], own["n"])
        save_array(f"{folder}/words", f"{shard}-hash", keys)
        save_array(f"{folder}/words", f"{shard}-count", n)
        top = np.argsort(-n, kind="stable")[: FREQUENT * n_shards]
        return pa.table({"tokens": [int(n.sum())], "words": [len(n)],
                         "top": [keys[top].view(np.int64)], "top_n": [n[top]]})

    counted = stored(
        in_every_shard(texts.mapInArrow(count_words, _PIECE), n_shards, _NO_WORDS).groupBy("shard").applyInArrow(
            merge_words, "tokens long, words long, top array<long>, top_n array<long>"
        ), "ngram-words",
    )
    sums = counted.agg(F.sum("tokens").alias("t"), F.sum("words").alias("w")).first()
    tokens, words = int(sums["t"] or 0), int(sums["w"] or 0)
    # At most FREQUENT words per shard have that share of all tokens.
    often = (
        counted.selectExpr("explode(arrays_zip(top, top_n)) AS z")
        .filter(F.col("z.top_n") * FREQUENT * n_shards > tokens)
        .selectExpr("z.top AS h").collect()
    )
    frequent = np.array(sorted([row["h"] for row in often]), np.int64).view(np.uint64)
    frequent = np.concatenate([frequent, np.array([_START], np.uint64)])

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for second, first in _flushes(batches, text):
            order = np.lexsort((second, first))
            first, second = first[order], second[order]
            change = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            heads = np.flatnonzero(np.concatenate([[True], change]))
            n = np.diff(np.append(heads, len(first)))
            first, second = first[heads], second[heads]
            shard = pair_shards(first, pair_key(first, second), frequent, n_shards)
            yield from _dealt({"h1": first, "h2": second, "n": n}, shard)

    def merge_pairs(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        own = _unpacked(table.column("piece").to_pylist())
        if not len(own["n"]):
            save_array(f"{folder}/pairs", f"{shard}-hash", own["h1"])
            save_array(f"{folder}/pairs", f"{shard}-count", own["n"])
            nothing = pa.array([], pa.list_(pa.int64()))
            return pa.table([pa.array([], pa.int32()), pa.array([], pa.binary()), nothing,
                             pa.array([], pa.int64())], ["shard", "piece", "few", "pairs"])
        keys = pair_key(own["h1"], own["h2"])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        n = np.add.reduceat(own["n"][order], heads)
        first, second = own["h1"][order][heads], own["h2"][order][heads]
        save_array(f"{folder}/pairs", f"{shard}-hash", keys[heads])
        save_array(f"{folder}/pairs", f"{shard}-count", n.astype(np.min_scalar_type(int(n.max()))))
        kinds = _kinds(n)
        before, *after = _summed(first, n, *kinds)
        later, different = _summed(second, np.ones(len(second), np.int64))
        none_before, none_later = np.zeros(len(before), np.int64), np.zeros(len(later), np.int64)
        keys, *sums = _summed(
            np.concatenate([before, later]),
            np.concatenate([none_before, different]),
            *(np.concatenate([values, none_later]) for values in after),
        )
        columns = dict(zip(("h", *_SUMS), (keys, *sums), strict=True))
        few = [int((n == k).sum()) for k in (1, 2, 3, 4)]
        out = pa.Table.from_batches(list(_dealt(columns, _shard(keys, n_shards))))
        out = out.append_column("few", pa.array([few] + [[0] * 4] * (out.num_rows - 1)))
        return out.append_column("pairs", pa.array([len(n)] + [0] * (out.num_rows - 1)))

    paired = in_every_shard(texts.mapInArrow(count_pairs, _PIECE), n_shards, _NO_PAIRS)
    paired = paired.groupBy("shard").applyInArrow(
        merge_pairs, f"{_PIECE}, few array<long>, pairs long"
    )
    paired = stored(paired, "ngram-pairs")

    def merge_contexts(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        own = _unpacked(table.column("piece").to_pylist())
        keys, *sums = _summed(own["h"], *(own[name] for name in _SUMS))
        columns = np.stack(sums, axis=1) if len(keys) else np.empty((0, 5), np.int64)
        save_array(f"{folder}/contexts", f"{shard}-hash", keys)
        save_array(f"{folder}/contexts", f"{shard}-sums", columns)
        different = sums[0]
        return pa.table({f"k{k}": [int((different == k).sum())] for k in (1, 2, 3, 4)}
                        | {"kmore": [int((different > 2).sum())]})

    kinds = stored(
        in_every_shard(paired.select("shard", "piece"), n_shards, _NO_CONTEXTS).groupBy("shard").applyInArrow(
            merge_contexts, "k1 long, k2 long, k3 long, k4 long, kmore long"
        ), "ngram-contexts",
    )
    word = kinds.agg(*(F.sum(c).alias(c) for c in kinds.columns)).first()
    pair = paired.agg(*(F.sum(F.col("few")[k]).alias(f"k{k + 1}") for k in range(4)),
                      F.sum("pairs").alias("pairs")).first()
    count = {name: int(value or 0) for name, value in word.asDict().items()}
    few = [int(pair[f"k{k}"] or 0) for k in (1, 2, 3, 4)]
    return NgramModel(
        folder, n_shards, n_shards, frequent, tokens, words, int(pair["pairs"] or 0),
        discounts(*few), discounts(*(count[f"k{k}"] for k in (1, 2, 3, 4))),
        (count["k1"], count["k2"], count["kmore"]),
    )


class Mapped:
    """A model's arrays, mapped into memory."""

    def __init__(self, model: NgramModel) -> None:
        self.model = model
        self.open: dict[str, np.ndarray] = {}
        self.kept: dict[str, np.ndarray] = {}

    def _array(self, name: str) -> np.ndarray:
        """Every shard has its files, empty ones too: one that is not there raises."""
        if name not in self.open:
            self.open[name] = np.load(f"{self.model.folder}/{name}.npy", mmap_mode="r")
        return self.open[name]

    def _find(self, table: str, values: str, keys: np.ndarray, shard: np.ndarray, width: int):
        """Values of sorted keys by shard; zeros where a key is not known."""
        out = np.zeros((len(keys), width) if width > 1 else len(keys), np.int64)
        order = np.lexsort((keys, shard))
        ids, heads = np.unique(shard[order], return_index=True)
        bounds = [*heads.tolist(), len(order)]
        for n, shard_id in enumerate(ids.tolist()):
            hashes = self._array(f"{table}/{shard_id}-hash")
            if not len(hashes):
                continue
            own = order[bounds[n] : bounds[n + 1]]
            at = np.minimum(np.searchsorted(hashes, keys[own]), len(hashes) - 1)
            known = hashes[at] == keys[own]
            out[own[known]] = self._array(f"{table}/{shard_id}-{values}")[at[known]]
        return out

    def words(self, keys: np.ndarray) -> np.ndarray:
        return self._find("words", "count", keys, _shard(keys, self.model.word_shards), 1)

    def contexts(self, keys: np.ndarray) -> np.ndarray:
        return self._find("contexts", "sums", keys, _shard(keys, self.model.word_shards), 5)

    def pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys = pair_key(first, second)
        return self._find("pairs", "count", keys, self.model.pair_shard(first, keys), 1)

    def log10(self, words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: log10 of its probability after the word before it, its count, and
        log10 of its base probability."""
        model = self.model
        every, place = np.unique(np.concatenate([words, before]), return_inverse=True)
        word, ahead = place[: len(words)], place[len(words) :]
        count = self.words(every)
        sums = self.contexts(every)
        base = np.log10((count + 0.1) / (model.tokens + 0.1 * (model.words + 1)))
        # Words by the number of different words before them, then evenly.
        different = sums[:, 0]
        held = float(np.dot(model.word_discounts, model.word_kinds))
        total = max(model.pairs, 1)
        even = (held / total if model.pairs else 1.0) / (model.words + 1)
        lower = np.maximum(different - _discount_of(different, model.word_discounts), 0) / total + even
        # Pairs, and what their discounts leave.
        seen = sums[:, 1]
        left = np.where(seen > 0, sums[:, 2:] @ np.array(model.pair_discounts) / np.maximum(seen, 1), 1.0)
        pair = ahead.astype(np.int64) * len(every) + word
        pairs, of_pair = np.unique(pair, return_inverse=True)
        a, b = pairs // max(len(every), 1), pairs % max(len(every), 1)
        n = self.pairs(every[a], every[b])
        share = np.maximum(n - _discount_of(n, model.pair_discounts), 0) / np.maximum(seen[a], 1)
        value = np.log10(share + left[a] * lower[b])
        return value[of_pair], count[word], base[word]


def score(docs: DataFrame, model: NgramModel, text: str = "text") -> DataFrame:
    """Add per text: ``n_tokens``, ``n_known``, ``base_score`` and ``score``.

    The scores are log10 probabilities of the whole text with its end. Null texts count as
    empty; columns of these names are replaced. Nothing is shuffled.
    """
    added = ["n_tokens", "n_known", "base_score", "score"]
    columns = [name for name in docs.columns if name not in added]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped, known = Mapped(model), _WordHashes()
        for batch in pieces(batches, text, _BATCH_BYTES):
            words, starts = word_hashes(batch.column(text).to_pylist(), known)
            value, count, base = mapped.log10(words, contexts(words, starts))
            heads = starts[:-1]
            found = [
                np.diff(starts), np.add.reduceat((count > 0).astype(np.int64), heads),
                np.add.reduceat(base, heads), np.add.reduceat(value, heads),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, found)], [*columns, *added]
            )

    schema = schema_text(docs, columns)
    return docs.select(*columns).mapInArrow(
        scan, f"{schema}, n_tokens long, n_known long, base_score double, score double"
    )
