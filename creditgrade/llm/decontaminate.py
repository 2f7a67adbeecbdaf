"""Benchmark decontamination by SimHash windows.

For every benchmark item, a document is read in windows of as many words as the item has; a
shorter document is one window, so that items with words left out are found as well.
Windows and items have SimHash fingerprints of their five-word shingles. A multi-index of
the items' fingerprints finds every item within the radius of a window: it is cut into
blocks, and fingerprints within the radius agree in one block up to a few bits, all of
which are looked up. Pairs found so are compared exactly: the similarity is the weighted
Jaccard one, shingles weighing as often as they occur.

A window that reaches the similarity shares most of its shingles with the item, so windows
with fewer shingles known from items of their size need no fingerprint.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditgrade.llm.common import released

WORDS = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
BENCHMARK_BLOCK_BYTES = 16 << 20
_FILTER_BITS = 22
_MEMORY = 100_000
_HIT = "array<struct<item_id:long,similarity:double>>"

# Words are runs of letters and digits: A-Z are lower-cased, other ASCII is white space.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
    for c in range(256)
)
_NEAR = [
    [value ^ sum(1 << bit for bit in flips)
     for n in range(BLOCK_RADIUS + 1) for flips in combinations(range(BLOCK_BITS), n)]
    for value in range(1 << BLOCK_BITS)
]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_PLAIN).split()


class _WordHashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMORY:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_hashes(hashes: np.ndarray, width: int = WORDS) -> np.ndarray:
    """Hashes of all runs of ``width`` words from the hashes of the words.

    Fewer words are one shingle; no words have none.
    """
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    out = np.full(n, np.uint64(width))
    for k in range(width):
        out = (out ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _votes(shingles: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.concatenate([np.zeros((1, 64), np.int64), bits.cumsum(axis=0, dtype=np.int64)])


def fingerprint(votes: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller weights over the sum of the larger ones."""
    shared = (a & b).total()
    total = a.total() + b.total() - shared
    return shared / total if total else 0.0


class ItemIndex:
    """The items of a part of the benchmark, by their number of words."""

    def __init__(self, items: list[tuple[int, str | None]], similarity: float) -> None:
        self.similarity = similarity
        self.known = _WordHashes()
        self.items: list[tuple[int, int, Counter]] = []
        self.blocks: dict[int, list[dict[int, list[int]]]] = {}
        self.sizes_of: dict[int, set[int]] = defaultdict(set)
        for item, text in items:
            hashes = self.hashes(words_of(text))
            if not len(hashes):
                continue
            shingles = shingle_hashes(hashes)
            fp = fingerprint(_votes(shingles)[-1], len(shingles))
            blocks = self.blocks.setdefault(
                len(hashes), [defaultdict(list) for _ in range(BLOCKS)]
            )
            for n, block in enumerate(blocks):
                block[fp >> n * BLOCK_BITS & 0xFF].append(len(self.items))
            self.items.append((item, fp, Counter(shingles.tolist())))
            for shingle in set(shingles.tolist()):
                self.sizes_of[shingle].add(len(hashes))
        self.anchors = np.array(sorted(self.sizes_of), np.uint64)
        self.short = sorted(size for size in self.blocks if size < WORDS)
        self.likely = np.zeros(1 << _FILTER_BITS, bool)
        self.likely[self.anchors & np.uint64((1 << _FILTER_BITS) - 1)] = True

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def near(self, fp: int, size: int) -> list[int]:
        """All items of a size whose fingerprint is within the radius."""
        found: set[int] = set()
        for n, block in enumerate(self.blocks[size]):
            for value in _NEAR[fp >> n * BLOCK_BITS & 0xFF]:
                found.update(block.get(value, ()))
        return [at for at in found if (self.items[at][1] ^ fp).bit_count() <= RADIUS]

    def _anchors_in(self, shingles: np.ndarray) -> np.ndarray:
        """Positions of shingles that some item has."""
        at = np.flatnonzero(self.likely[shingles & np.uint64((1 << _FILTER_BITS) - 1)])
        if not len(at):
            return at
        place = np.minimum(np.searchsorted(self.anchors, shingles[at]), len(self.anchors) - 1)
        return at[self.anchors[place] == shingles[at]]

    def _search(self, shingles: np.ndarray, size: int, anchored: np.ndarray, best: dict) -> None:
        """Windows of one size with enough of the anchored shingles.

        A text with fewer shingles is one window.
        """
        n = max(1, size - WORDS + 1)
        least = self.similarity * n - 1e-9
        n = min(n, len(shingles))
        run = np.concatenate([[0], np.cumsum(anchored)])
        starts = np.flatnonzero(run[n:] - run[:-n] >= least)
        if not len(starts):
            return
        low = int(starts[0])
        votes = _votes(shingles[low : int(starts[-1]) + n]) if starts[-1] - low < 50 * len(starts) else None
        for start in starts.tolist():
            if votes is None:
                count = _votes(shingles[start : start + n])[-1]
            else:
                count = votes[start - low + n] - votes[start - low]
            weights = None
            for at in self.near(fingerprint(count, n), size):
                item, _, own = self.items[at]
                weights = weights or Counter(shingles[start : start + n].tolist())
                found = weighted_similarity(own, weights)
                if found >= self.similarity and found > best.get(item, 0.0):
                    best[item] = found

    def hits(self, text: str | None) -> list[tuple[int, float]]:
        """Items that some window of the text reaches the similarity with, and the best."""
        hashes = self.hashes(words_of(text))
        best: dict[int, float] = {}
        for width in [*self.short, WORDS]:
            if len(hashes) < width:
                continue
            shingles = shingle_hashes(hashes, width)
            at = self._anchors_in(shingles)
            if not len(at):
                continue
            sizes = defaultdict(list)
            for place, shingle in zip(at.tolist(), shingles[at].tolist(), strict=True):
                for size in self.sizes_of[shingle]:
                    sizes[size].append(place)
            for size, places in sizes.items():
                if size == width or size > WORDS == width:
                    anchored = np.zeros(len(shingles), np.int64)
                    anchored[places] = 1
                    self._search(shingles, size, anchored, best)
        return sorted(best.items())


def _search_udf(items: Broadcast, similarity: float) -> Callable[[str], Column]:
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = ItemIndex(items.value, similarity)
        for texts in batches:
            found = [[{"item_id": i, "similarity": s} for i, s in index.hits(t)] for t in texts]
            yield pd.Series(found, dtype=object)

    @F.pandas_udf(_HIT)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return released(hits(batches))

    return search


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
    block_bytes: int = BENCHMARK_BLOCK_BYTES,
    name: str = "hits",
) -> DataFrame:
    """Add ``hits``: the benchmark items that a document holds, each with its similarity.

    The benchmark is sent out in blocks of at most about ``block_bytes`` of text, so that a
    block fits every task whatever the benchmark's size; each block is one more pass of the
    texts through Python. Null and empty texts have no hits, items without words are in no
    text, and repeated items or rows each get their own result. A column of that name is
    replaced. Items with fewer than five words are one shingle and have to occur as they are.
    """
    total = benchmark.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    n_blocks = 1 + total // block_bytes
    spark = docs.sparkSession
    rows = docs.select(*[column for column in docs.columns if column != name])
    parts = []
    for n in range(n_blocks):
        of_block = F.pmod(F.xxhash64(item, item_text), F.lit(n_blocks)) == n
        items = benchmark.filter(of_block).select(item, item_text).collect()
        shared = spark.sparkContext.broadcast([(row[0], row[1]) for row in items])
        rows = rows.withColumn(f"_hits{n}", _search_udf(shared, similarity)(text))
        parts.append(f"_hits{n}")
    return rows.withColumn(name, F.concat(*parts)).drop(*parts)
