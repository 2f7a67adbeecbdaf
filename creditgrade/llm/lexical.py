"""Ranked lexical search: the documents' texts are scanned with an automaton of the items' terms.

There is no index of the documents. The terms of a block of items, each with a guard at both
ends, become one Aho-Corasick automaton, and a task counts their occurrences straight from
its texts. An output of the automaton is a term, and a term maps to the items that hold it.

Two scans per block of items: the first counts in how many documents each term is, the second
scores. A task keeps the best documents of each item only, which Spark merges in two steps.
Terms are runs of ASCII digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditgrade.llm.common import byte_rows, pieces, stored, utf8

TOP = 50
BLOCK_BYTES = 4 << 20
ITEM_BYTES = 64 << 20
SALTS = 32
_BATCH_BYTES = 4 << 20
_CHUNK = 1 << 20
_PAIRS = 2_000_000
_BUFFER = 200_000
_GUARD = 0x20
_EXACT = 1 << 53


def _folding() -> np.ndarray:
    """For each byte of UTF-8 the byte of its term, or the guard between terms."""
    table = np.full(256, _GUARD, np.uint8)
    for code in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
        table[code] = code
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


_FOLDED = _folding()


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in their order, with repeats."""
    return text.translate(_FOLDED.tobytes()).split()


@dataclass(frozen=True)
class ItemBlock:
    """Some items: their ids, their terms, and the items of each term one after another."""

    ids: pa.Array
    terms: list[bytes]
    starts: np.ndarray
    items: np.ndarray

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            found.add_word(f" {term.decode('latin-1')} ", number)
        if self.terms:
            found.make_automaton()
        return found


def item_block(ids: list, texts: list[bytes], kind: pa.DataType) -> ItemBlock:
    """The block of some items; rows with one id are one item with the terms of all of them."""
    held: dict = {}
    for item, text in zip(ids, texts, strict=True):
        held.setdefault(item, set()).update(terms_of(text))
    numbers: dict[bytes, list[int]] = {}
    for n, terms in enumerate(held.values()):
        for term in terms:
            numbers.setdefault(term, []).append(n)
    terms = sorted(numbers)
    starts = np.cumsum([0, *(len(numbers[term]) for term in terms)])
    items = np.array([n for term in terms for n in numbers[term]], np.int64)
    return ItemBlock(pa.array(list(held), kind), terms, starts, items)


@dataclass(frozen=True)
class Occurrences:
    """Of a batch of documents: the terms of each, and the counts of those that are searched."""

    n_terms: np.ndarray
    doc: np.ndarray
    term: np.ndarray
    tf: np.ndarray


def occurrences(texts: pa.Array, automaton: ahocorasick.Automaton, n_known: int) -> Occurrences:
    """Count the automaton's terms in each text."""
    flat, offsets = byte_rows(texts)
    n_docs = len(offsets) - 1
    # A guard before each text and one at the end.
    owner = np.repeat(np.arange(n_docs), np.diff(offsets))
    guarded = np.full(len(flat) + n_docs + 1, _GUARD, np.uint8)
    guarded[np.arange(len(flat)) + owner + 1] = _FOLDED[flat]
    first = offsets[:-1] + np.arange(n_docs)
    blank = guarded == _GUARD
    begins = np.concatenate([[0], np.cumsum(blank[:-1] & ~blank[1:])])
    n_terms = np.diff(begins[np.append(first, len(guarded) - 1)])
    none = np.empty(0, np.int64)
    if not n_known or not n_terms.sum():
        return Occurrences(n_terms, none, none, none)

    blanks = np.flatnonzero(blank)
    found, at = [], 0
    while at < len(guarded) - 1:
        # Up to the last guard within a chunk, or the next one if a term is longer.
        last = int(np.searchsorted(blanks, at + _CHUNK, "right")) - 1
        end = int(blanks[last])
        if end <= at:
            end = int(blanks[last + 1])
        chunk = guarded[at : end + 1].tobytes().decode("latin-1")
        pairs = np.fromiter(chain.from_iterable(automaton.iter(chunk)), np.int64).reshape(-1, 2)
        doc = np.searchsorted(first, pairs[:, 0] + (at - 1), "right") - 1
        found.append(doc * n_known + pairs[:, 1])
        at = end
    key, tf = np.unique(np.concatenate(found), return_counts=True)
    return Occurrences(n_terms, key // n_known, key % n_known, tf)


def _statistics(docs: DataFrame, block: Broadcast) -> dict[int, int]:
    """Documents that hold each term of a block; -1: documents with terms, -2: their terms."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, n_known = block.value.automaton(), len(block.value.terms)
        counts = np.zeros(n_known + 2, np.int64)
        for batch in pieces(batches, "_text", _BATCH_BYTES):
            seen = occurrences(batch.column("_text"), automaton, n_known)
            counts[:n_known] += np.bincount(seen.term, minlength=n_known)
            counts[-1] += np.count_nonzero(seen.n_terms)
            counts[-2] += seen.n_terms.sum()
        term = np.append(np.arange(n_known), [-2, -1])
        kept = counts > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(term[kept]), pa.array(counts[kept])], ["term", "n"]
        )

    each = docs.select("_text").mapInArrow(scan, "term long, n long")
    return {r["term"]: r["n"] for r in each.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The documents with the highest scores of each item, smaller keys first among equals."""

    def __init__(self, n_items: int, top: int) -> None:
        self.top = top
        self.least = np.ones(n_items, np.int64)
        self.rows: list[np.ndarray] = []
        self.size = 0

    def add(self, item: np.ndarray, absent: np.ndarray, key: np.ndarray, score: np.ndarray) -> None:
        self.rows.append(np.stack([item, absent, key, score]))
        self.size += len(item)
        if self.size > _BUFFER:
            kept = self.kept()
            # Rows that were kept are few unless there are many items; prune on twice as many.
            self.rows, self.size = [kept], min(kept.shape[1], _BUFFER // 2)

    def kept(self) -> np.ndarray:
        """Rows of item, whether the key is null, key and score; the best of each item."""
        if not self.rows:
            return np.empty((4, 0), np.int64)
        item, absent, key, score = rows = np.concatenate(self.rows, axis=1)
        rows = rows[:, np.lexsort((key, absent, -score, item))]
        item = rows[0]
        starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        place = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        last = place == self.top - 1
        self.least[item[last]] = rows[3][last]
        return rows[:, place < self.top]


def _scored(
    docs: DataFrame, block: Broadcast, statistics: dict[int, int], key_type: str, item_type: str, top: int
) -> DataFrame:
    """Each task's best documents of each item: ``_item``, ``_doc``, ``_score``."""
    n_docs, n_all = statistics.get(-1, 0), statistics.get(-2, 0)
    known = len(block.value.terms)
    weights = [term_weight(n_docs, statistics[t]) if t in statistics else 0 for t in range(known)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, starts, items = block.value.automaton(), block.value.starts, block.value.items
        n_items = len(block.value.ids)
        weight, degree = np.array(weights, np.int64), np.diff(starts)
        # An item's score is below this; beyond it, doubles would round.
        highest = int(weight.max(initial=0)) * 1_000_000
        most_terms = int(np.bincount(items, minlength=1).max())
        best = Best(n_items, top)

        def summed(place: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
            if highest * most_terms < _EXACT:
                return np.bincount(place, value, size).astype(np.int64)
            high = np.bincount(place, value >> 20, size).astype(np.int64)
            return (high << 20) + np.bincount(place, value & 0xFFFFF, size).astype(np.int64)

        for batch in pieces(batches, "_text", _BATCH_BYTES):
            seen = occurrences(batch.column("_text"), automaton, known)
            length = [50 + (50 * n * n_docs) // n_all for n in seen.n_terms.tolist()] if n_all else []
            doc, term, tf = (x[weight[seen.term] > 0] for x in (seen.doc, seen.term, seen.tf))
            if not len(doc):
                continue
            norm = np.array(length, np.int64)[doc]
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm))
            keys = batch.column("_doc")
            absent = np.asarray(keys.is_null().to_numpy(zero_copy_only=False), np.int64)
            keys = keys.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            # Documents at a time whose terms have about _PAIRS items.
            reach = np.cumsum(degree[term])
            ends = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) + 1
            start = 0
            while start < len(doc):
                limit = (reach[start - 1] if start else 0) + _PAIRS
                fit = int(np.searchsorted(reach[ends - 1], limit, "right"))
                stop = int(ends[max(fit - 1, int(np.searchsorted(ends, start, "right")))])
                # The table of scores is dense: few documents at a time where items are many.
                stop = min(stop, int(np.searchsorted(doc, doc[start] + max(1, _PAIRS // n_items))))
                own, many = term[start:stop], degree[term[start:stop]]
                base = doc[start]
                shift = np.repeat(starts[own] - (np.cumsum(many) - many), many)
                item = items[shift + np.arange(len(shift))]
                rows = int(doc[stop - 1] - base) + 1
                place = np.repeat(doc[start:stop] - base, many) * n_items + item
                total = summed(place, np.repeat(value[start:stop], many), rows * n_items)
                total = total.reshape(rows, n_items)
                row, item = np.nonzero(total >= best.least)
                best.add(item, absent[base + row], keys[base + row], total[row, item])
                start = stop
        item, absent, key, score = best.kept()
        doc = pa.array(key, mask=absent.astype(bool)).cast(batch_type)
        yield pa.RecordBatch.from_arrays(
            [block.value.ids.take(pa.array(item)), doc, pa.array(score)], ["_item", "_doc", "_score"]
        )

    batch_type = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32()}.get(key_type, pa.int64())
    return docs.mapInArrow(scan, f"_item {item_type}, _doc {key_type}, _score long")


def _merged(found: DataFrame, top: int) -> DataFrame:
    """The best of all tasks, with their rank. An item's rows are ranked in slices first."""
    order = "ORDER BY _score DESC, _doc ASC NULLS LAST"
    sliced = found.withColumn("_slice", F.pmod(F.xxhash64("_doc"), F.lit(SALTS)))
    first = sliced.withColumn(
        "rank", F.expr(f"row_number() OVER (PARTITION BY _item, _slice {order})")
    ).filter(f"rank <= {top}")
    return first.withColumn(
        "rank", F.expr(f"row_number() OVER (PARTITION BY _item {order})")
    ).filter(f"rank <= {top}")


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each item's highest-scoring documents: ``item_key``, ``rank``, ``key``, ``score``.

    ``key`` is a whole-number column. Scores are above 0; among equal ones smaller keys come
    first, a null key last, and rows with one key are documents of their own. Item rows with
    one id, null too, are one item. Null, empty and term-less texts count for nothing, nor
    do they match; an item without terms has no rows, and without documents or items there
    are none at all. Other columns of the inputs are not looked at.

    Items are searched in blocks of about ``block_bytes`` of text, so what a task gets does
    not grow with their number. An item is never cut: one beyond ITEM_BYTES raises.
    """
    if key == item_key:
        raise ValueError(f"documents and items both call their key {key!r}: rename one")
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType.simpleString()
    item_type = items.schema[item_key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("_doc"), utf8(text).alias("_text"))
    wanted = items.select(F.col(item_key).alias("_item"), utf8(item_text).alias("_text"))
    size = wanted.groupBy("_item").agg(F.sum(F.octet_length("_text")).alias("n"))
    size = size.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    if (size["most"] or 0) > ITEM_BYTES:
        raise ValueError(f"an item has {size['most']} bytes of text, more than {ITEM_BYTES}")
    n_blocks = max(1, -(-(size["n"] or 0) // block_bytes))
    of_block = F.pmod(F.xxhash64("_item"), F.lit(n_blocks))
    results = []
    for number in range(n_blocks):
        rows = wanted.filter(of_block == number).toArrow()
        ids, texts_of = rows.column("_item"), rows.column("_text").to_pylist()
        block = spark.sparkContext.broadcast(item_block(ids.to_pylist(), texts_of, ids.type))
        statistics = _statistics(texts, block)
        best = _merged(_scored(texts, block, statistics, key_type, item_type, top), top)
        if n_blocks > 1:
            best = stored(best, "lexical-best")
            block.unpersist()
        results.append(best)
    return reduce(DataFrame.union, results).select(
        F.col("_item").alias(item_key), "rank", F.col("_doc").alias(key), F.col("_score").alias("score")
    )
