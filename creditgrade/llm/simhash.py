"""SimHash near-duplicates with BK-trees.

A document's fingerprint has a bit set where over half of its shingles' hashes have it.
Distinct fingerprints within a radius of each other are linked, and linked documents form
components.

The fingerprints are dealt into shards by blocks of their bits: two fingerprints that differ
in at most ``radius`` bits agree in one of ``radius + 1`` blocks, so each pair that counts
meets in a shard. Every shard is a BK-tree: a node's children are keyed by their integer
Hamming distance to it, and a search follows only the edges within the radius of its own
distance to the node. A shard that is larger than a task should hold is cut again by blocks
of the bits in which its members may still differ, which loses no pair. All trees together
grow with the data, so a tree goes to the queries of its shard and to no other task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditgrade.llm.common import pieces, released, stored, utf8

BITS = 64
SEED = 42
SHARD_ROWS = 4096
_CHUNK = 1 << 16
_BATCH_BYTES = 1 << 20


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of the shingles of a text: runs of ``width`` words, joined with blanks.

    Words are cut at ASCII white space, A-Z lower-cased. A text with fewer words has one
    shingle, one without words none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :], strict=False)],
        np.uint64,
    )


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set where over half of the hashes have them set."""
    votes = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), _CHUNK):
        some = hashes[start : start + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key`` and ``fp``, the fingerprint as a signed 64-bit number; nulls count as empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", _BATCH_BYTES):
            texts = batch.column("_text").to_pylist()
            found = [majority(shingle_hashes(text, width)) for text in texts]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(key), fp], [key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(key, utf8(text).alias("_text"))
    return texts.mapInArrow(lambda batches: released(scan(batches)), f"`{key}` {kind}, fp long")


class BKTree:
    """A BK-tree of 64-bit numbers."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Positions of the values within the radius."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            node = open_nodes.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            for edge, child in self.children[node].items():
                if distance - radius <= edge <= distance + radius:
                    open_nodes.append(child)
        return found

    def add(self, value: int) -> int:
        """Insert a value that the tree does not hold yet; its position."""
        position, node = len(self.values), 0
        if self.values:
            while (edge := (self.values[node] ^ value).bit_count()) in self.children[node]:
                node = self.children[node][edge]
            self.children[node][edge] = position
        self.values.append(value)
        self.children.append({})
        return position


def linked_in_shard(values: list[int], radius: int, every: bool) -> list[tuple[int, int]]:
    """Links of a shard's distinct values.

    With ``every``, all pairs within the radius; else a spanning forest of them, one link
    for each member of a cluster but its first.
    """
    tree, links = BKTree(), []
    leader: list[int] = []

    def root(node: int) -> int:
        while leader[node] != node:
            leader[node] = node = leader[leader[node]]
        return node

    for value in values:
        near = tree.near(value, radius)
        own = tree.add(value)
        leader.append(own)
        for other in near:
            if every:
                links.append((tree.values[other], value))
            elif (top := root(other)) != (mine := root(own)):
                leader[max(top, mine)] = min(top, mine)
                links.append((tree.values[other], value))
    return links


def _cuts(bits: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, part)) for part in np.array_split(bits, parts)]


def _bits_of(bits: list[int]) -> Column:
    mask = sum(1 << bit for bit in bits)
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask))


def _links_in_shards(shards: DataFrame, radius: int, every: bool) -> DataFrame:
    """Links inside each group of rows with one ``shard``; a group goes to one task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(values: list[int]) -> list[tuple[int, int]]:
            return linked_in_shard(values, radius, every) if len(values) > 1 else []

        shard, members, out = None, [], []
        for batch in batches:
            keys = batch.column("shard").to_pylist()
            for key, fp in zip(keys, batch.column("fp").to_pylist(), strict=True):
                if key != shard:
                    out += links(members)
                    shard, members = key, []
                members.append(fp % (1 << BITS))
            if len(out) > _CHUNK:
                yield _pairs(out)
                out = []
        yield _pairs(out + links(members))

    ordered = shards.repartition("shard").sortWithinPartitions("shard")
    return ordered.mapInArrow(lambda batches: released(search(batches)), "fp long, other long")


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["fp", "other"])


def links(prints: DataFrame, radius: int, every: bool = False, most: int = SHARD_ROWS) -> DataFrame:
    """Links between the distinct fingerprints ``fp`` that differ in at most ``radius`` bits.

    Columns ``fp`` and ``other``; a link may come from several shards. Without ``every``,
    a shard gives a spanning forest only: the components are the same.
    """
    found: list[DataFrame] = []

    def search(rows: DataFrame, path: str, free: list[int], depth: int) -> None:
        parts = _cuts(free, radius + 1)
        cells = [
            F.struct(F.lit(n).alias("block"), _bits_of(part).alias("bits"))
            for n, part in enumerate(parts)
        ]
        keyed = rows.withColumn("_cell", F.explode(F.array(*cells))).select(
            "fp", F.col("_cell.block").alias("block"),
            F.xxhash64(path, "_cell.block", "_cell.bits").alias("shard"),
        )
        keyed = stored(keyed, "simhash-shards")
        sizes = keyed.groupBy("shard").count().filter("count > 1")
        sized = keyed.join(sizes, "shard")
        last = depth == 0
        fit = sized if last else sized.filter(f"count <= {most}")
        found.append(_links_in_shards(fit.select("shard", "fp"), radius, every))
        if last:
            return
        crowded = sized.filter(f"count > {most}")
        if crowded.isEmpty():
            return
        for n, part in enumerate(parts):
            left = [bit for bit in free if bit not in part]
            search(crowded.filter(f"block = {n}").select("fp", F.col("shard").alias("path")),
                   "path", left, depth - 1)

    distinct = prints.select("fp").distinct().withColumn("path", F.lit(0).cast("long"))
    # Where a shard stays too large, 64 bits are cut in three steps: the last one leaves
    # at most a few bits to differ in, which bounds the shard.
    search(distinct, "path", list(range(BITS)), 2)
    return reduce(DataFrame.union, found)


def components(edges: DataFrame, a: str = "fp", b: str = "other") -> DataFrame:
    """Connected components of a graph: ``node`` and ``root``, its smallest node.

    Alternates the large-star and the small-star step until nothing changes: each node is
    linked to the smallest node it knows. Every step is two shuffles of narrow rows, and is
    stored in the shared folder.
    """
    now = edges.selectExpr(f"greatest({a}, {b}) AS u", f"least({a}, {b}) AS v")
    now = stored(now.filter("u <> v").distinct(), "components")
    before = None
    while before != (state := _state(now)):
        before = state
        both = now.union(now.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.expr("least(u, min(v)) AS m"))
        large = both.join(least, "u").filter("v > u").selectExpr("v AS u", "m AS v")
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.expr("min(v) AS m"))
        small = large.join(least, "u")
        small = small.selectExpr("v AS u", "m AS v").union(small.selectExpr("u", "m AS v"))
        now = stored(small.filter("u <> v").distinct(), "components")
    return now.selectExpr("u AS node", "v AS root")


def _state(edges: DataFrame) -> tuple:
    row = edges.selectExpr("count(*) AS n", "bit_xor(xxhash64(u, v)) AS x").first()
    return row["n"], row["x"]


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2
) -> DataFrame:
    """``key``, ``fp`` and ``component``, the smallest key of the linked documents.

    One row per document. Texts without words (null, empty, white space) have fingerprint 0
    and are linked like any other; equal texts share a fingerprint, whatever their number.
    A null key stays null and is no one's smallest key unless all are null.
    """
    prints = stored(fingerprints(docs, key, text, width), "simhash-prints")
    return with_components(prints, links(prints, radius), key)


def with_components(prints: DataFrame, linked: DataFrame, key: str) -> DataFrame:
    """``key``, ``fp`` and ``component`` from the links ``fp`` and ``other``."""
    first = prints.groupBy("fp").agg(F.min(key).alias("_first"))
    members = components(linked)
    roots = members.union(members.selectExpr("root AS node", "root")).distinct()
    tops = roots.join(first, roots["node"] == first["fp"])
    smallest = tops.groupBy("root").agg(F.min("_first").alias("_smallest"))
    of_print = tops.join(smallest, "root").selectExpr("fp", "_smallest")
    table = first.join(of_print, "fp", "left").selectExpr(
        "fp", "coalesce(_smallest, _first) AS component"
    )
    return prints.join(stored(table, "simhash-components"), "fp").select(key, "fp", "component")


def one_per_component(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2
) -> DataFrame:
    """The documents of which no linked one has a smaller key; one row of each component.

    Of linked rows with one key the smaller hash of the text stays, of equal rows any one.
    Texts are not shuffled unless such rows are there. Column names that begin with
    ``_simhash`` are reserved.
    """
    columns = docs.columns
    if taken := [name for name in columns if name.lower().startswith("_simhash")]:
        raise ValueError(f"reserved column names: {taken}")
    own, other, number = "_simhash_key", "_simhash_gone", "_simhash_n"
    keyed = docs.withColumn(own, F.struct(key, F.xxhash64(text).alias("text")))
    found = near_duplicates(keyed.select(own, text), own, text, width, radius)
    found = stored(found.select(own, "component"), "simhash-found")
    same = F.col(own).eqNullSafe(F.col(other))
    gone = found.filter(f"NOT ({own} <=> component)").select(F.col(own).alias(other))
    kept = keyed.join(stored(gone.distinct(), "simhash-gone"), same, "left_anti")
    again = stored(found.groupBy(own).count().filter("count > 1"), "simhash-again")
    if again.isEmpty():
        return kept.select(*columns)
    again = again.select(F.col(own).alias(other))
    first = f"row_number() OVER (PARTITION BY {own} ORDER BY {own})"
    repeated = kept.join(again, same, "left_semi").withColumn(number, F.expr(first)).filter(f"{number} = 1")
    return kept.join(again, same, "left_anti").select(*columns).union(repeated.select(*columns))
