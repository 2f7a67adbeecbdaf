"""Exact top-k search by inner product over a pivot-distance index.

The largest inner product is the smallest distance once every vector gets one more
component that brings it to the length of the longest, and every query gets a zero there.
So the index is one over distances: each vector is keyed by its nearest pivot and its
distance to it, and the vectors of a pivot lie in rings of growing distance. With r the
distance that a query's k-th best vector has so far, a vector can only be better if its own
distance to the pivot differs from the query's by at most r (triangle inequality).

A query first searches the ring it lies in itself; what it finds there bounds r, and then
the rings on both sides that the bound leaves, nearest first, stopping where it excludes all
others. Equal vectors share an entry with their smallest ids, and equal queries are one
search, so no ring fills up with copies. Rings are cut into blocks of bounded size.

Pivots are a bounded sample. They decide how much is searched and never what is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditgrade.llm.common import stored

PIVOTS = 32
RINGS = 24
BLOCK_ROWS = 4096
_SAMPLE = 4096
_SLACK = 1e-6


def whole_numbers(embedding: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null for vectors that hold no such number."""
    values = F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    fine = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.when(fine, values.cast("array<long>"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that brings them to the longest one's length."""
    more = longest - (vectors.astype(np.float64) ** 2).sum(axis=1)
    return np.column_stack([vectors, np.sqrt(np.maximum(more, 0))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


class PivotIndex:
    """Pivots, the rings' width and the squared length of the longest vector."""

    def __init__(self, sample: np.ndarray, longest: float, n_pivots: int) -> None:
        self.longest = longest
        points = np.unique(_lifted(sample, longest), axis=0)
        chosen = [0]
        near = _distances(points, points[:1])[:, 0]
        while len(chosen) < min(n_pivots, len(points)):  # the farthest point from all so far
            chosen.append(int(near.argmax()))
            near = np.minimum(near, _distances(points, points[chosen[-1:]])[:, 0])
        self.pivots = points[chosen]
        self.width = max(float(near.max()) / RINGS, 1.0)

    def place(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest pivot, distance to it and ring."""
        far = _distances(_lifted(vectors, self.longest), self.pivots)
        pivot = far.argmin(axis=1)
        distance = far[np.arange(len(far)), pivot]
        return pivot, distance, (distance / self.width).astype(np.int64)

    def query_distances(self, queries: np.ndarray) -> np.ndarray:
        return _distances(np.column_stack([queries, np.zeros(len(queries))]), self.pivots)

    def radius(self, queries: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance at which a vector has a score, a little more for rounding."""
        squares = (queries.astype(np.float64) ** 2).sum(axis=1) + self.longest - 2 * score
        return np.sqrt(np.maximum(squares, 0)) * (1 + _SLACK) + _SLACK * self.longest**0.5


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


_ASKED = "qid long, q array<long>, pivot int, ring long, block int, floor long, near double"
_FOUND = "qid long, vec_id long, score long"


def _search(index: Broadcast, k: int):
    """Queries against one block of a ring: their k best vectors above their floor."""

    def search(block: pa.Table, queries: pa.Table) -> pa.Table:
        if not block.num_rows or not queries.num_rows:
            return pa.table({"qid": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.int64())})
        vectors = _matrix(block.column("v").combine_chunks())
        distance = block.column("distance").to_numpy()
        order = np.argsort(distance, kind="stable")
        vectors, distance = vectors[order], distance[order]
        entries = block.column("ids").combine_chunks()
        many = np.diff(entries.offsets.to_numpy())
        starts = entries.offsets.to_numpy()[:-1]
        every = entries.values.to_numpy()
        q = _matrix(queries.column("q").combine_chunks())
        floor, near = queries.column("floor").to_numpy(), queries.column("near").to_numpy()
        radius = index.value.radius(q, floor)
        ids, found, scores = queries.column("qid").to_numpy(), [], []
        for n in range(len(q)):
            # The part of the ring that the query's bound leaves.
            low = int(np.searchsorted(distance, near[n] - radius[n], "left"))
            high = int(np.searchsorted(distance, near[n] + radius[n], "right"))
            score = vectors[low:high] @ q[n]
            passing = np.flatnonzero(score >= floor[n])
            if len(passing) > k:
                least = np.partition(score[passing], len(passing) - k)[len(passing) - k]
                passing = passing[score[passing] >= least]
            rows = order[low + passing]
            own = np.concatenate([every[starts[r] : starts[r] + many[r]] for r in rows]) if len(rows) else every[:0]
            own, score = _best(own, np.repeat(score[passing], many[rows]), k)
            found.append(own)
            scores.append(score)
        n = [len(own) for own in found]
        return pa.table({"qid": np.repeat(ids, n), "vec_id": np.concatenate(found),
                         "score": np.concatenate(scores)})

    return search


def _top(found: DataFrame, k: int) -> DataFrame:
    rank = "row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id)"
    return found.distinct().withColumn("rank", F.expr(rank)).filter(f"rank <= {k}")


def _padded(df: DataFrame, column: str, width: int) -> DataFrame:
    """The vectors with zeros behind them up to a length."""
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(column))
    whole = F.when(F.size(column) == width, F.col(column)).otherwise(F.concat(column, zeros))
    return df.withColumn(column, whole)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, n_pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: the best vectors per query.

    Both tables have ``vec_id`` and ``v``, whole numbers. Shorter vectors count as ending in
    zeros, so the score of two is over the components that both have. A query's own id is no
    candidate for it. Ties go to the smaller id; fewer candidates than k are all
    returned. Rows whose id or vector is null take no part, repeated rows count once.
    """
    spark = vectors.sparkSession
    # One candidate more than asked for, as the query itself may be among them.
    most = k + 1
    fine = "vec_id IS NOT NULL AND v IS NOT NULL"
    ranked = vectors.filter(fine).select("vec_id", "v").distinct().withColumn(
        "n", F.expr("row_number() OVER (PARTITION BY v ORDER BY vec_id)")
    )
    entries = ranked.filter(f"n <= {most}").groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = stored(entries, "topk-entries")
    asked = stored(queries.filter(fine).select("vec_id", "v").distinct(), "topk-asked")
    by_query = asked.groupBy("v").agg(F.min("vec_id").alias("qid"))
    distinct = stored(by_query.selectExpr("qid", "v AS q"), "topk-queries")
    longest, width = entries.agg(
        F.max(F.expr("aggregate(v, 0L, (s, x) -> s + x * x)")), F.max(F.size("v"))
    ).first()
    width = max(1, width or 0, distinct.agg(F.max(F.size("q"))).first()[0] or 0)
    entries, distinct = _padded(entries, "v", width), _padded(distinct, "q", width)
    sample = entries.orderBy(F.xxhash64("v")).limit(_SAMPLE).select("v").toArrow().to_pandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index = spark.sparkContext.broadcast(
        PivotIndex(np.stack(sample["v"].to_numpy()), float(longest), n_pivots)
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pivot, distance, ring = index.value.place(_matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(pivot.astype(np.int32)), pa.array(distance), pa.array(ring)],
                    ["v", "ids", "pivot", "distance", "ring"],
                )

    placed = entries.mapInArrow(
        place, "v array<long>, ids array<long>, pivot int, distance double, ring long"
    )
    placed = stored(placed, "topk-placed")
    # Pivots times rings: a small table whatever the number of vectors.
    rings = placed.groupBy("pivot", "ring").agg(
        F.expr(f"int(ceil(count(*) / {block_rows}))").alias("blocks"),
        F.min("distance").alias("low"), F.max("distance").alias("high"),
    ).toArrow().to_pandas()
    blocks = spark.sparkContext.broadcast(
        {(r.pivot, r.ring): (r.blocks, r.low, r.high) for r in rings.itertuples()}
    )
    sizes = spark.createDataFrame(rings[["pivot", "ring", "blocks"]], "pivot int, ring long, blocks int")
    dealt = placed.join(F.broadcast(sizes), ["pivot", "ring"]).withColumn(
        "block", F.expr("int(pmod(xxhash64(v, 1), blocks))")
    ).select("pivot", "ring", "block", "v", "ids", "distance")
    keys = ["pivot", "ring", "block"]

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ring of each query that lies nearest to it, of its nearest pivot."""
        of_pivot: dict[int, list[int]] = {}
        for pivot, ring in blocks.value:
            of_pivot.setdefault(pivot, []).append(ring)
        used = np.array(sorted(of_pivot))
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("q"))
            far = index.value.query_distances(q)
            rows = []
            for n in range(len(q)):
                pivot = int(used[far[n, used].argmin()])
                near = far[n, pivot]
                ring = min(of_pivot[pivot], key=lambda r: abs(near / index.value.width - r - 0.5))
                rows += [(n, pivot, ring, b, near) for b in range(blocks.value[pivot, ring][0])]
            yield _asked(batch, rows, np.full(len(q), -(1 << 62)))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rings that the bound of each query leaves, nearest first."""
        for batch in batches:
            if not batch.num_rows:
                continue
            q, floor = _matrix(batch.column("q")), batch.column("floor").to_numpy()
            far, radius = index.value.query_distances(q), index.value.radius(q, floor)
            rows = []
            for n in range(len(q)):
                gaps = sorted(
                    (max(low - far[n, p], far[n, p] - high, 0.0), p, r, count)
                    for (p, r), (count, low, high) in blocks.value.items()
                )
                for gap, pivot, ring, count in gaps:
                    if gap > radius[n]:
                        break
                    rows += [(n, pivot, ring, b, far[n, pivot]) for b in range(count)]
            yield _asked(batch, rows, floor)

    def ask(rows: DataFrame) -> DataFrame:
        found = dealt.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(
            _search(index, most), _FOUND
        )
        return stored(found, "topk-found")

    first = ask(distinct.mapInArrow(at_home, _ASKED))
    floors = _top(first, most).groupBy("qid").agg(
        F.expr(f"IF(count(*) = {most}, min(score), {-(1 << 62)})").alias("floor")
    )
    bounded = distinct.join(floors, "qid", "left").select(
        "qid", "q", F.coalesce("floor", F.lit(-(1 << 62))).alias("floor")
    )
    found = ask(bounded.mapInArrow(around, _ASKED))
    best = _top(found, most).select("qid", "vec_id", "score")
    same = asked.join(by_query, "v").select(F.col("vec_id").alias("query_id"), "qid")
    rank = "int(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))"
    return (
        same.join(best, "qid")
        .filter("vec_id <> query_id")
        .withColumn("rank", F.expr(rank))
        .filter(f"rank <= {k}")
        .select("query_id", "rank", "vec_id", "score")
    )


def _asked(batch: pa.RecordBatch, rows: list[tuple], floor: np.ndarray) -> pa.RecordBatch:
    n, pivot, ring, block, near = (np.array(c) for c in zip(*rows)) if rows else [np.empty(0)] * 5
    at = n.astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [batch.column("qid").take(pa.array(at)), batch.column("q").take(pa.array(at)),
         pa.array(pivot.astype(np.int32)), pa.array(ring.astype(np.int64)),
         pa.array(block.astype(np.int32)), pa.array(floor[at].astype(np.int64)),
         pa.array(near.astype(np.float64))],
        ["qid", "q", "pivot", "ring", "block", "floor", "near"],
    )
