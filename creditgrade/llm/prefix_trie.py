"""A trie of the common beginnings of conversations, by hashes of fixed-length blocks of turns.

A turn's place and content give a 128-bit hash, a block of BLOCK turns the exclusive or of its
turns' hashes, and a beginning the exclusive or of its blocks' hashes: all conversations are
grouped by what stands before a block and by the block, whole blocks at a time and without
going from level to level. Only where conversations with one beginning go on differently, or
one of them ends, are their blocks opened: each different block once, with the number of its
conversations, is cut at its turns. Elsewhere a block is a chain of nodes that no one leaves.

A node belongs to its smallest member, so the nodes of a member are a path that hangs on a node
of a smaller member. Sums over subtrees are sums along paths plus the sums of the paths that
hang on them; what hangs below a path is added up by jumping to the second, fourth, eighth and
so on path above.

No step needs a whole conversation, node or group of copies in one task: running sums are
taken in pieces of PIECE rows, first over the sums of the pieces, and equal beginnings are
counted before they are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditgrade.llm.common import stored

BLOCK = 8
PIECE = 4096
IDS_PER_PIECE = 8192
WORD = r"[^\\x20\\x09-\\x0D]+"
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``print`` and ``words``: texts become fingerprints in the first step.

    A null role or text is an empty one; rows without a conversation are left out.
    """
    role = "coalesce(string(role), '')"
    text = "coalesce(string(text), '')"
    return conversations.filter("conv_id IS NOT NULL").selectExpr(
        "bigint(conv_id) AS conv_id",
        "turn",
        f"unhex(sha2(concat(length({role}), ':', {role}, {text}), 256)) AS print",
        f"bigint(regexp_count({text}, '{WORD}')) AS words",
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Turns in their order: ``conv_id``, ``part``, ``place`` (from 1 in the part), ``print``,
    ``words``, and ``first``, the number of the conversation's turns in earlier parts.

    Null turns come first, equal ones are ordered by their fingerprint. A part is a range of
    the sorted table, so a conversation of any length is spread over many of them.
    """
    keys = ["conv_id", "turn", "print"]
    spread = rows.withColumn("_same", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(*keys, "_same").drop("_same")
    parts = stored(ranged.withColumn("part", F.spark_partition_id()), "trie-turns")
    counts = parts.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    first = counts.selectExpr(
        "conv_id AS _conv", "part AS _part",
        "sum(n) OVER (PARTITION BY conv_id ORDER BY part) - n AS first",
    )
    place = "row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, print)"
    placed = parts.withColumn("place", F.expr(place))
    return placed.join(
        first, (F.col("conv_id") == F.col("_conv")) & (F.col("part") == F.col("_part"))
    ).select("conv_id", "part", "place", "print", "words", "first")


def rebuilt(conversations: DataFrame, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of the first one of their group.

    Conversation c takes h turns of c - c % ``group`` for its own first h, where h is the
    crc32 of its decimal id modulo ``heads``; remainders have the sign of the id. Returns the turns (``conv_id``, ``place`` from 1,
    ``print``, ``words``) and the conversations with their ``length``.
    """
    own = stored(numbered(turns(conversations)), "trie-numbered")
    known = own.groupBy("conv_id").agg(F.max(F.expr("first + place")).alias("n"))
    known = stored(
        known.selectExpr(
            "conv_id", "n", f"conv_id - conv_id % {group} AS base",
            f"crc32(binary(string(conv_id))) % {heads} AS h",
        ), "trie-known",
    )
    bases = known.filter("conv_id = base").selectExpr("conv_id AS _base", "n AS base_n")
    shifts = known.join(bases, F.col("base") == F.col("_base"), "left").selectExpr(
        "conv_id", "base", "h", "least(h, coalesce(base_n, 0)) AS taken", "n"
    )
    # The shift joins the few rows of a conversation's parts, not its turns.
    parts = own.select("conv_id", "part").distinct().join(shifts, "conv_id")
    parts = parts.selectExpr("conv_id AS _conv", "part AS _part", "h", "taken - h AS shift")
    later = own.join(
        parts, (F.col("conv_id") == F.col("_conv")) & (F.col("part") == F.col("_part"))
    ).filter("first + place > h").selectExpr("conv_id", "first + place + shift AS place", "print", "words")
    head = own.filter(f"conv_id % {group} = 0 AND first + place < {heads}").selectExpr(
        "conv_id AS _head", "first + place AS place", "print", "words"
    )
    taken = shifts.join(head, F.col("base") == F.col("_head")).filter("place <= h")
    every = later.union(taken.select("conv_id", "place", "print", "words"))
    lengths = shifts.selectExpr("conv_id", "taken + greatest(0, n - h) AS length")
    return every, lengths


def running(
    rows: DataFrame, key: str, order: str, values: dict[str, str], descending: bool = False
) -> DataFrame:
    """Add running totals along each key; ``values`` gives new names their aggregates.

    A total takes in all rows of the key up to this one. The rows of a key are cut into pieces
    of its order, so that no task holds all of a long one.
    """
    way = "DESC" if descending else "ASC"
    columns = [f"`{name}`" for name in rows.columns]
    cut = rows.withColumn("_piece", F.expr(f"{order} DIV {PIECE}"))
    sums = cut.groupBy(key, "_piece").agg(*(F.expr(e).alias(n) for n, e in values.items()))
    before = f"OVER (PARTITION BY {key} ORDER BY _piece {way} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    so_far = sums.selectExpr(
        f"{key} AS _key", "_piece AS _of",
        *(f"coalesce({_again(e, n)} {before}, 0L) AS _b_{n}" for n, e in values.items()),
    )
    inside = f"OVER (PARTITION BY {key}, _piece ORDER BY {order} {way} ROWS UNBOUNDED PRECEDING)"
    own = cut.selectExpr(*columns, "_piece", *(f"{e} {inside} AS _i_{n}" for n, e in values.items()))
    joined = own.join(so_far, (F.col(key) == F.col("_key")) & (F.col("_piece") == F.col("_of")))
    return joined.selectExpr(
        *columns,
        *(f"_i_{n} {'^' if e.startswith('bit_xor') else '+'} _b_{n} AS {n}" for n, e in values.items()),
    )


def _again(aggregate: str, name: str) -> str:
    """The same aggregate over its own results."""
    return f"{aggregate[: aggregate.index('(')]}({name})"


def blocks(every: DataFrame, lengths: DataFrame) -> DataFrame:
    """Each conversation's blocks: ``block`` from 0, the hash ``p1``, ``p2`` of what stands
    before it, its own hash ``d1``, ``d2``, its turns ``t`` (hashes and words) and their number.

    The last block of a conversation has less than BLOCK turns, none if it ends with a whole one.
    """
    hashed = every.selectExpr(
        "conv_id", f"(place - 1) DIV {BLOCK} AS block",
        "struct(place, xxhash64(1, place, print) AS x1, xxhash64(2, place, print) AS x2, words) AS t",
    )
    last = lengths.selectExpr("conv_id", f"length DIV {BLOCK} AS block", "NULL AS t")
    grouped = hashed.union(last).groupBy("conv_id", "block").agg(
        F.expr("array_sort(collect_list(t)) AS t"),
        F.expr("coalesce(bit_xor(t.x1), 0L) AS d1"),
        F.expr("coalesce(bit_xor(t.x2), 0L) AS d2"),
    )
    total = running(stored(grouped, "trie-blocks"), "conv_id", "block", {"q1": "bit_xor(d1)", "q2": "bit_xor(d2)"})
    return total.selectExpr(
        "conv_id", "block", "q1 ^ d1 AS p1", "q2 ^ d2 AS p2", "d1", "d2", "t", "size(t) AS n"
    )


_CELL = ["block", "p1", "p2", "d1", "d2", "n"]


def _cut_at_turns(cells: DataFrame) -> DataFrame:
    """A row for each turn of a block: the node after it, and ``b1``, ``b2`` for the one before."""
    upto = "aggregate(slice(t, 1, {0}), {1}, (h, x) -> h ^ x.{2})"
    numbers = cells.filter("n > 0").selectExpr("*", "explode(sequence(1, n)) AS o")
    return numbers.selectExpr(
        "conv_id", "n_convs", f"block * {BLOCK} + o AS depth", "t[o - 1].words AS words",
        f"{upto.format('o', 'p1', 'x1')} AS q1", f"{upto.format('o', 'p2', 'x2')} AS q2",
        f"{upto.format('o - 1', 'p1', 'x1')} AS b1", f"{upto.format('o - 1', 'p2', 'x2')} AS b2",
    )


def nodes(found: DataFrame, lengths: DataFrame) -> DataFrame:
    """The trie's nodes: smallest member ``conv_id``, ``depth``, hash ``q1``, ``q2``, that of
    the parent ``b1``, ``b2``, ``n_convs`` and the ``words`` of the last turn."""
    cells = stored(
        found.groupBy(*_CELL).agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.any_value("t").alias("t")
        ), "trie-cells",
    )
    # One way on, and a whole block: no one leaves between its turns.
    alone = cells.groupBy("block", "p1", "p2").agg(
        F.count("*").alias("ways"), F.any_value(F.struct("d1", "d2", "n", "n_convs", "conv_id", "t")).alias("way")
    )
    alone = alone.filter(f"ways = 1 AND way.n = {BLOCK}").select("block", "p1", "p2", "way.*")
    alone = stored(alone, "trie-chains")
    open_ = cells.join(alone.select(*_CELL), _CELL, "left_anti")
    branched = _cut_at_turns(open_).groupBy("depth", "q1", "q2").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("words").alias("words"),
        F.max("b1").alias("b1"), F.max("b2").alias("b2"),
    )
    names = ["conv_id", "depth", "q1", "q2", "b1", "b2", "n_convs", "words"]
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).selectExpr(
        "conv_id", "0L AS depth", "0L AS q1", "0L AS q2", "0L AS b1", "0L AS b2", "n_convs", "0L AS words"
    )
    every = branched.select(*names).union(_cut_at_turns(alone).select(*names))
    return every.union(root.filter("n_convs > 0").select(*names))


def _with_paths_below(paths: DataFrame) -> DataFrame:
    """Add to ``leaves`` and ``saved`` of each path those of all paths that hang below it.

    ``up`` is the path above. In round k every path hands what it has gathered from less than
    2**k paths below to the one 2**k above, so there are as many rounds as the height has bits.
    """
    now = stored(paths.select("id", F.col("up").alias("jump"), "leaves", "saved"), "trie-paths")
    while not (jumping := now.filter("jump IS NOT NULL")).isEmpty():
        handed = jumping.groupBy("jump").agg(
            F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved")
        )
        far = now.selectExpr("id AS _at", "jump AS _far")
        moved = now.join(far, F.col("jump") == F.col("_at"), "left").drop("jump", "_at")
        summed = moved.join(handed, F.col("id") == F.col("jump"), "left")
        now = stored(summed.selectExpr(
            "id", "_far AS jump", "leaves + coalesce(_leaves, 0L) AS leaves", "saved + coalesce(_saved, 0L) AS saved"
        ), "trie-paths")
    return now.drop("jump")


def _ends(found: DataFrame) -> DataFrame:
    """Per node at which conversations end, the SHA-256 of their ids in order.

    The ids of a node are sorted over many tasks, which join them in pieces; one task then
    hashes the few pieces of a node one after another.
    """
    last = found.filter(f"n < {BLOCK}").selectExpr(
        f"block * {BLOCK} + n AS depth", "p1 ^ d1 AS q1", "p2 ^ d2 AS q2", "conv_id"
    )
    ordered = last.repartitionByRange("depth", "q1", "q2", "conv_id").sortWithinPartitions(
        "depth", "q1", "q2", "conv_id"
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []

        def piece() -> list[tuple]:
            return [(*node, ids[0], ",".join(map(str, ids)))] if ids else []

        def rows(some: list[tuple]) -> pa.RecordBatch:
            names = ["depth", "q1", "q2", "least", "ids"]
            kinds = [pa.int64()] * 4 + [pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in some], kind) for k, kind in enumerate(kinds)], names
            )

        for batch in batches:
            for *own, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != node or len(ids) >= IDS_PER_PIECE:
                    out += piece()
                    node, ids = own, []
                ids.append(conv)
            if len(out) > 1000:
                yield rows(out)
                out = []
        yield rows(out + piece())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []

        def rows(some: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array([r[k] for r in some], pa.int64()) for k in range(3)]
            arrays.append(pa.array([r[3] for r in some], pa.string()))
            return pa.RecordBatch.from_arrays(arrays, ["depth", "q1", "q2", "ends"])

        for batch in batches:
            for *own, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != node:
                    if state:
                        out.append((*node, state.hexdigest()))
                    node, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(out) > 1000:
                yield rows(out)
                out = []
        yield rows(out + ([(*node, state.hexdigest())] if state else []))

    joined = ordered.mapInArrow(join, "depth long, q1 long, q2 long, least long, ids string")
    by_node = joined.repartition("depth", "q1", "q2").sortWithinPartitions("depth", "q1", "q2", "least")
    return by_node.mapInArrow(digest, "depth long, q1 long, q2 long, ends string")


def _same(*names: str) -> Column:
    """Equality of columns with their namesakes that begin with an underscore."""
    condition = F.lit(True)
    for name in names:
        condition = condition & (F.col(name) == F.col(f"_{name}"))
    return condition


def prefix_trie(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """The trie of the rebuilt conversations (see ``rebuilt``), a row per node.

    Columns: ``conv_id`` (smallest member) and ``depth``, which name the node;
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless
    nodes of its subtree, itself included), ``saved_tokens`` (over the subtree, the words of a
    node's last text for each member but one) and ``ends_sha256`` (SHA-256 of the ids, in order
    and joined with commas, of the members that end there).

    Rows with a null ``conv_id`` take no part, null roles and texts are empty, null turns come
    first, and rows with one turn number are ordered by the SHA-256 of role and text. Repeated
    rows are turns of their own. Without rows there is no node, not even the root. Columns but
    ``conv_id``, ``turn``, ``role`` and ``text`` are not looked at.
    """
    every, lengths = rebuilt(conversations.select("conv_id", "turn", "role", "text"), group, heads)
    lengths = stored(lengths, "trie-lengths")
    found = stored(blocks(every, lengths), "trie-found")
    tree = nodes(found, lengths).withColumn("saved", F.expr("(n_convs - 1) * words"))
    tree = stored(tree, "trie-nodes")

    tops = tree.groupBy("conv_id").agg(
        F.min(F.struct("depth", "b1", "b2")).alias("top"), F.max("depth").alias("last"), F.sum("saved").alias("saved")
    )
    tops = tops.selectExpr("conv_id AS id", "top.depth - 1 AS depth", "top.b1 AS q1", "top.b2 AS q2", "last", "saved")
    named = tree.selectExpr("conv_id AS up", "depth AS _depth", "q1 AS _q1", "q2 AS _q2")
    paths = stored(
        tops.join(named, _same("depth", "q1", "q2"), "left").select("id", "up", "depth", "last", "saved"),
        "trie-tops",
    )
    hung = paths.filter("up IS NOT NULL")
    at_end = hung.selectExpr("up AS _id", "depth AS _last").distinct()
    ends = paths.join(at_end, _same("id", "last"), "left")
    ends = ends.selectExpr("id", "up", "IF(_id IS NULL, 1L, 0L) AS leaves", "saved")
    below = _with_paths_below(ends)

    def mark(rows: DataFrame, node: str, depth: str, **values: str) -> DataFrame:
        names = {"paths": "0L", "leaves": "0L", "saved": "0L", "last": "0", "top": "0", "up": "bigint(NULL)"}
        return rows.selectExpr(f"{node} AS _conv_id", f"{depth} AS _depth",
                               *(f"{e} AS _{n}" for n, e in (names | values).items()))

    hanging = hung.select("id", "up", "depth").join(below, "id")
    marks = (
        mark(hanging, "up", "depth", paths="1L", leaves="leaves", saved="saved")
        .union(mark(paths, "id", "last", last="1"))
        .union(mark(paths, "id", "depth + 1", top="1", up="up"))
        .groupBy("_conv_id", "_depth")
        .agg(*(F.expr(f"sum({n}) AS {n}") for n in ("_paths", "_leaves", "_saved")),
             *(F.expr(f"max({n}) AS {n}") for n in ("_last", "_top", "_up")))
    )
    grown = tree.join(marks, _same("conv_id", "depth"), "left").selectExpr(
        "conv_id", "depth", "q1", "q2", "n_convs",
        "CASE WHEN depth = 0 THEN NULL WHEN _top = 1 THEN _up ELSE conv_id END AS parent_conv_id",
        # On its path a node has one child, but for the last one.
        "coalesce(_paths, 0L) + IF(_last = 1, 0L, 1L) AS n_children",
        "coalesce(_leaves, 0L) + IF(_last = 1 AND _paths = 0, 1L, 0L) AS leaves",
        "saved + coalesce(_saved, 0L) AS saved",
    )
    summed = running(
        stored(grown, "trie-grown"), "conv_id", "depth",
        {"n_leaves": "sum(leaves)", "saved_tokens": "sum(saved)"}, descending=True,
    )
    digests = _ends(found).withColumnsRenamed({"depth": "_depth", "q1": "_q1", "q2": "_q2"})
    return summed.join(digests, _same("depth", "q1", "q2"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(EMPTY_HASH)).alias("ends_sha256"),
    )
