"""Equi-joins whose work per task is bounded, whatever rows a key has on either side.

The rows that a join makes of a key are the product of the key's rows in all tables. A key
is *crowded* where that is more than a task should make. Its rows in each table are then
dealt over parts by their hash, and the join runs on a grid with one dimension per table: a
row meets every part of the other tables, so each combination meets in exactly one cell.
The number of parts follows from the key's row counts. The list of crowded keys is a stored
table that is joined like any other, however long it gets.

Where no key is crowded, joins are plain ones and nothing is added to the plan.

Rows are dealt by their contents and the input partition they lie in. Equal rows of one
partition are dealt alike, so where there may be many they are merged into one with a count
before. ``merged`` does that, and ``star_join`` multiplies the counts of what it joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditgrade.operators.statistics import KeyStatistics
from creditgrade.sources.sinks import write_shared

# Rows that one task should make of one key.
ROWS_PER_TASK = 1_000_000
CELL = "_cell"
TIMES = "_times"
_STEP = 4096


def crowded_keys(
    tables: Sequence[DataFrame],
    key: str,
    rows_per_task: int = ROWS_PER_TASK,
    how: str = "inner",
    statistics: KeyStatistics | None = None,
) -> DataFrame | None:
    """The crowded keys of a join of tables, with the parts of each table; None if none.

    Columns: the key and ``p0``, ``p1``, ... Zero parts say that the key's rows join nothing
    and can be left out. All tables are counted in one grouping, merged before its shuffle.
    A null key joins nothing, but a left join keeps its rows, so it is counted too. The
    list is written to the shared folder once.

    ``statistics`` are those of rows that give a key no fewer rows than each of the tables. They
    spare the counting where no key can be crowded, and else all keys but the heavy ones.
    """
    if statistics is not None:
        if statistics.never_above(key, len(tables), rows_per_task):
            return None
        tables = [statistics.candidates(table, key, len(tables), rows_per_task) for table in tables]
    numbers = range(len(tables))
    tagged = [
        table.selectExpr(key, *(f"{int(n == m)} AS n{m}" for m in numbers))
        for n, table in enumerate(tables)
    ]
    made = " * ".join(f"greatest(double(n{n}), 1)" for n in numbers)
    # Pieces of this many rows of every table make rows_per_task rows together.
    piece = max(1, int(rows_per_task ** (1 / len(tables))))
    counts = (
        reduce(DataFrame.union, tagged)
        .groupBy(key)
        .agg(*(F.expr(f"sum(n{n}) AS n{n}") for n in numbers))
        .filter(f"{made} > {rows_per_task}")
    )
    needed = [f"n{n} > 0" for n in (numbers if how == "inner" else numbers[:1])]
    parts = [
        f"IF({key} IS NULL OR {' AND '.join(needed)}, greatest(1, bigint(ceil(n{n} / {piece}))), 0L)"
        f" AS p{n}"
        for n in numbers
    ]
    found = write_shared(counts.selectExpr(key, *parts), "crowded-keys")
    return None if found.isEmpty() else found


def numbered(df: DataFrame, times: str, name: str, spread: bool = False) -> DataFrame:
    """Each row ``times`` times, with a number from 0; rows without times go.

    Made in three steps, so that no array grows with the number. With ``spread``, the steps
    of one row go to different tasks; rows of one step are not moved.
    """
    columns = [f"`{column}`" for column in df.columns]
    large = _STEP * _STEP
    if spread:
        few = numbered(df.filter(f"{times} <= {_STEP}"), times, name)
        df = df.filter(f"{times} > {_STEP}")
    blocks = df.filter(f"{times} > 0").selectExpr(
        "*", f"explode(sequence(0L, ({times} - 1) DIV {large})) AS _large"
    )
    blocks = blocks.selectExpr(
        "*",
        f"explode(sequence(0L, least({_STEP - 1}, ({times} - 1 - _large * {large}) DIV {_STEP})))"
        " AS _small",
    ).selectExpr("*", f"_large * {large} + _small * {_STEP} AS _from")
    if spread:
        blocks = blocks.hint("rebalance")
    rows = blocks.selectExpr(
        "*", f"explode(sequence(0L, least({_STEP}, {times} - _from) - 1)) AS _one"
    ).selectExpr(*columns, f"_from + _one AS {name}")
    return few.union(rows) if spread else rows


def repeat_rows(df: DataFrame, times: str = TIMES, spread: bool = True) -> DataFrame:
    """Each row as often as its ``times`` column says; the column is dropped.

    With ``spread``, the copies of one row are made by several tasks where they are very many.
    """
    return numbered(df, times, "_copy", spread).drop("_copy", times)


def merged(df: DataFrame, times: str = TIMES) -> DataFrame:
    """Equal rows as one with their number, added up where rows have one already."""
    columns = [name for name in df.columns if name != times]
    count = f"sum({times})" if times in df.columns else "count(*)"
    return df.groupBy(*columns).agg(F.expr(f"{count} AS {times}"))


def merged_by(df: DataFrame, key: str, statistics: KeyStatistics | None) -> DataFrame:
    """``merged``, for a join or grouping by the key that follows.

    Where statistics say that no key has very many rows, rows are dealt by the key alone, so what
    follows needs no other shuffle. Else copies are merged before they are dealt.
    """
    if statistics is None or not statistics.never_above(key, 1, ROWS_PER_TASK):
        return merged(df)
    return merged(df.repartition(key))


def with_cells(df: DataFrame, key: str, parts: DataFrame, number: int) -> DataFrame:
    """Add the cells of table ``number`` of the join, a row for each of them.

    Keys that are not crowded have the one cell 0. Rows of a crowded key are dealt by what a
    task that is run again finds anew: their hash and the number of the partition. The center (0) also gets the number of
    parts of each arm. A null key meets nothing, so its rows are only dealt.
    """
    names = [name for name in parts.columns if name != key]
    columns = [f"`{name}`" for name in df.columns]
    listed = parts.withColumnRenamed(key, "_crowded")
    placed = df.join(listed, F.col(key).eqNullSafe(F.col("_crowded")), "left").selectExpr(
        *columns,
        *(f"IF({key} IS NULL, 1L, coalesce({name}, 1L)) AS {name}" for name in names),
        f"coalesce(pmod(xxhash64(spark_partition_id(), {', '.join(columns)}), nullif(p{number}, 0)), 0L) AS _own",
    )
    return _in_cells(placed, df.columns, names, number)


def _in_cells(placed: DataFrame, kept: Sequence[str], names: Sequence[str], number: int) -> DataFrame:
    """A row for each cell of the rows, which have the numbers of parts and their own part."""
    columns = [f"`{name}`" for name in kept]
    below = " * ".join(["1L", *names[:number]])
    others = " * ".join(["1L", *(name for name in names if name != f"p{number}")])
    placed = placed.selectExpr("*", f"{below} AS _below", f"IF(p{number} = 0, 0L, {others}) AS _others")
    cell = f"_at % _below + _own * _below + _at DIV _below * _below * p{number}"
    return numbered(placed, "_others", "_at").selectExpr(
        *columns, *(names[1:] if number == 0 else ()), f"{cell} AS {CELL}"
    )


def star_join(
    center: DataFrame, arms: Sequence[DataFrame], key: str, parts: DataFrame | None, how: str
) -> DataFrame:
    """Join every arm to the center on one key (``how``: ``left`` or ``inner``).

    The center is table 0 of the list of crowded keys, the arms follow. Tables may have a
    number of equal rows in ``_times``, and have merged rows if there are crowded keys; the
    result has their product in ``_times``. Columns other than these two must have
    different names.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how!r}")
    tables = [
        (table if TIMES in table.columns else table.selectExpr("*", f"1L AS {TIMES}"))
        .withColumnRenamed(TIMES, f"_times{n}")
        for n, table in enumerate([center, *arms])
    ]
    if parts is None:
        joined = reduce(lambda left, arm: left.join(arm, key, how), tables)
    else:
        joined = _join_cells([with_cells(table, key, parts, n) for n, table in enumerate(tables)], key, how)
    columns = [f"`{name}`" for table in (center, *arms) for name in table.columns
               if name not in (key, TIMES)]
    product = " * ".join(f"coalesce(_times{n}, 1L)" for n in range(len(tables)))
    return joined.selectExpr(key, *columns, f"{product} AS {TIMES}")


def _join_cells(cells: Sequence[DataFrame], key: str, how: str) -> DataFrame:
    joined = reduce(lambda left, arm: left.join(arm, [key, CELL], how), cells)
    if how == "left":
        # A center row meets the parts of an arm in several cells. Where a part got no rows,
        # it is left without a partner there; it has one in another cell.
        for n in range(1, len(cells)):
            joined = joined.filter(f"_times{n} IS NOT NULL OR p{n} = 1")
    return joined


def counted_join(
    center: DataFrame,
    arms: Sequence[DataFrame],
    key: str,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> tuple[DataFrame, bool]:
    """``star_join`` of any tables: finds crowded keys, and merges copies if there are any.

    The second value says whether there were any; if not, no row stands for more rows than
    a task should make.

    Row counts without regard to copies tell that nothing is crowded. Where something is,
    the tables are merged and stored, and what is still crowded then is dealt over a grid. Where
    statistics say that a task can hold all rows of any key, that is done by ``dealt_join``.
    """
    tables = [center, *arms]
    if dealt_at_once(key, len(tables), rows_per_task, statistics):
        return dealt_join(center, arms, key, how, rows_per_task), True
    parts = crowded_keys(tables, key, rows_per_task, how, statistics)
    crowded = parts is not None
    if crowded:
        tables = [write_shared(merged(table), "merged") for table in tables]
        parts = crowded_keys(tables, key, rows_per_task, how, statistics)
    return star_join(tables[0], tables[1:], key, parts, how), crowded


def _with_pieces(counted: DataFrame, tables: int, rows_per_task: int) -> DataFrame:
    """Add ``q0``, ``q1``, ...: the rows of each table that make ``rows_per_task`` together at most.

    Cells repeat the fewest rows where pieces are of one size. A table that has fewer rows leaves
    its room to the others, and so does what is lost by rounding down: tables are taken by their
    number of rows ``n0``, ``n1``, ..., and each gets its root of the room that is left.
    """
    columns, places = counted.columns, range(tables)
    sizes = ", ".join(f"struct(greatest(n{n}, 1L) AS n, {n} AS i)" for n in places)
    df = counted.selectExpr("*", f"sort_array(array({sizes})) AS _sizes", f"bigint({rows_per_task}) AS _room0")
    for place in places:
        root = f"greatest(1L, bigint(floor(pow(_room{place}, 1D / {tables - place}) + 1e-9)))"
        df = df.selectExpr("*", f"least(_sizes[{place}].n, {root}) AS _piece{place}")
        df = df.selectExpr("*", f"_room{place} DIV _piece{place} AS _room{place + 1}")
    found = [" ".join(f"WHEN _sizes[{place}].i = {n} THEN _piece{place}" for place in places) for n in places]
    return df.selectExpr(*columns, *(f"CASE {cases} END AS q{n}" for n, cases in enumerate(found)))


def dealt_at_once(key: str, tables: int, rows_per_task: int, statistics: KeyStatistics | None) -> bool:
    """Whether keys may be crowded, but a task can hold all rows of any one key."""
    if statistics is None or statistics.never_above(key, tables, rows_per_task):
        return False
    return statistics.never_above(key, 1, ROWS_PER_TASK)


def dealt_join(
    center: DataFrame,
    arms: Sequence[DataFrame],
    key: str,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``star_join`` of tables of which a task can hold all rows of any one key.

    Each table is dealt by the key once. There its copies are merged, its keys counted, and the
    rows of keys that are not crowded joined; only rows of crowded keys are moved again, to the
    cells of their grid. Nothing is written on the way.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how!r}")
    sources = [center, *arms]
    numbers = range(len(sources))
    # Other names, so that plans of one table read twice stay alike and share their shuffle.
    names = [{c: f"_{n}_{c}" for c in table.columns if c not in (key, TIMES)} for n, table in enumerate(sources)]
    nullable = center.schema[key].nullable
    tables = []
    for n, table in enumerate(sources):
        there = table.filter(f"{key} IS NOT NULL") if table.schema[key].nullable else table
        times = [F.col(TIMES).alias(f"_times{n}")] if TIMES in table.columns else []
        own = there.select(F.col(key).alias("_key"), *(F.col(c).alias(name) for c, name in names[n].items()), *times)
        tables.append(merged(own.repartition("_key"), f"_times{n}"))
    # The counts read all columns of the rows, so that both come from one shuffle.
    counts = [
        table.groupBy("_key").agg(F.expr(f"count_if(_times{n} > 0) AS n{n}")) for n, table in enumerate(tables)
    ]
    every = reduce(lambda left, arm: left.join(arm, "_key", how), counts).selectExpr(
        "_key", *(f"coalesce(n{n}, 0L) AS n{n}" for n in numbers)
    )
    made = " * ".join(f"greatest(double(n{n}), 1)" for n in numbers)
    parts = _with_pieces(every.filter(f"{made} > {rows_per_task}"), len(numbers), rows_per_task)
    parts = parts.selectExpr("_key", *(f"greatest(1L, bigint(ceil(n{n} / q{n}))) AS p{n}" for n in numbers))
    cells = [
        _in_cells(
            table.join(parts, "_key").selectExpr(
                "*", f"pmod(xxhash64({', '.join(f'`{name}`' for name in table.columns)}), p{n}) AS _own"
            ),
            table.columns, parts.columns[1:], n,
        )
        for n, table in enumerate(tables)
    ]
    few = reduce(
        lambda left, arm: left.join(arm, "_key", how), [tables[0].join(parts, "_key", "left_anti"), *tables[1:]]
    )
    product = " * ".join(f"coalesce(_times{n}, 1L)" for n in numbers)
    found, crowded = (
        joined.select(
            F.col("_key").alias(key),
            *(F.col(name).alias(c) for own in names for c, name in own.items()),
            F.expr(product).alias(TIMES),
        )
        for joined in (few, _join_cells(cells, "_key", how))
    )
    found = found.union(crowded)
    if how == "left" and nullable:
        # A null key meets nothing.
        alone = merged(center.filter(f"{key} IS NULL"))
        found = found.union(alone.select(
            *(F.col(name) if name in alone.columns else F.lit(None).cast(found.schema[name].dataType).alias(name)
              for name in found.columns)
        ))
    return found


def crowds(
    center: DataFrame,
    key: str,
    rows_per_task: int = ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> DataFrame | None:
    """Crowded keys of one table, for ``join_few``."""
    return crowded_keys([center], key, rows_per_task, statistics=statistics)


def join_few(
    center: DataFrame, few: DataFrame, key: str, parts: DataFrame | None, how: str
) -> DataFrame:
    """Join a table with another one that has few rows per key.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``; ``parts`` are the crowded
    keys of the center, or of a table with its rows and more. The center's rows are only
    dealt, and the few rows repeated in each part. Equal center rows of one input partition
    go to one task.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how!r}")
    if parts is None:
        return center.join(few, key, how)
    listed = parts.selectExpr(key, "greatest(p0, 1L) AS p0", "1L AS p1")
    dealt = with_cells(center, key, listed, 0).drop("p1")
    joined = dealt.join(with_cells(few, key, listed, 1), [key, CELL], how)
    return joined.drop(CELL)
