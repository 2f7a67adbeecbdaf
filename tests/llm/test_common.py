"""Shared helpers."""

import os

import pyarrow as pa

from creditgrade.llm.common import bounded_sample, released


def test_bounded_sample(spark):
    rows = spark.range(20_000).selectExpr("IF(id < 19000, 'hot', 'rare' || id % 2) AS g", "id AS k")
    found = bounded_sample(rows.repartition(7), "g", "k", 600, 1).collect()
    by_group = {}
    for row in found:
        by_group.setdefault(row["g"], []).append(row["n"])
    assert {g: len(n) for g, n in by_group.items()} == {"hot": 600, "rare0": 500, "rare1": 500}
    assert sorted(by_group["hot"]) == list(range(1, 601))
    again = bounded_sample(rows.repartition(3), "g", "k", 600, 1).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    assert bounded_sample(rows.limit(0), "g", "k", 5, 1).count() == 0


def test_released_gives_memory_back():
    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20

    def results():
        for size in (1, 3, 7, 20):
            buffers = [pa.allocate_buffer(size << 18) for _ in range(160 // size)]
            for buffer in buffers:
                pages = memoryview(buffer).cast("B")[::4096]
                pages[:] = bytes(len(pages))
            yield size

    assert list(released(iter([]))) == []
    pa.default_memory_pool().release_unused()
    before = resident()
    assert list(released(results())) == [1, 3, 7, 20]
    assert resident() - before < 15
