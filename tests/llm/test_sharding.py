"""Jump consistent hashing and slots."""

import numpy as np

from creditgrade.llm import sharding


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_against_the_plain_loop():
    keys = np.random.default_rng(2).integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2)
    for n in (1, 2, 40, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]


def test_growing_moves_only_into_the_new_shard():
    keys = np.arange(20_000, dtype=np.uint64) * np.uint64(11400714819323198485)
    old, new = sharding.jump_hash(keys, 40), sharding.jump_hash(keys, 41)
    moved = old != new
    assert set(new[moved]) == {40} and 0.015 < moved.mean() < 0.035
    assert np.bincount(old, minlength=40).min() > 350


def test_slots(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 7)
    rows = [(i % 40 if i % 3 else None, f"t{i % 5}", -1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    found = sharding.with_slots(sharding.assign_shards(docs, "doc_id", 4), "shard", ["doc_id", "text"])
    assert found.columns == ["doc_id", "text", "shard", "slot"]
    by_shard = {}
    for row in found.collect():
        by_shard.setdefault(row["shard"], []).append(row["slot"])
    assert sum(map(len, by_shard.values())) == 200
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert sharding.with_slots(
        sharding.assign_shards(docs.limit(0), "doc_id", 4), "shard", ["doc_id"]
    ).count() == 0
