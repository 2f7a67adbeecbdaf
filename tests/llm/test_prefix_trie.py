"""The prefix trie against a plain one, built node by node."""

import hashlib
import math
import random
import re
import zlib

import pytest

from creditgrade.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, tie), (role, text)))
    own = {conv: [t for _, t in sorted(turns)] for conv, turns in own.items()}
    convs = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        convs[conv] = tuple(own.get(conv - int(math.fmod(conv, 20)), [])[:h] + turns[h:])
    members = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in below) or 1
        words = len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in below)
        ends = ",".join(str(c) for c in sorted(c for c in members[node] if len(convs[c]) == len(node)))
        out.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
            len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def conversations(seed, n=150):
    """Shared beginnings of all lengths, copies, ties, nulls and a conversation of many turns."""
    rng = random.Random(seed)
    made, rows = [], []
    for _ in range(n):
        turns = list(rng.choice(made)) if made and rng.random() < 0.8 else []
        turns = turns[: rng.randrange(len(turns) + 1)] if rng.random() < 0.7 else turns
        for _ in range(rng.choice([0, 0, 1, 2, 5, 9])):
            turns.append((rng.choice(["user", "system", None]), rng.choice([None, "", " a\tb ", "x y z", "é ü"])))
        made.append(turns)
    made += [made[3]] * 40 + [[("user", "w")] * 70]
    ids = rng.sample(range(400), len(made))
    for conv, turns in zip(ids, made, strict=True):
        for i, (role, text) in enumerate(turns):
            rows.append((conv, i if i or rng.random() < 0.8 else None, role, text))
        if turns and rng.random() < 0.2:
            rows += [(conv, 1, "user", "tie"), (conv, 1, "user", "tie"), (conv, 1, "bot", "tie 2")]
    rows += [(None, 1, "user", "nobody"), (1000, 0, "user", "long " * 200_000), (-7, 0, "user", "x"), (-7, 1, "b", "y")]
    return rows


@pytest.mark.parametrize("seed,block,piece", [(1, 8, 4096), (2, 2, 3), (3, 3, 1)])
def test_against_a_plain_trie(spark, monkeypatch, seed, block, piece):
    monkeypatch.setattr(p, "BLOCK", block)
    monkeypatch.setattr(p, "PIECE", piece)
    monkeypatch.setattr(p, "IDS_PER_PIECE", piece)
    rows = conversations(seed)
    table = spark.createDataFrame([(*r, "d", 1) for r in rows], SCHEMA).repartition(4)
    found = p.prefix_trie(table)
    assert set(found.columns) == {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                                  "n_leaves", "saved_tokens", "ends_sha256"}
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_small_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert p.prefix_trie(empty).count() == 0
    # A conversation that gives up three turns for those of conversation 0, which is not there.
    conv = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(conv, i, "user", "a") for i in range(3)]
    found = p.prefix_trie(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows) and len(found) == 1


def test_a_branch_on_a_branch(spark):
    """Paths that hang on one another, seven deep: sums go up by jumps."""
    rows = []
    for k in range(1, 9):
        conv = 20 * k  # the first of its group: rebuilt as it is
        rows += [(conv, i, "user", f"w {i}" if i < k else f"end of {k}") for i in range(k + 3)]
    found = p.prefix_trie(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)
