"""The registered queries: SQL where there is some, and the digests of the others."""

import hashlib

import pytest

from conformance.compare import difference, oracle_connection
from creditgrade.llm.oracle import ORACLE_SQL
from creditgrade.llm.queries import QUERIES


NOT_PER_DOCUMENT = ("op1_topk", "op11_lexical_search", "op12_prefix_trie")


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_against_sql(spark, sf_dir, name):
    connection = oracle_connection(sf_dir)
    assert difference(QUERIES[name](spark, sf_dir), connection.sql(ORACLE_SQL[name]).df()) is None


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in NOT_PER_DOCUMENT])
def test_one_row_per_document(spark, sf_dir, documents, name):
    rows = QUERIES[name](spark, sf_dir).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)


def test_held_out_quality(spark, sf_dir, documents):
    languages = QUERIES["op5_language_id"](spark, sf_dir).collect()
    held_out = [r for r in languages if r["held_out"]]
    right = sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held_out)
    assert held_out and right >= 0.95 * len(held_out)
    # Ten toxic documents are too few to learn from; tests/llm/test_toxicity.py has more.
    assert all(0 <= r["score"] <= 1 for r in QUERIES["op4_toxicity"](spark, sf_dir).collect())


def test_digests(spark, sf_dir, documents):
    for row in QUERIES["op10_suffix_dedup"](spark, sf_dir).collect():
        data = documents[row["doc_id"]]["text"].encode()
        assert row["n_bytes"] == len(data)
        if not row["n_removed"]:
            assert row["kept_sha256"] == hashlib.sha256(data).hexdigest() and row["n_spans"] == 0
    slots = {}
    for row in QUERIES["op6_jump_shards"](spark, sf_dir).collect():
        assert row["size"] == len(documents[row["doc_id"]]["text"].encode()) + 16
        assert row["grown_shard"] in (row["shard"], 40)
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
