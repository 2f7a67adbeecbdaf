"""The pipeline, stage by stage."""

import pytest
from llm_brute_force import components, fingerprint

import corpus_pipeline as p
from creditgrade.llm import decontaminate

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, sf_dir):
    """Documents with nulls, empty and repeated rows, copies, leaks and a clashing column."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = [(*r, "x") for r in docs]
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    rows += [(1000, docs[3]["text"], "en", "src1", 5, "y"), (*docs[7], "x"), (*docs[7], "x")]
    rows += [(1001, None, None, None, None, None), (1002, "", "en", "a", 0, None), (1003, "12 34", None, "a", 5, "z")]
    rows += [(1004, docs[9]["text"] + " " + items[0]["text"], "en", None, 9, None), (None, "the of and to", "en", "b", 1, "")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, items


def test_stages(spark, tables):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = p.language_id(spark, docs, folder)
    assert kept.columns == docs.columns
    known = {r[0] for r in kept.select("doc_id").collect()}
    assert not known & {1001, 1002, 1003} and len(known) >= 200

    one = p.near_dedup(spark, docs, folder)
    assert one.columns == docs.columns
    left = [r["doc_id"] for r in one.collect()]
    ids = {i: -1 if r[0] is None else r[0] for i, r in enumerate(rows)}
    prints = {i: fingerprint(r[1], 3) for i, r in enumerate(rows)}
    top = components(prints, 2)
    groups = {}
    for i, root in top.items():
        groups.setdefault(root, []).append(ids[i])
    assert sorted(-1 if i is None else i for i in left) == sorted(min(g) for g in groups.values())

    clean = p.decontamination(spark, docs, folder)
    assert clean.columns == docs.columns
    gone = {r[0] for r in rows} - {r["doc_id"] for r in clean.collect()}
    held = {r[0] for r in rows for item in items
            if b" ".join(decontaminate.words_of(item["text"])) in b" ".join(decontaminate.words_of(r[1]))}
    assert held <= gone and 1004 in gone

    mixed = p.mixing_sources(spark, docs, folder)
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.collect()} == {r[0] for r in rows}

    placed = p.shards(spark, docs, folder)
    assert placed.columns == [*docs.columns[:-1], "shard", "slot"] and placed.count() == len(rows)


def test_run_and_empty(spark, tables, tmp_path):
    folder, rows, _ = tables
    out = p.run(spark, folder)
    slots = {}
    for r in out.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0
