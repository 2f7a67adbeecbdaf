"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditgrade.llm import (
    boilerplate,
    decontaminate,
    langid,
    lexical,
    licenses,
    mixing,
    ngram,
    prefix_trie,
    sharding,
    simhash,
    suffix_dedup,
    topk,
    toxicity,
)
from creditgrade.llm.common import id_remainder, stored

Query = Callable[[SparkSession, str], DataFrame]
TOP_K = 5
TOP_RANKED = 50
N_SHARDS = 40
MAX_REPEATS = 1.25
SIMHASH_WORDS, SIMHASH_RADIUS = 3, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", topk.whole_numbers("embedding").alias("v")
    )
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), TOP_K)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, width=SIMHASH_WORDS, radius=SIMHASH_RADIUS)
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngram.train(docs.filter(id_remainder("doc_id", 10) != 0))
    scored = ngram.score(docs, model)
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(id_remainder("doc_id", 5) != 0))
    return toxicity.score(docs, model).select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(id_remainder("doc_id", 4) != 2))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (id_remainder("doc_id", 4) == 2).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def op6_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "coalesce(octet_length(text), 0) + 16L AS size",
        "crc32(coalesce(cast(text AS binary), X'')) AS text_crc32",
        "'key' AS law",
    )
    placed = sharding.assign_shards(docs, "doc_id", N_SHARDS)
    grown = sharding.assign_shards(placed, "doc_id", N_SHARDS + 1, "grown_shard")
    return sharding.with_slots(grown, "shard", ["doc_id", "text_crc32", "size"])


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    slim = stored(docs.select("doc_id", "source", mixing.n_tokens("text").alias("n_tokens")), "mix-docs")
    plan = mixing.plan_mix(slim, max_repeats=MAX_REPEATS)
    weights = plan.selectExpr("source AS _of", "weight", "budget")
    copies = mixing.with_copies(slim, plan)
    return copies.join(weights, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("hits") > 0).alias("contaminated"),
        F.array_join(F.expr("array_sort(hits.item_id)"), ",").alias("item_ids"),
        F.coalesce(F.array_max("hits.similarity"), F.lit(0.0)).alias("similarity"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.with_licences(docs, "text")
    return found.select(
        "doc_id",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, table(spark, sf_dir, "benchmark"), top=TOP_RANKED)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = boilerplate.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return boilerplate.judge(docs, model, keep=["doc_id"])


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_topk,
        op2_simhash_dedup,
        op3_lm_score,
        op4_toxicity,
        op5_language_id,
        op6_jump_shards,
        op7_source_mix,
        op8_decontaminate,
        op9_license_scan,
        op10_suffix_dedup,
        op11_lexical_search,
        op12_prefix_trie,
        op13_quality_rules,
    )
}
