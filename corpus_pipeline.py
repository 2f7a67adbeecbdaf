"""A training corpus from raw documents: five stages, each one operator over all documents.

1. Language: documents in none of the known languages, and those without letters, go.
2. Near copies: one document of each group linked by their SimHash fingerprints stays.
3. Decontamination: documents that hold a benchmark item go.
4. Mixing: sources are repeated towards the target weights; every document stays.
5. Sharding: each row gets its shard and its place in it.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept. All but the last
return the columns of the documents. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditgrade.llm import decontaminate, langid, mixing, sharding, simhash
from creditgrade.llm.common import stored
from creditgrade.llm.queries import MAX_REPEATS, N_SHARDS, SIMHASH_RADIUS, SIMHASH_WORDS, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified and not rejected.

    The models are fitted on a bounded sample of the labelled documents.
    """
    model = langid.train(docs)
    found = langid.identify(docs, model, prefix="_language_")
    return found.filter("NOT _language_rejected").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Linked by the SimHash operator at its own shingle length and bit distance.
    """
    return simhash.one_per_component(docs, width=SIMHASH_WORDS, radius=SIMHASH_RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or nearly so."""
    found = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"), name="_items")
    return found.filter(F.size("_items") == 0).select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources more often."""
    slim = docs.select("doc_id", "source", mixing.n_tokens("text").alias("n_tokens"))
    plan = mixing.plan_mix(stored(slim, "mix-docs"), max_repeats=MAX_REPEATS)
    return mixing.mixed(docs, plan)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with ``shard`` and ``slot``; a document and its repetitions share a shard."""
    placed = sharding.assign_shards(docs, "doc_id", N_SHARDS)
    return sharding.with_slots(placed, "shard", ["doc_id"])


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
    ("sharding", shards),
]

# Language models and fingerprints are beyond SQL; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
