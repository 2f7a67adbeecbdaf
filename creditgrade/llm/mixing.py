"""Temperature mixing: source token shares to target weights, realised as repetitions.

A source with share p of the tokens gets the weight p**a / sum(p**a). The exponent a, from
0 (all sources alike) to 1 (shares as they are), is bisected to meet an entropy of the
weights or a limit on how often a source is repeated. The weights become token budgets:
whole passes over a source, and for the rest of its budget the first blocks of a
permutation of its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditgrade.llm.common import stored

TOKEN = r"[^\\x20\\x09-\\x0D]+"
PRECISION = 1e-6
STEPS = 64
BLOCK_TOKENS = 1_000_000
_ORDER = 1 << 62


def n_tokens(text: str) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.expr(f"coalesce(regexp_count(string(`{text}`), '{TOKEN}'), 0)").cast("long")


def permuted(key: str, seed: int) -> Column:
    """A document's place in the permutation: a hash of its key, 0 to 2**62."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(_ORDER))


def _weigh(shares: DataFrame, exponent: float) -> DataFrame:
    """Weights of the sources; a source without tokens has none."""
    raised = shares.withColumn(
        "_raised", F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent))).otherwise(0.0)
    )
    return raised.withColumn("_total", raised.agg(F.sum("_raised")).scalar()).select(
        "source", "tokens", "share",
        F.expr("coalesce(try_divide(_raised, _total), 0.0)").alias("weight"),
    )


def _measured(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent the entropy of the weights in nats, and the most repetitions.

    Repetitions are counted at the smallest budget at which no source loses a document. One
    pass over the sources: with T = sum(p**a), the entropy is ln(T) - a * sum(p**a * ln(p)) / T.
    """
    values = ", ".join(f"{float(a)!r}D" for a in exponents)
    rows = (
        shares.filter("tokens > 0")
        .selectExpr("share", f"posexplode(array({values})) AS (n, a)")
        .groupBy("n")
        .agg(
            F.expr("ln(sum(pow(share, a))) - first(a) * sum(pow(share, a) * ln(share)) / sum(pow(share, a))")
            .alias("entropy"),
            F.expr("max(pow(share, a) / share) / min(pow(share, a) / share)").alias("repeats"),
        )
        .collect()
    )
    found = {row["n"]: (row["entropy"], row["repeats"]) for row in rows}
    return [found.get(n, (0.0, 1.0)) for n in range(len(exponents))]


def _bisect(shares: DataFrame, measure: int, least: bool, limit: float, good: float, bad: float) -> float:
    """The exponent nearest to ``bad`` whose measure still keeps the limit.

    A pass halves the interval as often as STEPS has powers of two: all the middles that the
    halvings could look at are measured together.
    """
    while abs(bad - good) > PRECISION:
        between = [good + (bad - good) * k / STEPS for k in range(STEPS + 1)]
        found = [m[measure] >= limit if least else m[measure] <= limit for m in _measured(shares, between)]
        low, high = 0, STEPS
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if found[middle] else (low, middle)
        good, bad = between[low], between[high]
    return good


def bisect_exponent(
    shares: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None
) -> float:
    """The exponent that meets the targets.

    With an entropy, the largest exponent that reaches it (0 where none does); with a limit
    on repetitions, the smallest one that keeps it; with both, the limit wins; with neither,
    1. Entropy and repetitions both fall as the exponent grows.
    """
    exponent = 1.0 if max_repeats is None or target_entropy is not None else 0.0
    if target_entropy is not None and _measured(shares, [1.0])[0][0] < target_entropy:
        exponent = _bisect(shares, 0, True, target_entropy, 0.0, 1.0)
    if max_repeats is not None and _measured(shares, [exponent])[0][1] > max_repeats:
        exponent = _bisect(shares, 1, False, max_repeats, 1.0, exponent)
    return exponent


def plan_mix(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget_tokens: int | None = None,
    seed: int = 7,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Per source: tokens, share, weight, budget, whole passes, and where the rest ends.

    ``docs`` has doc_id, source and n_tokens and should be a stored table, as it is read
    several times. Without a budget, it is the smallest one at which every document is kept
    once. Documents whose place lies below ``cutoff`` are taken once more. Places are cut
    into blocks of about ``block_tokens`` tokens of a source; blocks are taken whole in the
    order of the permutation while they fit, and of the first block that does not fit the
    documents before the first that does not. So no source is ever sorted as a whole.
    A null source is a source. Without documents the plan is empty. The plan is stored: it
    has one row per source, and Spark sees its size when it is joined.
    """
    placed = docs.select("source", "n_tokens", permuted("doc_id", seed).alias("place"))
    totals = placed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    totals = stored(totals, "mix-tokens")
    shares = totals.withColumn("_all", totals.agg(F.sum("tokens")).scalar()).select(
        "source", "tokens", F.expr("coalesce(try_divide(tokens, _all), 0.0)").alias("share")
    )
    weights = _weigh(shares, bisect_exponent(shares, target_entropy, max_repeats))
    if budget_tokens is None:
        budget = weights.agg(F.expr("max(try_divide(tokens, weight))")).scalar()
        # Doubles round; no source gets less than its tokens, or it would lose documents.
        least = "tokens"
    else:
        budget, least = F.lit(float(budget_tokens)), "0L"
    plan = (
        weights.withColumn("_budget", budget)
        .withColumn("budget", F.expr(f"greatest({least}, bigint(coalesce(_budget * weight, 0) + 1e-6))"))
        .withColumn("passes", F.expr("IF(tokens > 0, budget DIV tokens, 1)"))
        .withColumn("rest", F.expr("budget - passes * tokens"))
        .withColumn("width", F.expr(f"{_ORDER}D / greatest(1, tokens DIV {block_tokens})"))
        .drop("_budget")
    )
    plan = stored(plan, "mix-budgets")
    needs = plan.filter("rest > 0").selectExpr("source AS _source", "rest", "width")
    blocked = placed.join(needs, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "block", F.expr("bigint(place / width)")
    )
    # Blocks of a source are few: about its tokens over block_tokens.
    filled = (
        blocked.groupBy("source", "block", "rest")
        .agg(F.sum("n_tokens").alias("n"))
        .withColumn("before", F.expr("sum(n) OVER (PARTITION BY source ORDER BY block) - n"))
    )
    cut = filled.filter("before <= rest AND before + n > rest").selectExpr(
        "source AS _cut", "block AS cut_block", "rest - before AS left"
    )
    edges = (
        blocked.join(
            cut,
            F.col("source").eqNullSafe(F.col("_cut")) & (F.col("block") == F.col("cut_block")),
        )
        .groupBy("source", "left", "place")
        .agg(F.sum("n_tokens").alias("n"))
        .withColumn("upto", F.expr("sum(n) OVER (PARTITION BY source ORDER BY place)"))
        .filter("upto > left")
        .groupBy("source")
        .agg(F.min("place").alias("cutoff"))
        .withColumnRenamed("source", "_edge")
    )
    planned = plan.join(edges, F.col("source").eqNullSafe(F.col("_edge")), "left").select(
        "source", "tokens", "share", "weight", "budget", "passes",
        F.expr("coalesce(cutoff, 0)").alias("cutoff"),
    )
    return stored(planned, "mix-plan")


def with_copies(
    docs: DataFrame, plan: DataFrame, seed: int = 7, name: str = "copies"
) -> DataFrame:
    """Add how often the mix holds each document; a column of that name is replaced."""
    chosen = plan.selectExpr("source AS _source", "passes AS _passes", "cutoff AS _cutoff")
    columns = [column for column in docs.columns if column != name]
    once_more = F.when(permuted("doc_id", seed) < F.col("_cutoff"), 1).otherwise(0)
    return docs.join(chosen, F.col("source").eqNullSafe(F.col("_source"))).select(
        *columns, (F.col("_passes") + once_more).cast("long").alias(name)
    )


def mixed(docs: DataFrame, plan: DataFrame, seed: int = 7) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    counted = with_copies(docs, plan, seed, "_copies").filter("_copies > 0")
    return counted.withColumn("_copy", F.expr("explode(sequence(1, _copies))")).select(
        *docs.columns
    )
