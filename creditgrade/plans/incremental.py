"""Scores, bad members and customers kept up to date as new applications come in.

Every batch of applications leaves partial states that can be merged: per member its number of
rows and the points of its row, per loan id its loan rows and its number of repayments, and the
customer rows that were not there before with the sum and count of their employment years. A
batch is a run (``sources.runs``) and its states are never changed later; what holds of a key now
is the merge of its states in all runs.

Results of a member depend on its own rows and on those with the loan id of its one loan. So a
batch touches the members it has rows of, and the members who own a loan id that it has a loan
or a repayment of. Only those are judged and scored anew, from the states that concern them;
states of other keys are left out by a Bloom filter before anything is shuffled. A member's
results are those of the last run that touched it. Beyond the number of keys that such a
filter may have, all old states are grouped or joined once. Joins and groupings that most rows
do not need get the other rows only: members whose loan may be repaid twice, and customer rows
of members with several.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditgrade.functions import cleaning as clean
from creditgrade.functions import scores
from creditgrade.functions.identity import packed_key, unpacked_key
from creditgrade.operators import projections, skew
from creditgrade.operators.wanted import wanted_keys
from creditgrade.plans import direct, tables
from creditgrade.plans.scoring import graded
from creditgrade.schema import COUNTRY, CUSTOMER_FIELDS
from creditgrade.scorecard import Scorecard
from creditgrade.sources.runs import Run, RunWriter, complete_runs
from creditgrade.sources.sinks import write_shared

_CUSTOMER = tuple(target for target, _ in CUSTOMER_FIELDS.values())
_PARTS = ("payment_history_pts", "defaulters_history_pts", "financial_health_pts")


class OtherScorecard(ValueError):
    """States keep points, so all batches below one root use one scorecard."""


def application_facts(rows: DataFrame, card: Scorecard) -> DataFrame:
    """What the states take of each typed application: customer, loan, repayment and points."""
    counts = ("delinq_2yrs", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")
    whole = rows.withColumns(
        {name: clean.whole_or_zero(name) for name in counts}
        | {"mths_since_last_delinq": clean.whole_number("mths_since_last_delinq")}
    )
    health = scores.financial_health(
        "loan_status", "home_ownership", "funded_amount", "total_high_credit_limit", "grade", card
    )
    complete, paid = direct.complete_loan(), direct.is_paid()
    return whole.withColumn("address_country", F.lit(COUNTRY)).select(
        *_CUSTOMER,
        "loan_id",
        direct.owns_loan().alias("owned"),
        complete.alias("complete"),
        F.when(complete, F.col("monthly_installment")).alias("monthly_installment"),
        F.when(complete, F.col("funded_amount")).alias("funded_amount"),
        paid.alias("paid"),
        F.when(paid, F.col("last_payment_amount")).alias("last_payment_amount"),
        F.when(paid, direct.total_paid()).alias("total_payment_received"),
        clean.is_delinquent("delinq_2yrs", "mths_since_last_delinq").alias("delinquent"),
        scores.defaulters_history(*counts, card).alias("defaulters_history_pts"),
        health.alias("financial_health_pts"),
    )


def member_states(facts: DataFrame) -> DataFrame:
    """Per member its rows, and the loan id and points of its row if it has one only."""
    states = facts.select(
        "member_id",
        F.lit(1).cast("long").alias("n"),
        F.when(F.col("owned"), F.col("loan_id")).alias("loan_id"),
        "delinquent",
        "defaulters_history_pts",
        "financial_health_pts",
    )
    return _unpacked(merged_members(_packed(states)))


def _packed(df: DataFrame) -> DataFrame:
    return df.withColumn("member_id", packed_key("member_id"))


def _unpacked(df: DataFrame) -> DataFrame:
    return df.withColumn("member_id", unpacked_key("member_id"))


def repayment_states(facts: DataFrame) -> DataFrame:
    """Per loan id its number of repayments, and the repayment if there is one only."""
    paid = facts.filter("paid").selectExpr(
        "loan_id", "1L AS n", "last_payment_amount", "total_payment_received"
    )
    return merged_repayments(paid)


def merged_members(states: DataFrame) -> DataFrame:
    """Member states of several batches as one per member."""
    return states.groupBy("member_id").agg(
        F.expr("sum(n) AS n"),
        *(F.max(name).alias(name) for name in states.columns if name not in ("member_id", "n")),
    )


def merged_repayments(states: DataFrame) -> DataFrame:
    """Repayment states of several batches as one per loan id."""
    return states.groupBy("loan_id").agg(
        F.expr("sum(n) AS n"),
        F.max("last_payment_amount").alias("last_payment_amount"),
        F.max("total_payment_received").alias("total_payment_received"),
    )


def _loans(facts: DataFrame) -> DataFrame:
    return facts.filter("complete AND loan_id IS NOT NULL").select(
        "loan_id", "monthly_installment", "funded_amount"
    )


def _every(spark: SparkSession, runs: Sequence[Run], name: str) -> DataFrame | None:
    """A table of all runs, with the number of the run."""
    found = [run.table(spark, name).withColumn("run", F.lit(run.number)) for run in runs]
    return reduce(DataFrame.unionByName, found) if found else None


def _with_old(new: DataFrame, old: DataFrame | None) -> DataFrame:
    return new if old is None else new.union(old.select(*new.columns))


def _kept(states: DataFrame, keys: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """States of the listed keys; ``keys`` is stored and has each key once."""
    near = wanted_keys(keys, key).keep(states, key)
    return skew.join_few(near, keys, key, skew.crowds(near, key, rows_per_task), "left_semi")


def _new_customers(facts: DataFrame, old: DataFrame | None, now: DataFrame) -> DataFrame:
    """Different customer rows with an income that no earlier batch had.

    ``now`` are the members of the batch with their rows in all batches. The only row of a
    member is different and new, so only rows of members with several are shuffled.
    """
    rows = tables.with_income(facts.select(*_CUSTOMER))
    several = wanted_keys(now.filter("n > 1").select("member_id"), "member_id")
    rows, alone = several.split(rows, "member_id")
    both = rows.selectExpr("*", "false AS _known")
    if old is not None:
        known, _ = several.split(old.select(*rows.columns), "member_id")
        both = both.union(known.selectExpr("*", "true AS _known"))
    once = _packed(both).groupBy(*rows.columns).agg(F.expr("bool_or(_known) AS _known"))
    new = _unpacked(once.filter("NOT _known").drop("_known"))
    return new if alone is None else new.union(alone)


def _members_now(
    new: DataFrame, old: DataFrame | None, loan_ids: DataFrame, rows_per_task: int
) -> DataFrame:
    """States in all batches of the members with new rows, and of those who own one of the loan ids.

    Old states and the touched members go through one grouping, which finds the touched ones.
    """
    if old is None:
        return new
    changed = write_shared(loan_ids.distinct(), "changed-loans")
    sole = _packed(old.filter("n = 1 AND loan_id IS NOT NULL").select("member_id", "loan_id"))
    owners = _kept(sole, changed, "loan_id", rows_per_task).select("member_id").distinct()
    owners = write_shared(_unpacked(owners), "owners")
    likely = wanted_keys(new.select("member_id").union(owners), "member_id")
    states = (
        new.selectExpr("*", "true AS touched")
        .unionByName(owners.selectExpr("member_id", "0L AS n", "true AS touched"), allowMissingColumns=True)
        .unionByName(likely.keep(old.select(*new.columns), "member_id").selectExpr("*", "false AS touched"))
    )
    merged = merged_members(_packed(states)).filter("touched").drop("touched")
    return write_shared(_unpacked(merged), "member-states")


def _judged(now: DataFrame, repaid: DataFrame, rows_per_task: int) -> DataFrame:
    """Member states with whether the member is bad; only members with one row keep their loan.

    Only members whose loan id may be repaid twice are joined.
    """
    alone = "n = 1 AND loan_id IS NOT NULL"
    twice = repaid.filter("n > 1").selectExpr("loan_id", "true AS bad")
    likely, others = wanted_keys(twice, "loan_id").split(now.filter(alone), "loan_id")
    likely = _packed(likely)
    parts = skew.crowds(likely, "loan_id", rows_per_task)
    joined = skew.join_few(likely, twice, "loan_id", parts, "left")
    judged = _unpacked(joined).selectExpr(*now.columns, "coalesce(bad, false) AS bad")
    rest = now.filter(f"NOT ({alone})").withColumn("loan_id", F.expr("IF(n = 1, loan_id, NULL)"))
    judged = judged.union(rest.selectExpr("*", "n > 1 AS bad"))
    return judged if others is None else judged.union(others.selectExpr("*", "false AS bad"))


def add_applications(
    raw: DataFrame,
    root: str,
    card: Scorecard = Scorecard(),
    rows_per_task: int = skew.ROWS_PER_TASK,
) -> Run:
    """Add a batch of raw applications to the states below a shared folder.

    Rows that are given twice count twice, as they do within one batch. A batch that ends in
    the middle leaves no trace in the results and can be added again. Nulls: a loan id that is
    null joins nothing; a member key is never null. An empty batch touches nobody.
    """
    spark = raw.sparkSession
    runs = complete_runs(spark, root)
    if any(run.notes.get("scorecard") != repr(card) for run in runs):
        raise OtherScorecard("earlier batches were scored by another scorecard")
    run = RunWriter(spark, root)
    old = {name: _every(spark, runs, name) for name in ("members", "loans", "repayments", "customers")}

    rows = direct.typed_applications(projections.with_member_id(raw))
    facts = write_shared(application_facts(rows, card), "new-applications")
    members = run.write(member_states(facts), "members")
    loans = run.write(skew.merged(_loans(facts)), "loans")
    repayments = run.write(repayment_states(facts), "repayments")

    loan_ids = loans.select("loan_id").union(repayments.select("loan_id"))
    now = _members_now(members, old["members"], loan_ids, rows_per_task)
    customers = run.write(_new_customers(facts, old["customers"], now), "customers")
    run.write(
        tables.numbered_employment(customers).agg(
            F.sum(F.col("emp_length").cast("long")).alias("years"), F.count("emp_length").alias("n")
        ),
        "employment",
    )

    repaid, lent = repayments, loans
    if runs:
        owned = wanted_keys(now.filter("n = 1 AND loan_id IS NOT NULL").select("loan_id"), "loan_id")
        repaid = owned.keep(_with_old(repayments, old["repayments"]), "loan_id")
        repaid = write_shared(merged_repayments(repaid), "repayment-states")
        lent = owned.keep(_with_old(loans, old["loans"]), "loan_id")
        lent = write_shared(skew.merged(lent), "loan-states")

    judged = run.write(_judged(now, repaid, rows_per_task), "judged")
    single = _packed(judged.filter("NOT bad AND loan_id IS NOT NULL AND delinquent"))
    points = direct.points_of_loans(
        lent, repaid.filter("n = 1").drop("n"), card, skew.crowds(lent, "loan_id", rows_per_task)
    )
    run.write(
        _unpacked(
            skew.join_few(single, points, "loan_id", skew.crowds(single, "loan_id", rows_per_task), "inner")
        ).select("member_id", *_PARTS, skew.TIMES),
        "scores",
    )
    return run.publish({"scorecard": repr(card)})


def _latest(judged: DataFrame) -> DataFrame:
    """Per member (its key packed) the last run that touched it, and whether it is bad since."""
    marks = _packed(judged.select("member_id", "bad", "run"))
    return marks.groupBy("member_id").agg(F.max_by("bad", "run").alias("bad"), F.max("run").alias("last"))


def current_bad_members(spark: SparkSession, root: str) -> DataFrame | None:
    """The bad members of all batches; None if there was no batch."""
    judged = _every(spark, complete_runs(spark, root), "judged")
    return None if judged is None else _unpacked(_latest(judged).filter("bad").select("member_id"))


def current_scores(
    spark: SparkSession, root: str, card: Scorecard = Scorecard()
) -> DataFrame | None:
    """Score and grade of every scorable member of all batches; None if there was no batch.

    A member has few rows in each run, so nothing is crowded here but the copies that one row
    stands for, which are made by several tasks.
    """
    runs = complete_runs(spark, root)
    if any(run.notes.get("scorecard") != repr(card) for run in runs):
        raise OtherScorecard("the batches were scored by another scorecard")
    judged, scored = _every(spark, runs, "judged"), _every(spark, runs, "scores")
    if judged is None or scored is None:
        return None
    # No run of a member is behind its last one. As no equality, the condition leaves the member
    # as the only key of the join, by which the last runs are dealt already.
    last = _latest(judged).filter("NOT bad").select("member_id", "last")
    rows = _packed(scored).join(last, "member_id").filter("run >= last").drop("run", "last")
    return graded(_unpacked(skew.repeat_rows(rows).select("member_id", *_PARTS)), card)


def current_customers(
    spark: SparkSession, root: str, ingest_time: Column | None = None
) -> DataFrame | None:
    """The cleaned customers of all batches; None if there was no batch.

    The mean that fills employment years comes from the sums and counts of the batches.
    """
    runs = complete_runs(spark, root)
    rows, sums = _every(spark, runs, "customers"), _every(spark, runs, "employment")
    if rows is None or sums is None:
        return None
    mean = sums.agg(F.floor(F.sum("years") / F.sum("n")).alias("emp_length"))
    return tables.finished_customers(tables.numbered_employment(rows.drop("run")), mean, ingest_time)
