"""The whole batch: raw applications to curated tables and scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditgrade.operators import duplicates, projections, skew
from creditgrade.plans import direct, tables
from creditgrade.operators.statistics import KeyStatistics, application_statistics
from creditgrade.plans.audit import Audit
from creditgrade.plans.verification import (
    verification,
    verification_counted,
    verification_factorised,
)
from creditgrade.scorecard import Scorecard
from creditgrade.sources.bucketed import BUCKETS, open_bucketed, write_bucketed
from creditgrade.sources.runs import Run, RunWriter
from creditgrade.sources.sinks import write_parquet, write_shared


@dataclass(frozen=True)
class CuratedTables:
    """The five tables; their joins make about ``rows_per_task`` rows of a key in one task.

    ``statistics`` of the rows that the tables come from spare the joins counting their keys.
    """

    customers: DataFrame
    loans: DataFrame
    repayments: DataFrame
    delinquency: DataFrame
    records: DataFrame
    rows_per_task: int = skew.ROWS_PER_TASK
    statistics: KeyStatistics | None = None

    def tables(self) -> dict[str, DataFrame]:
        others = ("rows_per_task", "statistics")
        return {name: value for name, value in vars(self).items() if name not in others}

    def bad_members(self) -> DataFrame:
        return duplicates.bad_members_from_tables(*vars(self).values())

    def verification(self) -> DataFrame:
        return verification(*vars(self).values())

    def verification_counted(self, factorised: DataFrame | None = None) -> DataFrame:
        """Counted rows; ``factorised`` is the stored factorised form of these tables, if there."""
        return verification_counted(*vars(self).values(), factorised=factorised)

    def verification_factorised(self) -> DataFrame:
        return verification_factorised(*vars(self).values())


def curate(raw: DataFrame, ingest_time: Column | None = None) -> CuratedTables:
    """The five cleaned tables of a raw application table."""
    return curate_keyed(projections.with_member_id(raw), ingest_time)


def curate_keyed(
    keyed: DataFrame,
    ingest_time: Column | None = None,
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
    audit: Audit | None = None,
    different: DataFrame | None = None,
) -> CuratedTables:
    """The five cleaned tables of raw applications that have their member key.

    With an ``audit``, the rows that each filter leaves are counted when a table is written.
    ``different`` are the ``tables.distinct_customers``, where they are stored (and seen) already.
    """

    def seen(name: str) -> tables.Seen | None:
        return partial(audit.seen, table=name) if audit else None

    defaulters = projections.defaulters(keyed)
    if different is None:
        customers = tables.clean_customers(projections.customers(keyed), ingest_time, seen("customers"))
    else:
        customers = tables.clean_different(different, ingest_time)
    return CuratedTables(
        customers=customers,
        loans=tables.clean_loans(projections.loans(keyed), ingest_time, seen("loans")),
        repayments=tables.clean_repayments(
            projections.repayments(keyed), ingest_time, seen("repayments")
        ),
        delinquency=tables.clean_delinquency(defaulters, seen("delinquency")),
        records=tables.clean_records(defaulters, seen("records")),
        rows_per_task=rows_per_task,
        statistics=statistics,
    )


# The key of each table's buckets: joins by member need no shuffle, nor do those by loan.
_BUCKET_KEYS = {
    "customers": "member_id",
    "loans": "member_id",
    "repayments": "loan_id",
    "delinquency": "member_id",
    "records": "member_id",
}


def store_bucketed(
    curated: CuratedTables, output_dir: str, prefix: str = "curated", n_buckets: int = BUCKETS
) -> CuratedTables:
    """Write the curated tables in buckets of their keys, and return them as stored.

    Below ``output_dir`` there is a folder per table; in the catalog they are called by the
    prefix and the table's name. Joins of the stored tables by member, and groupings by it,
    run without a shuffle; crowded keys are still dealt over several tasks.
    """
    stored = {
        name: write_bucketed(
            df, f"{output_dir}/{name}", f"{prefix}_{name}", _BUCKET_KEYS[name], n_buckets,
            curated.statistics, curated.rows_per_task,
        )
        for name, df in curated.tables().items()
    }
    return replace(curated, **stored)


def open_stored(
    spark: SparkSession,
    output_dir: str,
    prefix: str = "curated",
    rows_per_task: int = skew.ROWS_PER_TASK,
    statistics: KeyStatistics | None = None,
) -> CuratedTables:
    """The tables that another session stored in buckets."""
    tables_ = {name: open_bucketed(spark, f"{output_dir}/{name}", f"{prefix}_{name}") for name in _BUCKET_KEYS}
    return CuratedTables(**tables_, rows_per_task=rows_per_task, statistics=statistics)


def run_batch(
    raw: DataFrame,
    output_dir: str,
    card: Scorecard = Scorecard(),
    ingest_time: Column | None = None,
    mode: str = "errorifexists",
    with_verification: bool = False,
    with_factorised: bool = True,
    rows_per_task: int = skew.ROWS_PER_TASK,
) -> DataFrame:
    """Write the curated tables, bad members, good customers and scores as Parquet.

    The input is read once: its used columns are written with the member key, and all
    tables come from there, so a lost executor costs no more than its own tasks. All rows
    carry one ingest time. ``output_dir`` is a shared folder. The verification table is
    written as its factors, which are linear in the input, and on request with its equal rows
    as one and their number in ``_times``. The table ``audit`` has the rows that each filter
    left. Returns the scores.
    """

    def write(df: DataFrame, name: str) -> DataFrame:
        return write_parquet(df, f"{output_dir}/{name}", mode)

    written = _run(
        raw, write, card, ingest_time, with_verification, with_factorised, rows_per_task
    )
    return written["loan_score"]


def publish_batch(
    raw: DataFrame,
    root: str,
    card: Scorecard = Scorecard(),
    ingest_time: Column | None = None,
    with_verification: bool = False,
    with_factorised: bool = True,
    rows_per_task: int = skew.ROWS_PER_TASK,
) -> Run:
    """``run_batch`` into a new folder below ``root`` that readers find once it is whole.

    The run's manifest is written last (``sources.runs``), so a batch that ends in the middle
    leaves the tables of the run before it in place. ``newest_run`` finds the tables.
    """
    run = RunWriter(raw.sparkSession, root)
    _run(
        raw, run.write, card, ingest_time, with_verification, with_factorised, rows_per_task
    )
    return run.publish({"scorecard": repr(card)})


def _run(
    raw: DataFrame,
    write: Callable[[DataFrame, str], DataFrame],
    card: Scorecard,
    ingest_time: Column | None,
    with_verification: bool,
    with_factorised: bool,
    rows_per_task: int,
) -> dict[str, DataFrame]:
    """Write all tables of a batch; returns them as written."""

    if ingest_time is None:
        now = raw.sparkSession.range(1).select(F.current_timestamp().alias("now"))
        ingest_time = F.lit(now.first()["now"])
    keyed = write(projections.keyed_applications(raw), "applications")
    statistics = application_statistics(keyed)
    audit = Audit()
    # Copies are taken out once for the customers and for the mean that two tables are filled with.
    different = write_shared(
        audit.seen(tables.distinct_customers(projections.customers(keyed)), "customers"),
        "different-customers",
    )
    mean = tables.mean_employment(different)
    curated = curate_keyed(keyed, ingest_time, rows_per_task, audit=audit, different=different)
    written = {name: write(df, name) for name, df in curated.tables().items()}
    write(audit.counts(raw.sparkSession), "audit")
    write(direct.bad_members(keyed, rows_per_task), "bad_members")
    write(direct.good_customers(keyed, ingest_time, rows_per_task, mean), "good_customers")
    found = CuratedTables(**written, rows_per_task=rows_per_task, statistics=statistics)
    factorised = None
    if with_factorised:
        factorised = write(found.verification_factorised(), "verification_factorised")
    if with_verification:
        write(found.verification_counted(factorised), "verification")
    written["loan_score"] = write(
        direct.score_applications(keyed, card, rows_per_task), "loan_score"
    )
    return written
