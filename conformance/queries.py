"""One Spark query per operator, over the applications of ``sources.star``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditgrade.functions import cleaning as clean
from creditgrade.functions import scores
from creditgrade.operators import duplicates, projections, skew
from creditgrade.operators.statistics import KeyStatistics, application_statistics
from creditgrade.plans import batch, direct, incremental, scoring, tables
from creditgrade.plans.verification import expanded
from creditgrade.schema import (
    CUSTOMER_FIELDS,
    DEFAULTER_FIELDS,
    LOAN_FIELDS,
    LOAN_PURPOSES,
    REPAYMENT_FIELDS,
)
from creditgrade.scorecard import Scorecard
from creditgrade.sources import readers, runs, sinks, star
from creditgrade.sources.sinks import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
CARD = Scorecard()
CARD_ALL = Scorecard(grade_weight_scope="all")


def ingest_time() -> Column:
    """A fixed time, so that results can be compared."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


# So few rows of a key per task that the test tables have many crowded keys.
FEW_ROWS = 4
# Applications with their keys that were written before: by session and tables.
_written: dict[tuple[str, str], tuple[DataFrame, KeyStatistics]] = {}
# Folders of batches, likewise.
_batches: dict[tuple[str, str], str] = {}
# Roots of states to which the applications were added in two parts, likewise.
_added: dict[tuple[str, str], str] = {}
# Curated tables in buckets, likewise.
_in_buckets: dict[tuple[str, str], batch.CuratedTables] = {}


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.with_member_id(star.applications(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, KeyStatistics]:
    """The applications with their keys and their statistics, once for all queries of a session.

    Otherwise each of the curated tables would derive them anew.
    """
    about = (spark.sparkContext.applicationId, sf_dir)
    if about not in _written:
        keyed = projections.keyed_applications(star.applications(spark, sf_dir))
        stored = sinks.write_shared(keyed, "applications")
        _written[about] = stored, application_statistics(stored)
    return _written[about]


def _curated(
    spark: SparkSession, sf_dir: str, rows_per_task: int = skew.ROWS_PER_TASK
) -> batch.CuratedTables:
    stored, statistics = _stored(spark, sf_dir)
    return batch.curate_keyed(stored, ingest_time(), rows_per_task, statistics)


# Sources, catalog, sinks


def src_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    sinks.write_csv(star.applications(spark, sf_dir), path)
    raw = readers.read_csv(spark, path)
    return raw.select(
        "id", "emp_title", "emp_length", "annual_inc", "term", "issue_d", "title",
        F.col("loan_amnt").try_cast("float").alias("loan_amnt"),
        F.col("total_pymnt").try_cast("float").alias("total_pymnt"),
        F.col("delinq_2yrs").try_cast("int").alias("delinq_2yrs"),
    )


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Applications as delimited text in which some lines lost or gained a field."""
    rows = star.applications(spark, sf_dir)
    path, output = shared_folder(spark), shared_folder(spark)
    whole = F.to_csv(F.struct(*rows.columns), {"quoteAll": "true"})
    line = (
        F.when(F.expr("bigint(id) % 50 = 7"), F.concat_ws(",", "id", "emp_title"))
        .when(F.expr("bigint(id) % 50 = 9"), F.concat(whole, F.lit(",more")))
        .otherwise(whole)
    )
    # One file to a part, as many as there are shuffle partitions, each with its header line.
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = rows.select(line.alias("value")).selectExpr(
        "value", f"pmod(xxhash64(value), {n_parts}) AS part", "1 AS place"
    )
    headers = spark.range(n_parts).select(
        F.lit(",".join(rows.columns)).alias("value"), F.col("id").alias("part"), F.lit(0).alias("place")
    )
    both = lines.union(headers).repartition(n_parts, "part").sortWithinPartitions("part", "place")
    both.drop("place").write.partitionBy("part").text(path)
    path = f"{path}/*"
    return readers.ingest_csv(spark, path, output)


def src_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines by their reason and the id that they begin with."""
    rejects = _ingested(spark, sf_dir)[1]
    found = rejects.selectExpr(
        "reason", "trim(BOTH '\"' FROM split(line, ',')[0]) AS id", "n_lines"
    )
    return found.groupBy("reason", "id").agg(F.sum("n_lines").alias("n_lines"))


def src_csv_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir)[0].select("id", "emp_title", "addr_state", "loan_status")


def src_parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    sinks.write_parquet(star.applications(spark, sf_dir), path)
    return readers.read_parquet(spark, path)


def src_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.row_count(star.applications(spark, sf_dir))


def cat_temp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    readers.register_view(_keyed(spark, sf_dir), "customers_raw")
    return spark.sql(
        "SELECT grade, count(*) AS n_loans, count(DISTINCT member_id) AS n_members "
        "FROM customers_raw GROUP BY grade"
    )


def sink_curated_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.write_parquet(table_loans(spark, sf_dir), shared_folder(spark))


def sink_score_by_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.write_parquet(
        loan_score(spark, sf_dir), shared_folder(spark), partition_by=["loan_final_grade"]
    )


def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = star.applications(spark, sf_dir)
    return batch.run_batch(raw, shared_folder(spark), CARD, ingest_time())


def _batch_folder(spark: SparkSession, sf_dir: str) -> str:
    """The output of one whole batch, run once for all queries of a session."""
    about = (spark.sparkContext.applicationId, sf_dir)
    if about not in _batches:
        folder = shared_folder(spark)
        raw = star.applications(spark, sf_dir)
        batch.run_batch(raw, folder, CARD, ingest_time(), with_verification=True)
        _batches[about] = folder
    return _batches[about]


def _batch_table(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(f"{_batch_folder(spark, sf_dir)}/{name}")

    query.__name__ = f"batch_{name}"
    return query


def batch_factorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the written factorised table stands for."""
    folder = _batch_folder(spark, sf_dir)
    return expanded(spark.read.parquet(f"{folder}/verification_factorised"))


def published_good_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the newest complete run, where a later one ended in the middle."""
    root = shared_folder(spark)
    raw = star.applications(spark, sf_dir)
    batch.publish_batch(raw, root, CARD, ingest_time(), with_factorised=False)
    runs.RunWriter(spark, root).write(raw.select("id"), "good_customers")
    return runs.newest_run(spark, root).table(spark, "good_customers")


def _states(spark: SparkSession, sf_dir: str) -> str:
    """All applications, added in two parts, whose keys overlap, once for all queries."""
    about = (spark.sparkContext.applicationId, sf_dir)
    if about not in _added:
        root = shared_folder(spark)
        # Both parts come from one reading of the tables.
        keyed = projections.keyed_applications(star.applications(spark, sf_dir))
        raw = sinks.write_shared(keyed, "applications")
        first = F.pmod(F.xxhash64("id", "loan_amnt"), F.lit(2)) == 0
        for part in (first, ~first):
            incremental.add_applications(raw.filter(part), root, CARD)
        _added[about] = root
    return _added[about]


def incremental_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.current_scores(spark, _states(spark, sf_dir), CARD)


def incremental_bad_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.current_bad_members(spark, _states(spark, sf_dir))


def incremental_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.current_customers(spark, _states(spark, sf_dir), ingest_time())


# Identity and projections


def id_member_hash_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of the same applications read as text, with inferred types, as Parquet.

    A row for each application and key, so one row only where all three agree.
    """
    raw = star.applications(spark, sf_dir)
    folder = shared_folder(spark)
    sinks.write_csv(raw, f"{folder}/csv")
    parquet = sinks.write_parquet(raw, f"{folder}/parquet")
    text = readers.read_csv(spark, f"{folder}/csv")
    inferred = readers.read_csv(spark, f"{folder}/csv", infer_schema=True)
    keys = [
        projections.with_member_id(df).selectExpr("string(id) AS id", "member_id")
        for df in (text, inferred, parquet)
    ]
    # Each application three times; equal ones are counted, not dropped.
    every = keys[0].union(keys[1]).union(keys[2]).groupBy("id", "member_id").count()
    return skew.repeat_rows(every.selectExpr("id", "member_id", "count DIV 3 AS _times"), spread=False)


def id_member_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir).select("id", "member_id")


def proj_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.customers(_keyed(spark, sf_dir))


def proj_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.loans(_keyed(spark, sf_dir))


def proj_repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.repayments(_keyed(spark, sf_dir))


def proj_defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.defaulters(_keyed(spark, sf_dir))


def _typed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.rename_and_cast(proj_customers(spark, sf_dir), CUSTOMER_FIELDS)


def _typed_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.rename_and_cast(proj_loans(spark, sf_dir), LOAN_FIELDS)


def _typed_repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.rename_and_cast(proj_repayments(spark, sf_dir), REPAYMENT_FIELDS)


def _typed_defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.rename_and_cast(proj_defaulters(spark, sf_dir), DEFAULTER_FIELDS)


def clean_rename_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_customers(spark, sf_dir)


def clean_ingest_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = tables.stamp_ingest(_typed_loans(spark, sf_dir), ingest_time())
    return stamped.select("loan_id", "member_id", tables.INGEST_COLUMN)


# Filters and null handling


def filter_income_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.with_income(_typed_customers(spark, sf_dir))


def filter_complete_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.complete_loans(_typed_loans(spark, sf_dir))


def filter_complete_repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.complete_repayments(_typed_repayments(spark, sf_dir))


def filter_nonzero_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.with_payment(clean_total_payment(spark, sf_dir))


def clean_fill_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("delinq_2yrs", *tables.RECORD_COLUMNS)
    return tables.fill_with_zero(
        _typed_defaulters(spark, sf_dir).select("member_id", *columns), columns
    )


def clean_fill_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _numbered_customers(spark, sf_dir).select("member_id", "emp_length")
    return tables.fill_with_floor_mean(rows, "emp_length")


def table_enquiry_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.enquiry_members(proj_defaulters(spark, sf_dir))


# Column cleaning


def clean_digits_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.applications(spark, sf_dir)
    return rows.select("id", clean.digits_to_int("emp_length").alias("emp_length"))


def clean_state_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.applications(spark, sf_dir)
    return rows.select("id", clean.state_code("addr_state").alias("address_state"))


def clean_loan_term_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.applications(spark, sf_dir)
    return rows.select("id", clean.term_years("term").alias("loan_term_years"))


def clean_total_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.with_reconciled_total(filter_complete_repayments(spark, sf_dir))


def clean_date_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.applications(spark, sf_dir)
    return rows.select(
        "id",
        clean.real_date("last_pymnt_d").alias("last_payment_date"),
        clean.real_date("next_pymnt_d").alias("next_payment_date"),
    )


def clean_purpose_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.applications(spark, sf_dir)
    purpose = clean.allowed_or_other("purpose", LOAN_PURPOSES)
    return rows.select("id", purpose.alias("loan_purpose"))


# Cleaned tables


def table_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.clean_customers(proj_customers(spark, sf_dir), ingest_time())


def table_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.clean_loans(proj_loans(spark, sf_dir), ingest_time())


def table_repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.clean_repayments(proj_repayments(spark, sf_dir), ingest_time())


def table_delinquency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.clean_delinquency(proj_defaulters(spark, sf_dir))


def table_records_enquiries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.clean_records(proj_defaulters(spark, sf_dir))


# Distinct, duplicates, joins


def distinct_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.distinct_customers(proj_customers(spark, sf_dir))


def _numbered_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.numbered_employment(tables.with_income(distinct_customers(spark, sf_dir)))


def agg_floor_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.floor_mean(_numbered_customers(spark, sf_dir), "emp_length")


def dup_keys_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = _curated(spark, sf_dir)
    return duplicates.duplicate_verification_members(*vars(curated).values())


def dup_keys_delinquency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_keys(table_delinquency(spark, sf_dir))


def dup_keys_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_keys(table_records_enquiries(spark, sf_dir))


def table_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curated(spark, sf_dir).verification()


def table_verification_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curated(spark, sf_dir, FEW_ROWS).verification()


def verification_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curated(spark, sf_dir).verification_counted()


def verification_counted_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curated(spark, sf_dir, FEW_ROWS).verification_counted()


def verification_factorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the factorised table stands for."""
    return expanded(_curated(spark, sf_dir).verification_factorised())


def _bucketed(spark: SparkSession, sf_dir: str) -> batch.CuratedTables:
    """The curated tables stored in buckets, once for all queries of a session."""
    about = (spark.sparkContext.applicationId, sf_dir)
    if about not in _in_buckets:
        prefix = f"curated_{len(_in_buckets)}"
        curated = _curated(spark, sf_dir)
        _in_buckets[about] = batch.store_bucketed(curated, shared_folder(spark), prefix, 16)
    return _in_buckets[about]


def bucketed_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucketed(spark, sf_dir).verification()


def bucketed_bad_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucketed(spark, sf_dir).bad_members()


def bucketed_dup_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_keys(_bucketed(spark, sf_dir).records)


def bucketed_good_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = _bucketed(spark, sf_dir)
    return duplicates.good_customers(
        curated.customers, curated.bad_members(), statistics=curated.statistics
    )


def table_bad_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct.bad_members(star.applications(spark, sf_dir))


def bad_members_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curated(spark, sf_dir).bad_members()


def bad_members_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curated(spark, sf_dir, FEW_ROWS).bad_members()


def table_bad_members_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct.bad_members(star.applications(spark, sf_dir), FEW_ROWS)


def bad_members_of_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = _curated(spark, sf_dir)
    return duplicates.bad_members(curated.loans, curated.delinquency, curated.records)


def table_good_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct.good_customers(star.applications(spark, sf_dir), ingest_time())


def good_customers_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = _curated(spark, sf_dir)
    return duplicates.good_customers(
        curated.customers, curated.bad_members(), statistics=curated.statistics
    )


def join_repayment_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = _curated(spark, sf_dir)
    return scoring.repayments_with_loans(
        curated.repayments, curated.loans, statistics=curated.statistics
    )


def repayment_points_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = _curated(spark, sf_dir)
    return scoring.repayment_points_counted(
        curated.repayments, curated.loans, CARD, statistics=curated.statistics
    )


def _repayment_member(curated: batch.CuratedTables) -> DataFrame:
    points = scoring.repayment_points_counted(
        curated.repayments, curated.loans, CARD, curated.rows_per_task, curated.statistics
    )
    return scoring.repayment_points_by_member(
        points, curated.loans, curated.rows_per_task, curated.statistics
    )


def join_repayment_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repayment_member(_curated(spark, sf_dir))


def join_repayment_member_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repayment_member(_curated(spark, sf_dir, FEW_ROWS))


def join_repayment_member_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = _curated(spark, sf_dir)
    return scoring.unique_loan_points_by_member(curated.repayments, curated.loans, CARD)


def _score_base(curated: batch.CuratedTables) -> DataFrame:
    bad = sinks.write_shared(curated.bad_members(), "bad-members")
    return scoring.score_base(
        curated.customers, curated.loans, curated.repayments, bad, curated.delinquency,
        curated.records, CARD, curated.rows_per_task, curated.statistics,
    )


def score_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_base(_curated(spark, sf_dir))


def score_base_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_base(_curated(spark, sf_dir, FEW_ROWS))


# Scorecard


def score_last_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = join_repayment_loan(spark, sf_dir)
    return pairs.select(
        "loan_id",
        scores.last_payment_points(
            "last_payment_amount", "monthly_installment", CARD
        ).alias("last_payment_pts"),
    )


def score_total_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = join_repayment_loan(spark, sf_dir)
    return pairs.select(
        "loan_id",
        scores.total_payment_points(
            "total_payment_received", "funded_amount", CARD
        ).alias("total_payment_pts"),
    )


def score_payment_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = join_repayment_member(spark, sf_dir)
    return points.select(
        "member_id",
        scores.payment_history(
            "last_payment_pts", "total_payment_pts", CARD
        ).alias("payment_history_pts"),
    )


def score_default_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("delinq_2yrs", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")
    return clean_fill_zero(spark, sf_dir).select(
        "member_id", scores.defaulters_history(*counts, CARD).alias("defaulters_history_pts")
    )


def score_loan_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_loans(spark, sf_dir).select(
        "loan_id", scores.loan_status_points("loan_status", CARD).alias("loan_status_pts")
    )


def score_home_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_customers(spark, sf_dir).select(
        "member_id",
        scores.home_ownership_points("home_ownership", CARD).alias("home_ownership_pts"),
    )


def _health_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.applications(spark, sf_dir).select(
        "id",
        "loan_status",
        "home_ownership",
        F.col("funded_amnt").try_cast("float").alias("funded_amount"),
        F.col("tot_hi_cred_lim").try_cast("float").alias("total_high_credit_limit"),
        "grade",
    )


def score_credit_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _health_inputs(spark, sf_dir).select(
        "id",
        scores.credit_use_points(
            "funded_amount", "total_high_credit_limit", CARD
        ).alias("credit_use_pts"),
    )


def score_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_customers(spark, sf_dir).select(
        "member_id", scores.grade_points("grade", CARD).alias("grade_pts")
    )


def _financial_health(spark: SparkSession, sf_dir: str, card: Scorecard) -> DataFrame:
    health = scores.financial_health(
        "loan_status", "home_ownership", "funded_amount", "total_high_credit_limit", "grade", card
    )
    return _health_inputs(spark, sf_dir).select("id", health.alias("financial_health_pts"))


def score_financial_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _financial_health(spark, sf_dir, CARD)


def score_financial_health_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _financial_health(spark, sf_dir, CARD_ALL)


def score_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_score(spark, sf_dir).select("member_id", "loan_score")


def score_grade_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_score(spark, sf_dir).select("member_id", "loan_final_grade")


def loan_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct.score_applications(star.applications(spark, sf_dir), CARD)


def loan_score_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct.score_applications(star.applications(spark, sf_dir), CARD, FEW_ROWS)


def loan_score_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct.score_applications(star.applications(spark, sf_dir), CARD_ALL)


def loan_score_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.graded(scoring.score_parts(score_base(spark, sf_dir), CARD), CARD)


def score_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 scores; ordered, so that they are always the same ones."""
    rows = loan_score(spark, sf_dir)
    return rows.orderBy("member_id", "payment_history_pts").limit(20)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        src_csv_scan,
        src_csv_rejects,
        src_csv_ingested,
        src_parquet_scan,
        src_row_count,
        cat_temp_view,
        sink_curated_roundtrip,
        sink_score_by_grade,
        batch_run,
        _batch_table("customers"),
        _batch_table("loans"),
        _batch_table("bad_members"),
        _batch_table("good_customers"),
        _batch_table("repayments"),
        _batch_table("delinquency"),
        _batch_table("records"),
        _batch_table("verification"),
        _batch_table("audit"),
        batch_factorised,
        published_good_customers,
        incremental_scores,
        incremental_bad_members,
        incremental_customers,
        id_member_hash,
        id_member_hash_csv,
        proj_customers,
        proj_loans,
        proj_repayments,
        proj_defaulters,
        clean_rename_cast,
        clean_ingest_stamp,
        filter_income_present,
        filter_complete_loans,
        filter_complete_repayments,
        filter_nonzero_payment,
        clean_fill_zero,
        clean_fill_mean,
        clean_digits_to_int,
        clean_state_code,
        clean_loan_term_years,
        clean_total_payment,
        clean_date_sentinel,
        clean_purpose_allowlist,
        table_customers,
        table_loans,
        table_repayments,
        table_delinquency,
        table_records_enquiries,
        table_enquiry_members,
        distinct_customers,
        agg_floor_mean,
        dup_keys_verification,
        dup_keys_delinquency,
        dup_keys_records,
        table_verification,
        table_verification_spread,
        verification_counted,
        verification_counted_spread,
        verification_factorised,
        bucketed_verification,
        bucketed_bad_members,
        bucketed_dup_records,
        bucketed_good_customers,
        table_bad_members,
        table_bad_members_spread,
        bad_members_from_tables,
        bad_members_spread,
        bad_members_of_three,
        table_good_customers,
        good_customers_from_tables,
        join_repayment_loan,
        repayment_points_counted,
        join_repayment_member,
        join_repayment_member_spread,
        join_repayment_member_folded,
        score_base,
        score_base_spread,
        score_last_payment,
        score_total_payment,
        score_payment_history,
        score_default_history,
        score_loan_status,
        score_home_ownership,
        score_credit_use,
        score_grade,
        score_financial_health,
        score_financial_health_all,
        score_total,
        score_grade_band,
        loan_score,
        loan_score_spread,
        loan_score_all,
        loan_score_from_tables,
        score_preview,
    )
}
