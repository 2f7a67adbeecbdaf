"""The SQL (DuckDB) that each query must equal, written step by step.

The steps follow the definition of the results, not the Spark plans: the
verification table is built and counted, and the score is joined from tables.
"""

from __future__ import annotations

# The purposes that are kept.
PURPOSES = """'debt_consolidation', 'credit_card', 'home_improvement', 'other', 'major_purchase',
    'medical', 'small_business', 'car', 'vacation', 'moving', 'house', 'wedding',
    'renewable_energy', 'educational'"""

STEPS = r"""
WITH line_facts AS (
  SELECT l_orderkey,
         count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
         count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines,
         max(l_extendedprice) AS highest,
         min(l_extendedprice) AS lowest
  FROM lineitem GROUP BY l_orderkey
),
order_rows AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_orderstatus, o_orderpriority,
         o_totalprice, o_orderdate, c_name, c_nationkey, c_acctbal,
         CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal)::BIGINT END AS income,
         CASE o_custkey % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified'
              ELSE 'Not Verified' END AS verified,
         chr((65 + o_custkey % 7)::INT) AS letter,
         floor(o_totalprice / 36)::BIGINT AS monthly,
         coalesce(returned, 0) AS returned,
         coalesce(open_lines, 0) AS open_lines,
         highest, lowest
  FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN line_facts ON o_orderkey = l_orderkey
),
once AS (
  SELECT k,
    (CASE WHEN k % 211 = 0 AND k > 0 THEN k - 1 ELSE k END)::VARCHAR AS id,
    c_name AS emp_title,
    CASE o_orderpriority WHEN '1-URGENT' THEN '< 1 year' WHEN '2-HIGH' THEN '2 years'
         WHEN '3-MEDIUM' THEN '3 years' WHEN '4-NOT SPECIFIED' THEN 'n/a'
         ELSE '10+ years' END AS emp_length,
    CASE o_orderstatus WHEN 'P' THEN 'MORTGAGE' WHEN 'F' THEN 'RENT'
         ELSE 'OWN' END AS home_ownership,
    income AS annual_inc,
    c_nationkey::VARCHAR AS zip_code,
    'N' || c_nationkey::VARCHAR AS addr_state,
    letter AS grade,
    letter || (1 + ck % 5)::VARCHAR AS sub_grade,
    verified AS verification_status,
    CASE WHEN ck % 50 <> 0 THEN abs(c_acctbal) * 100 END AS tot_hi_cred_lim,
    CASE WHEN ck % 20 = 0 THEN 'Joint App' ELSE 'Individual' END AS application_type,
    CASE WHEN ck % 20 = 0 THEN income * 2 END AS annual_inc_joint,
    CASE WHEN ck % 20 = 0 THEN verified END AS verification_status_joint,
    o_totalprice AS loan_amnt,
    o_totalprice AS funded_amnt,
    CASE WHEN k % 3 < 2 THEN ' 36 months' ELSE ' 60 months' END AS term,
    5 + k % 20 AS int_rate,
    monthly AS installment,
    CASE WHEN k % 97 <> 0 THEN strftime(o_orderdate, '%b-%Y') END AS issue_d,
    CASE k % 6 WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Current' WHEN 2 THEN 'In Grace Period'
         WHEN 3 THEN 'Late (16-30 days)' WHEN 4 THEN 'Charged Off'
         ELSE 'Default' END AS loan_status,
    CASE k % 4 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'car'
         ELSE CASE WHEN k % 16 = 15 THEN 'Car' ELSE 'boat' END END AS purpose,
    CASE WHEN k % 5 <> 0 THEN 'loan ' || (k % 17)::VARCHAR END AS title,
    CASE WHEN k % 25 = 0 THEN 0::DOUBLE ELSE highest END AS total_rec_prncp,
    lowest AS total_rec_int,
    returned AS total_rec_late_fee,
    CASE WHEN k % 10 = 0 THEN 0::DOUBLE ELSE highest + lowest + returned END AS total_pymnt,
    monthly * 0.25::DOUBLE * (k % 8) AS last_pymnt_amnt,
    CASE WHEN k % 7 = 0 THEN '0.0' ELSE 'Jan-2002' END AS last_pymnt_d,
    CASE WHEN k % 11 = 0 THEN '0.0' ELSE 'Feb-2002' END AS next_pymnt_d,
    CASE WHEN returned <> 0 THEN returned END AS delinq_2yrs,
    100 * returned AS delinq_amnt,
    CASE WHEN returned <> 0 OR k % 2 = 0 THEN k % 24 END AS mths_since_last_delinq,
    CASE WHEN k % 9 <> 0 THEN open_lines END AS pub_rec,
    k % 2 AS pub_rec_bankruptcies,
    CASE WHEN k % 13 <> 0 THEN k % 5 END AS inq_last_6mths,
    CASE WHEN k % 3 <> 0 THEN (k % 30)::DOUBLE END AS mths_since_last_record
  FROM order_rows
),
raw AS (
  SELECT * EXCLUDE (k) FROM once
  UNION ALL
  SELECT * EXCLUDE (k) FROM once WHERE k % 200 = 0
),
keyed AS (
  SELECT *, sha256(concat_ws('||', emp_title, emp_length, home_ownership,
    annual_inc::DOUBLE::VARCHAR, zip_code, addr_state, grade, sub_grade, verification_status)) AS member_id
  FROM raw
),
typed_customers AS (
  SELECT member_id, emp_title, emp_length, home_ownership,
         annual_inc::REAL AS annual_income, addr_state AS address_state,
         zip_code AS address_zipcode, 'USA' AS address_country, grade, sub_grade,
         verification_status, tot_hi_cred_lim::REAL AS total_high_credit_limit,
         application_type, annual_inc_joint::REAL AS joint_annual_income,
         verification_status_joint
  FROM keyed
),
distinct_customers AS (SELECT DISTINCT * FROM typed_customers),
numbered_customers AS (
  SELECT * REPLACE (try_cast(regexp_replace(emp_length, '\D', '', 'g') AS INT) AS emp_length)
  FROM distinct_customers WHERE annual_income IS NOT NULL
),
mean_employment AS (SELECT floor(avg(emp_length))::INT AS years FROM numbered_customers),
customers AS (
  SELECT * REPLACE (
           coalesce(emp_length, (SELECT years FROM mean_employment)) AS emp_length,
           CASE WHEN length(address_state) > 2 THEN 'NA' ELSE address_state END AS address_state),
         TIMESTAMP '2024-01-01 00:00:00' AS ingest_date
  FROM numbered_customers
),
typed_loans AS (
  SELECT id AS loan_id, member_id, loan_amnt::REAL AS loan_amount,
         funded_amnt::REAL AS funded_amount, term AS loan_term_months,
         int_rate::REAL AS interest_rate, installment::REAL AS monthly_installment,
         issue_d AS issue_date, loan_status, purpose AS loan_purpose, title AS loan_title
  FROM keyed
),
complete_loans AS (
  SELECT * FROM typed_loans
  WHERE loan_amount IS NOT NULL AND funded_amount IS NOT NULL AND loan_term_months IS NOT NULL
    AND interest_rate IS NOT NULL AND monthly_installment IS NOT NULL
    AND issue_date IS NOT NULL AND loan_status IS NOT NULL AND loan_purpose IS NOT NULL
),
loans AS (
  SELECT loan_id, member_id, loan_amount, funded_amount, interest_rate, monthly_installment,
         issue_date, loan_status,
         CASE WHEN loan_purpose IN ({purposes})
              THEN loan_purpose ELSE 'other' END AS loan_purpose,
         loan_title,
         TIMESTAMP '2024-01-01 00:00:00' AS ingest_date,
         trunc(try_cast(replace(loan_term_months, ' months', '') AS INT) / 12)::INT
           AS loan_term_years
  FROM complete_loans
),
typed_repayments AS (
  SELECT id AS loan_id, total_rec_prncp::REAL AS total_principal_received,
         total_rec_int::REAL AS total_interest_received,
         total_rec_late_fee::REAL AS total_late_fee_received,
         total_pymnt::REAL AS total_payment_received,
         last_pymnt_amnt::REAL AS last_payment_amount,
         last_pymnt_d AS last_payment_date, next_pymnt_d AS next_payment_date
  FROM keyed
),
complete_repayments AS (
  SELECT * FROM typed_repayments
  WHERE total_principal_received IS NOT NULL AND total_interest_received IS NOT NULL
    AND total_late_fee_received IS NOT NULL AND total_payment_received IS NOT NULL
    AND last_payment_amount IS NOT NULL
),
reconciled_repayments AS (
  SELECT * REPLACE (
    CASE WHEN total_principal_received <> 0 AND total_payment_received = 0
         THEN total_principal_received + total_interest_received + total_late_fee_received
         ELSE total_payment_received END AS total_payment_received)
  FROM complete_repayments
),
paid_repayments AS (SELECT * FROM reconciled_repayments WHERE total_payment_received <> 0),
repayments AS (
  SELECT * REPLACE (nullif(last_payment_date, '0.0') AS last_payment_date,
                    nullif(next_payment_date, '0.0') AS next_payment_date),
         TIMESTAMP '2024-01-01 00:00:00' AS ingest_date
  FROM paid_repayments
),
typed_defaulters AS (
  SELECT member_id, delinq_2yrs::REAL AS delinq_2yrs, delinq_amnt::REAL AS delinq_amnt,
         pub_rec::REAL AS pub_rec, pub_rec_bankruptcies::REAL AS pub_rec_bankruptcies,
         inq_last_6mths::REAL AS inq_last_6mths,
         mths_since_last_delinq::REAL AS mths_since_last_delinq
  FROM keyed
),
filled_defaulters AS (
  SELECT member_id, coalesce(trunc(delinq_2yrs)::INT, 0) AS delinq_2yrs,
         coalesce(trunc(pub_rec)::INT, 0) AS pub_rec,
         coalesce(trunc(pub_rec_bankruptcies)::INT, 0) AS pub_rec_bankruptcies,
         coalesce(trunc(inq_last_6mths)::INT, 0) AS inq_last_6mths,
         delinq_amnt, trunc(mths_since_last_delinq)::INT AS mths_since_last_delinq
  FROM typed_defaulters
),
delinquency AS (
  SELECT member_id, delinq_2yrs, delinq_amnt, mths_since_last_delinq
  FROM filled_defaulters WHERE delinq_2yrs > 0 OR mths_since_last_delinq > 0
),
records AS (
  SELECT member_id, pub_rec, pub_rec_bankruptcies, inq_last_6mths FROM filled_defaulters
),
verification AS (
  SELECT l.loan_id, c.member_id, c.emp_title, c.emp_length, c.home_ownership, c.annual_income,
         c.address_state, c.address_zipcode, c.address_country, c.grade, c.sub_grade,
         c.verification_status, c.total_high_credit_limit, c.application_type,
         c.joint_annual_income, c.verification_status_joint, l.loan_amount, l.funded_amount,
         l.loan_term_years, l.interest_rate, l.monthly_installment, l.issue_date, l.loan_status,
         l.loan_purpose, r.total_principal_received, r.total_interest_received,
         r.total_late_fee_received, r.last_payment_date, r.next_payment_date, d.delinq_2yrs,
         d.delinq_amnt, d.mths_since_last_delinq, e.pub_rec, e.pub_rec_bankruptcies,
         e.inq_last_6mths
  FROM customers c
  LEFT JOIN loans l ON c.member_id = l.member_id
  LEFT JOIN repayments r ON l.loan_id = r.loan_id
  LEFT JOIN delinquency d ON c.member_id = d.member_id
  LEFT JOIN records e ON c.member_id = e.member_id
),
dup_verification AS (
  SELECT member_id FROM verification GROUP BY member_id HAVING count(*) > 1
),
dup_loans AS (
  SELECT member_id FROM loans GROUP BY member_id HAVING count(*) > 1
),
dup_delinquency AS (
  SELECT member_id FROM delinquency GROUP BY member_id HAVING count(*) > 1
),
dup_records AS (
  SELECT member_id FROM records GROUP BY member_id HAVING count(*) > 1
),
bad AS (
  SELECT member_id FROM dup_verification
  UNION SELECT member_id FROM dup_delinquency
  UNION SELECT member_id FROM dup_records
),
good AS (SELECT * FROM customers WHERE member_id NOT IN (SELECT member_id FROM bad)),
payment_pairs AS (
  SELECT r.loan_id, l.member_id, r.last_payment_amount, r.total_payment_received,
         l.monthly_installment, l.funded_amount
  FROM repayments r JOIN loans l ON r.loan_id = l.loan_id
),
payment_points AS (
  SELECT loan_id, member_id,
    CASE WHEN last_payment_amount::DOUBLE < monthly_installment::DOUBLE * 0.5::DOUBLE THEN 100
         WHEN last_payment_amount::DOUBLE >= monthly_installment::DOUBLE * 0.5::DOUBLE
          AND last_payment_amount < monthly_installment THEN 100
         WHEN last_payment_amount = monthly_installment THEN 500
         WHEN last_payment_amount > monthly_installment
          AND last_payment_amount::DOUBLE <= monthly_installment::DOUBLE * 1.5::DOUBLE THEN 650
         WHEN last_payment_amount::DOUBLE > monthly_installment::DOUBLE * 1.5::DOUBLE THEN 800
         ELSE 0 END AS last_payment_pts,
    CASE WHEN total_payment_received::DOUBLE >= funded_amount::DOUBLE * 0.5::DOUBLE THEN 650
         WHEN total_payment_received::DOUBLE < funded_amount::DOUBLE * 0.5::DOUBLE
          AND total_payment_received > 0 THEN 500
         ELSE 0 END AS total_payment_pts
  FROM payment_pairs
),
folded_points AS (SELECT member_id, last_payment_pts, total_payment_pts FROM payment_points),
member_points AS (
  SELECT l.member_id, p.last_payment_pts, p.total_payment_pts
  FROM payment_points p JOIN loans l ON p.loan_id = l.loan_id
),
base AS (
  SELECT e.member_id, p.last_payment_pts, p.total_payment_pts,
         d.delinq_2yrs AS delinq_pts, e.pub_rec AS public_records_pts,
         e.pub_rec_bankruptcies AS public_bankruptcies_pts, e.inq_last_6mths AS enq_pts,
         l.loan_status, c.home_ownership, c.total_high_credit_limit, l.funded_amount,
         c.grade, c.sub_grade
  FROM records e
  JOIN delinquency d ON e.member_id = d.member_id
  JOIN member_points p ON e.member_id = p.member_id
  JOIN loans l ON e.member_id = l.member_id
  JOIN good c ON e.member_id = c.member_id
  WHERE e.member_id NOT IN (SELECT member_id FROM bad)
)
"""

LOAN_STATUS_POINTS = """
  CASE WHEN lower(loan_status) LIKE '%fully paid%' THEN 800
       WHEN lower(loan_status) LIKE '%current%' THEN 500
       WHEN lower(loan_status) LIKE '%in grace period%' THEN 250
       WHEN lower(loan_status) LIKE '%late%' THEN 100
       ELSE 0 END"""
HOME_OWNERSHIP_POINTS = """
  CASE WHEN lower(home_ownership) LIKE '%own' THEN 800
       WHEN lower(home_ownership) LIKE '%rent' THEN 500
       WHEN lower(home_ownership) LIKE '%mortgage' THEN 250
       ELSE 100 END"""
CREDIT_USE_POINTS = """
  CASE WHEN funded_amount::DOUBLE <= total_high_credit_limit::DOUBLE * 0.10::DOUBLE THEN 800
       WHEN funded_amount::DOUBLE <= total_high_credit_limit::DOUBLE * 0.20::DOUBLE THEN 650
       WHEN funded_amount::DOUBLE <= total_high_credit_limit::DOUBLE * 0.30::DOUBLE THEN 500
       WHEN funded_amount::DOUBLE <= total_high_credit_limit::DOUBLE * 0.50::DOUBLE THEN 250
       WHEN funded_amount::DOUBLE <= total_high_credit_limit::DOUBLE * 0.70::DOUBLE THEN 100
       ELSE 0 END"""
GRADE_POINTS = """
  CASE grade WHEN 'A' THEN 800 WHEN 'B' THEN 650 WHEN 'C' THEN 500 WHEN 'D' THEN 250
       WHEN 'E' THEN 100 ELSE 0 END"""
HEALTH = f"""
  ({LOAN_STATUS_POINTS} + {HOME_OWNERSHIP_POINTS} + {CREDIT_USE_POINTS})
  + {GRADE_POINTS} * 0.35::DOUBLE"""
HEALTH_ALL = f"""
  ({LOAN_STATUS_POINTS} + {HOME_OWNERSHIP_POINTS} + {CREDIT_USE_POINTS} + {GRADE_POINTS})
  * 0.35::DOUBLE"""
DEFAULTS = "(delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts) * 0.45::DOUBLE"
HEALTH_INPUTS = """
  (SELECT id, loan_status, home_ownership, funded_amnt::REAL AS funded_amount,
          tot_hi_cred_lim::REAL AS total_high_credit_limit, grade FROM keyed)"""


def _scores(health: str) -> str:
    return f"""
  (SELECT *, CASE WHEN loan_score > 2500 THEN 'A'
                  WHEN loan_score <= 2500 AND loan_score > 2000 THEN 'B'
                  WHEN loan_score <= 2000 AND loan_score > 1500 THEN 'C'
                  WHEN loan_score <= 1500 AND loan_score > 1000 THEN 'D'
                  WHEN loan_score <= 1000 AND loan_score > 750 THEN 'E'
                  WHEN loan_score <= 750 THEN 'F' END AS loan_final_grade
   FROM (SELECT *, payment_history_pts + defaulters_history_pts + financial_health_pts
                   AS loan_score
         FROM (SELECT member_id,
                      (last_payment_pts + total_payment_pts) * 0.20::DOUBLE
                        AS payment_history_pts,
                      {DEFAULTS} AS defaulters_history_pts,
                      {health} AS financial_health_pts
               FROM base)))"""


SCORES = _scores(HEALTH)

RESULTS = {
    "src_csv_scan": """id, emp_title, emp_length, annual_inc::DOUBLE AS annual_inc, term, issue_d,
        title, loan_amnt::REAL AS loan_amnt, total_pymnt::REAL AS total_pymnt,
        delinq_2yrs::INT AS delinq_2yrs FROM raw""",
    "src_csv_rejects": """CASE id::BIGINT % 50 WHEN 7 THEN 'too few fields' ELSE 'too many fields' END
        AS reason, id, count(*) AS n_lines FROM raw WHERE id::BIGINT % 50 IN (7, 9)
        GROUP BY ALL""",
    "src_csv_ingested": """id, emp_title, addr_state, loan_status FROM raw
        WHERE id::BIGINT % 50 NOT IN (7, 9)""",
    "src_parquet_scan": "* FROM raw",
    "src_row_count": "count(*) AS n_rows FROM raw",
    "cat_temp_view": """grade, count(*) AS n_loans, count(DISTINCT member_id) AS n_members
        FROM keyed GROUP BY grade""",
    "sink_curated_roundtrip": "* FROM loans",
    "sink_score_by_grade": f"* FROM {SCORES}",
    "batch_run": f"* FROM {SCORES}",
    "id_member_hash": "id, member_id FROM keyed",
    "proj_customers": """member_id, emp_title, emp_length, home_ownership, annual_inc, addr_state,
        zip_code, 'USA' AS country, grade, sub_grade, verification_status, tot_hi_cred_lim,
        application_type, annual_inc_joint, verification_status_joint FROM keyed""",
    "proj_loans": """id AS loan_id, member_id, loan_amnt, funded_amnt, term, int_rate, installment,
        issue_d, loan_status, purpose, title FROM keyed""",
    "proj_repayments": """id AS loan_id, total_rec_prncp, total_rec_int, total_rec_late_fee,
        total_pymnt, last_pymnt_amnt, last_pymnt_d, next_pymnt_d FROM keyed""",
    "proj_defaulters": """member_id, delinq_2yrs, delinq_amnt, pub_rec, pub_rec_bankruptcies,
        inq_last_6mths, total_rec_late_fee, mths_since_last_delinq, mths_since_last_record
        FROM keyed""",
    "clean_rename_cast": "* FROM typed_customers",
    "clean_ingest_stamp": """loan_id, member_id, TIMESTAMP '2024-01-01 00:00:00' AS ingest_date
        FROM typed_loans""",
    "filter_income_present": "* FROM typed_customers WHERE annual_income IS NOT NULL",
    "filter_complete_loans": "* FROM complete_loans",
    "filter_complete_repayments": "* FROM complete_repayments",
    "filter_nonzero_payment": "* FROM paid_repayments",
    "clean_fill_zero": """member_id, delinq_2yrs, pub_rec, pub_rec_bankruptcies, inq_last_6mths
        FROM filled_defaulters""",
    "clean_fill_mean": "member_id, emp_length FROM customers",
    "clean_digits_to_int": """id, try_cast(regexp_replace(emp_length, '\\D', '', 'g') AS INT)
        AS emp_length FROM raw""",
    "clean_state_code": """id, CASE WHEN length(addr_state) > 2 THEN 'NA' ELSE addr_state END
        AS address_state FROM raw""",
    "clean_loan_term_years": """id, trunc(try_cast(replace(term, ' months', '') AS INT) / 12)::INT
        AS loan_term_years FROM raw""",
    "clean_total_payment": "* FROM reconciled_repayments",
    "clean_date_sentinel": """id, nullif(last_pymnt_d, '0.0') AS last_payment_date,
        nullif(next_pymnt_d, '0.0') AS next_payment_date FROM raw""",
    "clean_purpose_allowlist": f"""id, CASE WHEN purpose IN ({PURPOSES}) THEN purpose
        ELSE 'other' END AS loan_purpose FROM raw""",
    "table_customers": "* FROM customers",
    "table_loans": "* FROM loans",
    "table_repayments": "* FROM repayments",
    "table_delinquency": "* FROM delinquency",
    "table_records_enquiries": "* FROM records",
    "table_enquiry_members": """member_id FROM typed_defaulters
        WHERE pub_rec > 0 OR pub_rec_bankruptcies > 0 OR inq_last_6mths > 0""",
    "distinct_customers": "* FROM distinct_customers",
    "agg_floor_mean": "floor(avg(emp_length))::BIGINT AS emp_length FROM numbered_customers",
    "dup_keys_verification": "member_id FROM dup_verification",
    "dup_keys_delinquency": "member_id FROM dup_delinquency",
    "dup_keys_records": "member_id FROM dup_records",
    "table_verification": "* FROM verification",
    "table_bad_members": "member_id FROM bad",
    "bad_members_from_tables": "member_id FROM bad",
    "bad_members_of_three": """member_id FROM (SELECT member_id FROM dup_loans
        UNION SELECT member_id FROM dup_delinquency UNION SELECT member_id FROM dup_records)""",
    "table_good_customers": "* FROM good",
    "good_customers_from_tables": "* FROM good",
    "join_repayment_loan": "* EXCLUDE (member_id) FROM payment_pairs",
    "join_repayment_member": "* FROM member_points",
    "join_repayment_member_folded": "* FROM folded_points",
    "score_base": "* FROM base",
    "score_last_payment": "loan_id, last_payment_pts FROM payment_points",
    "score_total_payment": "loan_id, total_payment_pts FROM payment_points",
    "score_payment_history": """member_id, (last_payment_pts + total_payment_pts) * 0.20::DOUBLE
        AS payment_history_pts FROM member_points""",
    "score_default_history": """member_id,
        (delinq_2yrs + pub_rec + pub_rec_bankruptcies + inq_last_6mths) * 0.45::DOUBLE
        AS defaulters_history_pts FROM filled_defaulters""",
    "score_loan_status": f"loan_id, {LOAN_STATUS_POINTS} AS loan_status_pts FROM typed_loans",
    "score_home_ownership": f"""member_id, {HOME_OWNERSHIP_POINTS} AS home_ownership_pts
        FROM typed_customers""",
    "score_credit_use": f"id, {CREDIT_USE_POINTS} AS credit_use_pts FROM {HEALTH_INPUTS}",
    "score_grade": f"member_id, {GRADE_POINTS} AS grade_pts FROM typed_customers",
    "score_financial_health": f"id, {HEALTH} AS financial_health_pts FROM {HEALTH_INPUTS}",
    "score_financial_health_all": f"id, {HEALTH_ALL} AS financial_health_pts FROM {HEALTH_INPUTS}",
    "score_total": f"member_id, loan_score FROM {SCORES}",
    "score_grade_band": f"member_id, loan_final_grade FROM {SCORES}",
    "loan_score": f"* FROM {SCORES}",
    "loan_score_all": f"* FROM {_scores(HEALTH_ALL)}",
    "loan_score_from_tables": f"* FROM {SCORES}",
    "score_preview": f"* FROM {SCORES} ORDER BY member_id, payment_history_pts LIMIT 20",
}

# The same results by other plans: few rows per task, other sources, written tables.
COUNTED = "*, count(*) AS _times FROM verification GROUP BY ALL"
RESULTS |= {
    "id_member_hash_csv": RESULTS["id_member_hash"],
    "table_verification_spread": RESULTS["table_verification"],
    "table_bad_members_spread": RESULTS["table_bad_members"],
    "bad_members_spread": RESULTS["table_bad_members"],
    "repayment_points_counted": """loan_id, last_payment_pts, total_payment_pts,
        count(*) AS _times FROM payment_points GROUP BY ALL""",
    "join_repayment_member_spread": RESULTS["join_repayment_member"],
    "score_base_spread": RESULTS["score_base"],
    "loan_score_spread": RESULTS["loan_score"],
    "batch_customers": RESULTS["table_customers"],
    "verification_counted": COUNTED,
    "verification_counted_spread": COUNTED,
    "batch_verification": COUNTED,
    "batch_factorised": RESULTS["table_verification"],
    "bucketed_verification": RESULTS["table_verification"],
    "bucketed_bad_members": RESULTS["table_bad_members"],
    "bucketed_dup_records": RESULTS["dup_keys_records"],
    "bucketed_good_customers": RESULTS["table_good_customers"],
    "batch_repayments": RESULTS["table_repayments"],
    "batch_delinquency": RESULTS["table_delinquency"],
    "batch_records": RESULTS["table_records_enquiries"],
    "batch_audit": """table_name, step::INT AS step, filter_name, n_rows FROM (
        SELECT 'customers' AS table_name, 0 AS step, 'rows' AS filter_name,
               (SELECT count(*) FROM distinct_customers) AS n_rows
        UNION ALL SELECT 'customers', 1, 'income_present', (SELECT count(*) FROM customers)
        UNION ALL SELECT 'loans', 0, 'rows', (SELECT count(*) FROM typed_loans)
        UNION ALL SELECT 'loans', 1, 'complete', (SELECT count(*) FROM complete_loans)
        UNION ALL SELECT 'repayments', 0, 'rows', (SELECT count(*) FROM typed_repayments)
        UNION ALL SELECT 'repayments', 1, 'complete', (SELECT count(*) FROM complete_repayments)
        UNION ALL SELECT 'repayments', 2, 'paid', (SELECT count(*) FROM paid_repayments)
        UNION ALL SELECT 'delinquency', 0, 'rows', (SELECT count(*) FROM typed_defaulters)
        UNION ALL SELECT 'delinquency', 1, 'delinquent', (SELECT count(*) FROM delinquency)
        UNION ALL SELECT 'records', 0, 'rows', (SELECT count(*) FROM records))""",
    "published_good_customers": RESULTS["table_good_customers"],
    "incremental_scores": RESULTS["loan_score"],
    "incremental_bad_members": RESULTS["table_bad_members"],
    "incremental_customers": RESULTS["table_customers"],
    "verification_factorised": RESULTS["table_verification"],
    "batch_loans": RESULTS["table_loans"],
    "batch_bad_members": RESULTS["table_bad_members"],
    "batch_good_customers": RESULTS["table_good_customers"],
}

ORACLE_SQL = {
    name: f"{STEPS.replace('{purposes}', PURPOSES)}\nSELECT {result}"
    for name, result in RESULTS.items()
}
