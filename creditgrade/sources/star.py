"""Raw applications derived from order tables, for trying the library out.

One application per order of the ``customer``/``orders``/``lineitem`` tables,
and every order whose key is a multiple of 200 a second time. FIXTURES.md lists
the mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Raw column by its expression over an order with its customer and line facts.
MAPPING = {
    "id": "CAST(IF(k % 211 = 0 AND k > 0, k - 1, k) AS STRING)",
    "emp_title": "c_name",
    "emp_length": """CASE o_orderpriority
        WHEN '1-URGENT' THEN '< 1 year' WHEN '2-HIGH' THEN '2 years'
        WHEN '3-MEDIUM' THEN '3 years' WHEN '4-NOT SPECIFIED' THEN 'n/a'
        ELSE '10+ years' END""",
    "home_ownership": """CASE o_orderstatus
        WHEN 'P' THEN 'MORTGAGE' WHEN 'F' THEN 'RENT' ELSE 'OWN' END""",
    "annual_inc": "income",
    "zip_code": "CAST(c_nationkey AS STRING)",
    "addr_state": "'N' || c_nationkey",
    "grade": "letter",
    "sub_grade": "letter || (1 + ck % 5)",
    "verification_status": "verified",
    "tot_hi_cred_lim": "IF(ck % 50 = 0, NULL, abs(c_acctbal) * 100)",
    "application_type": "IF(ck % 20 = 0, 'Joint App', 'Individual')",
    "annual_inc_joint": "IF(ck % 20 = 0, income * 2, NULL)",
    "verification_status_joint": "IF(ck % 20 = 0, verified, NULL)",
    "loan_amnt": "o_totalprice",
    "funded_amnt": "o_totalprice",
    "term": "IF(k % 3 < 2, ' 36 months', ' 60 months')",
    "int_rate": "5 + k % 20",
    "installment": "monthly",
    "issue_d": "IF(k % 97 = 0, NULL, date_format(o_orderdate, 'MMM-yyyy'))",
    "loan_status": """CASE k % 6
        WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Current' WHEN 2 THEN 'In Grace Period'
        WHEN 3 THEN 'Late (16-30 days)' WHEN 4 THEN 'Charged Off' ELSE 'Default' END""",
    "purpose": """CASE k % 4
        WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'car'
        ELSE IF(k % 16 = 15, 'Car', 'boat') END""",
    "title": "IF(k % 5 = 0, NULL, 'loan ' || k % 17)",
    "total_rec_prncp": "IF(k % 25 = 0, 0D, highest)",
    "total_rec_int": "lowest",
    "total_rec_late_fee": "returned",
    "total_pymnt": "IF(k % 10 = 0, 0D, highest + lowest + returned)",
    "last_pymnt_amnt": "monthly * 0.25D * (k % 8)",
    "last_pymnt_d": "IF(k % 7 = 0, '0.0', 'Jan-2002')",
    "next_pymnt_d": "IF(k % 11 = 0, '0.0', 'Feb-2002')",
    "delinq_2yrs": "nullif(returned, 0)",
    "delinq_amnt": "100 * returned",
    "mths_since_last_delinq": "IF(returned <> 0 OR k % 2 = 0, k % 24, NULL)",
    "pub_rec": "IF(k % 9 = 0, NULL, open_lines)",
    "pub_rec_bankruptcies": "k % 2",
    "inq_last_6mths": "IF(k % 13 = 0, NULL, k % 5)",
    "mths_since_last_record": "IF(k % 3 = 0, NULL, CAST(k % 30 AS DOUBLE))",
}


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw application table over the order tables in a folder."""
    customer = spark.read.schema(
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE"
    ).parquet(f"{sf_dir}/customer.parquet")
    orders = spark.read.schema(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ).parquet(f"{sf_dir}/orders.parquet")
    lineitem = spark.read.schema(
        "l_orderkey BIGINT, l_extendedprice DOUBLE, l_returnflag STRING, l_linestatus STRING"
    ).parquet(f"{sf_dir}/lineitem.parquet")
    lines = spark.sql(
        """
        SELECT l_orderkey AS o_orderkey,
               count_if(l_returnflag = 'R') AS n_returned,
               count_if(l_linestatus = 'O') AS n_open,
               max(l_extendedprice) AS highest,
               min(l_extendedprice) AS lowest
        FROM {lineitem} GROUP BY l_orderkey
        """,
        lineitem=lineitem,
    )
    facts = (
        orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(lines, "o_orderkey", "left")
        .selectExpr(
            "*",
            "o_orderkey AS k",
            "o_custkey AS ck",
            "coalesce(n_returned, 0) AS returned",
            "coalesce(n_open, 0) AS open_lines",
            "IF(c_acctbal < 0, NULL, floor(c_acctbal)) AS income",
            "element_at(array('Verified', 'Source Verified', 'Not Verified'), "
            "CAST(o_custkey % 3 + 1 AS INT)) AS verified",
            "chr(65 + o_custkey % 7) AS letter",
            "floor(o_totalprice / 36) AS monthly",
            "explode(IF(o_orderkey % 200 = 0, array(1, 2), array(1))) AS time",
        )
    )
    return facts.selectExpr(*(f"{text} AS {name}" for name, text in MAPPING.items()))
