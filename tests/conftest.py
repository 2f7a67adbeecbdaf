import random

import pytest
from pyspark.sql import SparkSession

from creditgrade.schema import RAW_COLUMNS, RAW_TEXT_SCHEMA

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows_of(df):
    """Rows as sorted text, so that nulls and NaNs compare."""
    return sorted(repr(tuple(row)) for row in df.collect())


# Values that hit every branch of the cleaning rules, the first ones most often.
CHOICES = {
    "emp_title": ["a", "b", "c", "d", "e", "f", "g", None],
    "emp_length": ["10+ years", "< 1 year", "3 years", "n/a", "", None],
    "home_ownership": ["OWN", "Rent", "MORTGAGE", "ANY", None],
    "annual_inc": [50000.0, 0.0, 1.25e7, None, float("nan")],
    "zip_code": ["1", "2"],
    "addr_state": ["NY", "CA", "N10", None],
    "grade": ["A", "B", "C", "D", "E", "F", None],
    "sub_grade": ["1", "2"],
    "verification_status": ["Verified", "Not Verified"],
    "tot_hi_cred_lim": ["1000", "10000", "5000.5", "abc", None],
    "application_type": ["Individual", "Joint App"],
    "loan_amnt": ["1000", "500", "1000", "NaN"],
    "funded_amnt": ["1000", "500", "1000", "1000", None],
    "term": [" 36 months", " 60 months", "x months"],
    "int_rate": ["7.5", "10"],
    "installment": ["100", "50", "100", "75.5"],
    "issue_d": ["Jan-2015", "Jan-2015", "Jan-2015", None],
    "loan_status": ["Fully Paid", "Current", "In Grace Period", "Late (31)", "Charged Off", "?"],
    "purpose": ["car", "boat", "other"],
    "title": ["t", None],
    "total_rec_prncp": ["400", "0", "100", "600"],
    "total_rec_int": ["10", "0"],
    "total_rec_late_fee": ["0", "1.5"],
    "total_pymnt": ["410", "0", "0.0", "700", "NaN", None],
    "last_pymnt_amnt": ["50", "100", "120", "150", "151", "25", None],
    "last_pymnt_d": ["0.0", "Feb-2016", None],
    "next_pymnt_d": ["0.0", "Mar-2016"],
    "delinq_2yrs": ["1", "0", "2.9", "NaN", "", None],
    "delinq_amnt": ["0", "12.5", None],
    "pub_rec": ["0", "1", "NaN", None],
    "pub_rec_bankruptcies": ["0", "1", None],
    "inq_last_6mths": ["0", "3", "abc", None],
    "mths_since_last_delinq": ["5", "0", None, "NaN"],
}


def random_applications(spark, seed, n=400, hot_ids=3):
    """Applications with shared loan ids, copies, duplicated and single members."""
    rng = random.Random(seed)
    rows = []
    for number in range(n):
        if rows and rng.random() < 0.1:
            rows.append(rng.choice(rows))
            continue
        row = {name: rng.choice(values) for name, values in CHOICES.items()}
        hot = rng.random() < 0.4
        row["id"] = str(rng.randrange(hot_ids)) if hot else rng.choice([str(100 + number), None])
        if rng.random() < 0.7:
            row["emp_title"] = f"member {number}"
        if rng.random() < 0.5:
            row |= {"annual_inc": 60000.0, "total_pymnt": "700", "last_pymnt_amnt": "100"}
        if hot and rng.random() < 0.95:
            row["total_pymnt"] = None  # few repayments per hot loan id
        rows.append(row)
    data = [tuple(row.get(name) for name in RAW_COLUMNS) for row in rows]
    return spark.createDataFrame(data, RAW_TEXT_SCHEMA).repartition(6)
