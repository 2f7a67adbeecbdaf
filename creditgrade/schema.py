"""Column names, target types and fixed value lists of the loan-application data."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must stay as they are for results to be right. ---

# Columns of one raw application that the library reads.
RAW_COLUMNS = (
    "id",
    "emp_title",
    "emp_length",
    "home_ownership",
    "annual_inc",
    "zip_code",
    "addr_state",
    "grade",
    "sub_grade",
    "verification_status",
    "tot_hi_cred_lim",
    "application_type",
    "annual_inc_joint",
    "verification_status_joint",
    "loan_amnt",
    "funded_amnt",
    "term",
    "int_rate",
    "installment",
    "issue_d",
    "loan_status",
    "purpose",
    "title",
    "total_rec_prncp",
    "total_rec_int",
    "total_rec_late_fee",
    "total_pymnt",
    "last_pymnt_amnt",
    "last_pymnt_d",
    "next_pymnt_d",
    "delinq_2yrs",
    "delinq_amnt",
    "pub_rec",
    "pub_rec_bankruptcies",
    "inq_last_6mths",
    "mths_since_last_delinq",
    "mths_since_last_record",
)

# Columns whose text makes up the member key, in hashing order.
MEMBER_KEY_COLUMNS = (
    "emp_title",
    "emp_length",
    "home_ownership",
    "annual_inc",
    "zip_code",
    "addr_state",
    "grade",
    "sub_grade",
    "verification_status",
)
MEMBER_KEY_NUMBERS = ("annual_inc",)
MEMBER_KEY_SEPARATOR = "||"

# Loan purposes that are kept; any other value becomes OTHER_PURPOSE.
LOAN_PURPOSES = (
    "debt_consolidation",
    "credit_card",
    "home_improvement",
    "other",
    "major_purchase",
    "medical",
    "small_business",
    "car",
    "vacation",
    "moving",
    "house",
    "wedding",
    "renewable_energy",
    "educational",
)
OTHER_PURPOSE = "other"

COUNTRY = "USA"
LONG_STATE = "NA"
EMPTY_DATE = "0.0"

# Curated name and type of each projected column: {source: (target, type)}.
CUSTOMER_FIELDS = {
    "member_id": ("member_id", "string"),
    "emp_title": ("emp_title", "string"),
    "emp_length": ("emp_length", "string"),
    "home_ownership": ("home_ownership", "string"),
    "annual_inc": ("annual_income", "float"),
    "addr_state": ("address_state", "string"),
    "zip_code": ("address_zipcode", "string"),
    "country": ("address_country", "string"),
    "grade": ("grade", "string"),
    "sub_grade": ("sub_grade", "string"),
    "verification_status": ("verification_status", "string"),
    "tot_hi_cred_lim": ("total_high_credit_limit", "float"),
    "application_type": ("application_type", "string"),
    "annual_inc_joint": ("joint_annual_income", "float"),
    "verification_status_joint": ("verification_status_joint", "string"),
}
LOAN_FIELDS = {
    "loan_id": ("loan_id", "string"),
    "member_id": ("member_id", "string"),
    "loan_amnt": ("loan_amount", "float"),
    "funded_amnt": ("funded_amount", "float"),
    "term": ("loan_term_months", "string"),
    "int_rate": ("interest_rate", "float"),
    "installment": ("monthly_installment", "float"),
    "issue_d": ("issue_date", "string"),
    "loan_status": ("loan_status", "string"),
    "purpose": ("loan_purpose", "string"),
    "title": ("loan_title", "string"),
}
REPAYMENT_FIELDS = {
    "loan_id": ("loan_id", "string"),
    "total_rec_prncp": ("total_principal_received", "float"),
    "total_rec_int": ("total_interest_received", "float"),
    "total_rec_late_fee": ("total_late_fee_received", "float"),
    "total_pymnt": ("total_payment_received", "float"),
    "last_pymnt_amnt": ("last_payment_amount", "float"),
    "last_pymnt_d": ("last_payment_date", "string"),
    "next_pymnt_d": ("next_payment_date", "string"),
}
DEFAULTER_FIELDS = {
    "member_id": ("member_id", "string"),
    "delinq_2yrs": ("delinq_2yrs", "float"),
    "delinq_amnt": ("delinq_amnt", "float"),
    "pub_rec": ("pub_rec", "float"),
    "pub_rec_bankruptcies": ("pub_rec_bankruptcies", "float"),
    "inq_last_6mths": ("inq_last_6mths", "float"),
    "total_rec_late_fee": ("total_rec_late_fee", "float"),
    "mths_since_last_delinq": ("mths_since_last_delinq", "float"),
    "mths_since_last_record": ("mths_since_last_record", "float"),
}

# A loan or repayment row with a null or NaN in any of these is dropped.
REQUIRED_LOAN_COLUMNS = (
    "loan_amount",
    "funded_amount",
    "loan_term_months",
    "interest_rate",
    "monthly_installment",
    "issue_date",
    "loan_status",
    "loan_purpose",
)
LOAN_TEXT_COLUMNS = ("loan_term_months", "issue_date", "loan_status", "loan_purpose")
REQUIRED_REPAYMENT_COLUMNS = (
    "total_principal_received",
    "total_interest_received",
    "total_late_fee_received",
    "total_payment_received",
    "last_payment_amount",
)

# Output columns of the verification table, by the table they come from.
VERIFICATION_LOAN_KEY = ("loan_id",)
VERIFICATION_CUSTOMER_COLUMNS = (
    "member_id",
    "emp_title",
    "emp_length",
    "home_ownership",
    "annual_income",
    "address_state",
    "address_zipcode",
    "address_country",
    "grade",
    "sub_grade",
    "verification_status",
    "total_high_credit_limit",
    "application_type",
    "joint_annual_income",
    "verification_status_joint",
)
VERIFICATION_LOAN_COLUMNS = (
    "loan_amount",
    "funded_amount",
    "loan_term_years",
    "interest_rate",
    "monthly_installment",
    "issue_date",
    "loan_status",
    "loan_purpose",
)
VERIFICATION_REPAYMENT_COLUMNS = (
    "total_principal_received",
    "total_interest_received",
    "total_late_fee_received",
    "last_payment_date",
    "next_payment_date",
)
VERIFICATION_DELINQUENCY_COLUMNS = (
    "delinq_2yrs",
    "delinq_amnt",
    "mths_since_last_delinq",
)
VERIFICATION_RECORD_COLUMNS = (
    "pub_rec",
    "pub_rec_bankruptcies",
    "inq_last_6mths",
)

# --- End of fixed values. ---

# Delimited files are read as text; the cleaning operators do the typing. Only
# the income is typed on read, because its text is part of the member key.
RAW_TEXT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.DoubleType() if name == "annual_inc" else T.StringType())
        for name in RAW_COLUMNS
    ]
)
