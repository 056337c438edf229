"""Column lists, thresholds, dictionaries and wordings the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: columns of the raw loan table, all text ---------------------------------------
RAW_COLUMNS = [
    "id", "member_id",
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "term", "int_rate", "installment", "grade", "sub_grade", "issue_d",
    "emp_title", "emp_length", "home_ownership", "annual_inc", "verification_status", "addr_state", "zip_code",
    "purpose", "title", "initial_list_status", "application_type",
    "fico_range_low", "fico_range_high",
    "open_acc", "total_acc", "pub_rec", "pub_rec_bankruptcies", "earliest_cr_line", "mort_acc",
    "delinq_2yrs", "inq_last_6mths",
    "revol_bal", "revol_util",
    "dti",
    "loan_status",
]
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# --- Fixed values: outcome rules -----------------------------------------------------------------
DEFAULT_STATUSES = ("Charged Off", "Default", "Late (31-120 days)", "Late (16-30 days)")
PAID_STATUS = "Fully Paid"
MATURITY_GUARD = "2017-12-01"
SPLITS = ("train", "valid", "test")
SCORED_SPLITS = ("valid", "test")

# --- Fixed values: model inputs ------------------------------------------------------------------
NUMERIC_FEATURES = [
    "loan_amount", "interest_rate", "installment", "term_months",
    "annual_income", "dti",
    "fico_low", "fico_high",
    "open_acc", "total_acc", "pub_rec",
    "delinq_2yrs", "inq_last_6mths",
    "revol_bal", "revol_util",
    "credit_history_years",
]
CATEGORICAL_FEATURES = [
    "home_ownership", "grade", "purpose", "verification_status", "initial_list_status", "emp_length",
]
LENDER_ASSESSMENT = ("grade", "interest_rate")
LENDER_ASSESSMENT_STRICT = ("grade", "interest_rate", "installment")

# --- Fixed values: monitored inputs --------------------------------------------------------------
DRIFT_NUMERIC = ["loan_amount", "interest_rate", "annual_income", "dti", "revol_bal", "revol_util", "total_acc"]
DRIFT_CATEGORICAL = ["home_ownership", "grade", "purpose", "verification_status", "initial_list_status"]

# --- Fixed values: validation limits -------------------------------------------------------------
MIN_TRAIN_ROWS = 100_000
LABEL_RATE_RANGE = (0.05, 0.60)
LABEL_SHIFT_WARN = 0.10
NULL_WARN, NULL_FAIL = 0.05, 0.50
RANGE_WARN, RANGE_FAIL = 0.0, 0.01
PLAUSIBLE_RANGES = {
    "loan_amount": (500, 50_000),
    "interest_rate": (1, 40),
    "installment": (1, 2_000),
    "annual_income": (1, 100_000_000),
    "dti": (0, 100),
    "fico_low": (300, 850),
    "fico_high": (300, 850),
    "open_acc": (0, 200),
    "total_acc": (0, 300),
    "pub_rec": (0, 100),
    "delinq_2yrs": (0, 100),
    "inq_last_6mths": (0, 50),
    "revol_bal": (0, 100_000_000),
    "revol_util": (0, 1_000),
    "credit_history_years": (0, 90),
}
ALLOWED_VALUES = {"term_months": (36, 60)}

# --- Fixed values: alert limits (warning, critical) ----------------------------------------------
SCORE_P90_LIMITS = (0.03, 0.05)
NUMERIC_MEAN_LIMITS = (0.10, 0.20)
CATEGORICAL_SHARE_LIMITS = (0.05, 0.08)
TOP_FRACTIONS = (0.01, 0.05, 0.10)

# --- Fixed values: dashboard names of the monitored inputs ---------------------------------------
FEATURE_LABELS = [
    ("loan_amount", "Loan amount", "Loan"),
    ("interest_rate", "Interest rate", "Loan"),
    ("grade", "Lending Club grade", "Loan"),
    ("purpose", "Loan purpose", "Loan"),
    ("initial_list_status", "Listing type (whole/fractional)", "Loan"),
    ("annual_income", "Annual income", "Borrower"),
    ("dti", "Debt-to-income ratio", "Borrower"),
    ("home_ownership", "Home ownership", "Borrower"),
    ("verification_status", "Income verification", "Borrower"),
    ("revol_bal", "Credit card balance", "Credit history"),
    ("revol_util", "Credit card utilisation", "Credit history"),
    ("total_acc", "Number of credit accounts", "Credit history"),
]

# --- Fixed values: reason codes ------------------------------------------------------------------
REASON_GROUPS = {
    "fico_low": "credit_score",
    "fico_high": "credit_score",
    "dti": "debt_to_income",
    "annual_income": "loan_vs_income",
    "loan_amount": "loan_vs_income",
    "installment": "loan_vs_income",
    "term_months": "loan_term",
    "revol_util": "revolving_use",
    "revol_bal": "revolving_use",
    "inq_last_6mths": "recent_inquiries",
    "delinq_2yrs": "delinquency",
    "pub_rec": "public_records",
    "credit_history_years": "history_length",
    "open_acc": "account_mix",
    "total_acc": "account_mix",
    "emp_length": "employment_length",
    "home_ownership": "housing",
    "purpose": "loan_purpose",
    "verification_status": "income_verification",
    "grade": "lc_assessment",
    "interest_rate": "lc_assessment",
    "initial_list_status": "listing_type",
}
REASON_TEXTS = {
    "credit_score": ("R01", "Credit score is lower than for approved applicants"),
    "debt_to_income": ("R02", "Existing debt payments are high relative to income"),
    "loan_vs_income": ("R03", "Requested loan or monthly payment is high relative to income"),
    "revolving_use": ("R04", "High balances or utilisation on revolving credit"),
    "recent_inquiries": ("R05", "Several recent applications for credit"),
    "delinquency": ("R06", "Recent history of late payments"),
    "public_records": ("R07", "Public record on credit file"),
    "history_length": ("R08", "Limited length of credit history"),
    "account_mix": ("R09", "Number or type of credit accounts"),
    "loan_term": ("R10", "Longer repayment term requested"),
    "employment_length": ("R11", "Length of employment"),
    "income_verification": ("R12", "Income could not be verified"),
    "loan_purpose": ("R13", "Purpose of the loan"),
    "housing": ("R14", "Housing status"),
}
NON_REPORTABLE_GROUPS = ("lc_assessment", "listing_type")
TERM_GROUP = "loan_term"
SHORT_TERM = 36
TERM_DEPENDENT = ("installment", "interest_rate", "grade")
TERM_NOTE = "Longer repayment term increased risk"
COUNTER_OFFER_NOTE = "Counter-offer: would qualify on a 36-month term"
EXPECTED_SIGNS = {
    "fico_low": -1, "fico_high": -1, "dti": +1, "annual_income": -1,
    "loan_amount": +1, "installment": +1, "revol_util": +1,
    "inq_last_6mths": +1, "delinq_2yrs": +1, "pub_rec": +1,
    "credit_history_years": -1, "term_months": +1,
}
TOP_REASONS = 4
MIN_LOGODDS = 0.02
DECLINE_RATE = 0.10


# --- Fixed values: layouts of the stored tables --------------------------------------------------
TIMESTAMP, STRING, LONG, DOUBLE, DATE = T.TimestampType(), T.StringType(), T.LongType(), T.DoubleType(), T.DateType()
PREDICTIONS_SCHEMA = T.StructType([
    T.StructField("ts", TIMESTAMP),
    T.StructField("model_version", STRING),
    T.StructField("split", STRING),
    T.StructField("loan_id", STRING),
    T.StructField("issue_date", DATE),
    T.StructField("p_default", DOUBLE),
])
METRICS_SCHEMA = T.StructType([
    T.StructField("ts", TIMESTAMP),
    T.StructField("model_version", STRING),
    T.StructField("split", STRING),
    T.StructField("metrics_json", STRING),
    T.StructField("roc_auc", DOUBLE),
    T.StructField("pr_auc", DOUBLE),
    T.StructField("brier", DOUBLE),
    T.StructField("top_1pct_precision", DOUBLE),
    T.StructField("top_1pct_recall", DOUBLE),
    T.StructField("top_5pct_precision", DOUBLE),
    T.StructField("top_5pct_recall", DOUBLE),
    T.StructField("top_10pct_precision", DOUBLE),
    T.StructField("top_10pct_recall", DOUBLE),
])
SCORE_DRIFT_SCHEMA = T.StructType([
    T.StructField("ts", TIMESTAMP),
    T.StructField("model_version", STRING),
    T.StructField("split", STRING),
    T.StructField("issue_month", STRING),
    T.StructField("n", LONG),
    T.StructField("avg_pd", DOUBLE),
    T.StructField("p50", DOUBLE),
    T.StructField("p90", DOUBLE),
    T.StructField("p99", DOUBLE),
])
FEATURE_DRIFT_SCHEMA = T.StructType([
    T.StructField("ts", TIMESTAMP),
    T.StructField("model_version", STRING),
    T.StructField("split", STRING),
    T.StructField("issue_month", STRING),
    T.StructField("feature_name", STRING),
    T.StructField("feature_type", STRING),
    T.StructField("n", LONG),
    T.StructField("null_rate", DOUBLE),
    T.StructField("mean", DOUBLE),
    T.StructField("std", DOUBLE),
    T.StructField("min", DOUBLE),
    T.StructField("max", DOUBLE),
    T.StructField("top_category", STRING),
    T.StructField("top_category_share", DOUBLE),
    T.StructField("entropy", DOUBLE),
])
ROLLUPS_SCHEMA = T.StructType([
    T.StructField("ts", TIMESTAMP),
    T.StructField("model_version", STRING),
    T.StructField("split", STRING),
    T.StructField("n", LONG),
    T.StructField("base_rate", DOUBLE),
    T.StructField("top_1pct_default_rate", DOUBLE),
    T.StructField("top_5pct_default_rate", DOUBLE),
    T.StructField("top_10pct_default_rate", DOUBLE),
    T.StructField("lift_at_1pct", DOUBLE),
    T.StructField("lift_at_5pct", DOUBLE),
    T.StructField("lift_at_10pct", DOUBLE),
    T.StructField("recall_at_1pct", DOUBLE),
    T.StructField("recall_at_5pct", DOUBLE),
    T.StructField("recall_at_10pct", DOUBLE),
])
ALERTS_SCHEMA = T.StructType([
    T.StructField("ts", TIMESTAMP),
    T.StructField("model_version", STRING),
    T.StructField("split", STRING),
    T.StructField("issue_month", STRING),
    T.StructField("alert_type", STRING),
    T.StructField("entity", STRING),
    T.StructField("value", DOUBLE),
    T.StructField("threshold", DOUBLE),
    T.StructField("severity", STRING),
    T.StructField("details", STRING),
])
