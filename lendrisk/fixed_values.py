"""Names and numbers that define the results. They are all defaults: the functions that use them take them as arguments."""

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------------------------------------

# Texts that a CSV scan reads as "missing" (the usual data-frame reader's list).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Placeholders that cleaning turns into NULL, per column.
PHONE_PLACEHOLDERS = ("N/A", "n/a", "")
EMAIL_PLACEHOLDERS = ("", " ")
PAYMENT_DATE_PLACEHOLDERS = ("", " ")

# Payment statuses after cleaning, and the two that make a payment delinquent.
ON_TIME = "On time"
LATE = "Late"
MISSED = "Missed"
PARTIAL = "Partial"
DELINQUENT_STATUSES = (LATE, MISSED)

ACTIVE = "Active"
MIN_LATE_PAYMENTS = 3

# Credit bands: lowest score of the band, label. Best first; the first that fits is taken.
CREDIT_BANDS = (
    (750, "750+ (Excellent)"),
    (700, "700-749 (Good)"),
    (650, "650-699 (Fair)"),
    (600, "600-649 (Below Avg)"),
)
CREDIT_BAND_BELOW = "Below 600 (Poor)"
CREDIT_BAND_UNKNOWN = "Unknown"

# Risk score weights.
RISK_WEIGHTS = {"late": 0.4, "missed": 0.3, "amount": 0.2, "rate": 0.1}

# Risk tiers: highest score of the tier (included), label. The lowest tier starts at 0 (included).
RISK_TIERS = (
    (25, "Low Risk"),
    (50, "Moderate Risk"),
    (75, "High Risk"),
    (100, "Critical Risk"),
)
# The other documented scheme: under 20, 20 to 40, above 40.
DOCUMENTED_LOW_BELOW = 20
DOCUMENTED_HIGH_ABOVE = 40
DOCUMENTED_TIERS = ("Low Risk", "Moderate Risk", "High Risk")

# Tables a full run exports, in this order.
EXPORTED_TABLES = (
    "member_delinquency_scored",
    "delinquency_by_loan_type",
    "monthly_delinquency_trend",
    "delinquency_by_credit_tier",
    "delinquency_by_city",
    "member_loan_summary",
    "payment_detail",
    "members_clean",
    "loans_clean",
)

# Exported as one file each: a row per group.
SINGLE_FILE_EXPORTS = (
    "delinquency_by_loan_type", "monthly_delinquency_trend", "delinquency_by_credit_tier", "delinquency_by_city",
)

# --- raw table schemas ----------------------------------------------------------------------------------------------

RAW_MEMBERS = T.StructType([
    T.StructField("member_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("join_date", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("credit_score", T.DoubleType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("account_status", T.StringType()),
])

RAW_LOANS = T.StructType([
    T.StructField("loan_id", T.StringType()),
    T.StructField("member_id", T.StringType()),
    T.StructField("loan_type", T.StringType()),
    T.StructField("original_amount", T.DoubleType()),
    T.StructField("interest_rate", T.DoubleType()),
    T.StructField("term_months", T.LongType()),
    T.StructField("origination_date", T.StringType()),
    T.StructField("loan_status", T.StringType()),
])

RAW_PAYMENTS = T.StructType([
    T.StructField("payment_id", T.StringType()),
    T.StructField("loan_id", T.StringType()),
    T.StructField("due_date", T.StringType()),
    T.StructField("payment_date", T.StringType()),
    T.StructField("expected_amount", T.DoubleType()),
    T.StructField("actual_amount", T.DoubleType()),
    T.StructField("payment_status", T.StringType()),
])

RAW_SCHEMAS = {"raw_members": RAW_MEMBERS, "raw_loans": RAW_LOANS, "raw_payments": RAW_PAYMENTS}
