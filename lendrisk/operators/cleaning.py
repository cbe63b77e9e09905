"""Cleaning rules for the three raw tables. One ``select`` per table: no chain of updates, one pass over the data."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendrisk import fixed_values as V
from lendrisk.functions.text import capitalize_first, null_if_in


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keep the first row per key in ``order``.

    Catalyst turns "row number = 1" into a group limit that also runs before the shuffle, so a key with very many copies
    sends one row per map task and not all of them to one reducer.
    """
    first = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def missing_flag(value: Column) -> Column:
    """1 where the value is missing, else 0."""
    return F.when(value.isNull(), 1).otherwise(0)


def clean_members(raw: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """One row per member: first occurrence, tidy names, placeholders to NULL, missing scores flagged."""
    c = F.col
    return dedup_keep_first(raw, ["member_id"], order).select(
        "member_id",
        capitalize_first(c("first_name"), trim=True).alias("first_name"),
        capitalize_first(c("last_name"), trim=True).alias("last_name"),
        "join_date",
        "city",
        "state",
        "credit_score",
        null_if_in(c("email"), V.EMAIL_PLACEHOLDERS).alias("email"),
        null_if_in(c("phone"), V.PHONE_PLACEHOLDERS).alias("phone"),
        "account_status",
        missing_flag(c("credit_score")).alias("credit_score_missing"),
    )


def clean_loan_type(loan_type: Column, canonical: bool = False) -> Column:
    """First letter raised (C4): ``auto loan`` -> ``Auto loan``. ``canonical`` raises every word, which merges the casings."""
    return F.initcap(loan_type) if canonical else capitalize_first(loan_type, lower_rest=False)


def clean_loans(raw: DataFrame, canonical_types: bool = False) -> DataFrame:
    """Positive amounts, loan-type casing, missing rates flagged (C4, C7, C11). Repeated loans are kept."""
    c = F.col
    return raw.select(
        "loan_id",
        "member_id",
        clean_loan_type(c("loan_type"), canonical_types).alias("loan_type"),
        F.abs("original_amount").alias("original_amount"),
        "interest_rate",
        "term_months",
        "origination_date",
        "loan_status",
        missing_flag(c("interest_rate")).alias("rate_missing"),
    )


def clean_payments(raw: DataFrame) -> DataFrame:
    """Status casing, positive payments, blank payment dates to NULL (C5, C10, C12). Repeated payments are kept."""
    c = F.col
    return raw.select(
        "payment_id",
        "loan_id",
        "due_date",
        null_if_in(c("payment_date"), V.PAYMENT_DATE_PLACEHOLDERS).alias("payment_date"),
        "expected_amount",
        F.abs("actual_amount").alias("actual_amount"),
        capitalize_first(c("payment_status")).alias("payment_status"),
    )
