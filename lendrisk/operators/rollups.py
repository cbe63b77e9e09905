"""Payment measures per loan and their exact roll-up to any coarser grain."""

from pyspark.sql import Column, DataFrame, functions as F

from lendrisk.functions.measures import due_month, is_delinquent, is_missed, past_due

MEASURES = ("total_payments", "late_payments", "missed_payments", "past_due")


def payment_counts() -> list[Column]:
    """Payments with an id, and late or missed ones (A1, A2, A4)."""
    return [
        F.count("payment_id").alias("total_payments"),
        F.count_if(is_delinquent()).alias("late_payments"),
    ]


def loan_payment_stats(payments: DataFrame) -> DataFrame:
    """One row per loan with its payment counts and exact past-due sum (A1, A3, A4).

    The one pass over the payments that most marts share. It is combined before the shuffle, so a loan with very many
    payments costs one row per map task. All measures are whole numbers or decimals, so they roll up exactly to any coarser grain.
    """
    return payments.groupBy("loan_id").agg(
        *payment_counts(),
        F.count_if(is_missed()).alias("missed_payments"),
        F.sum(past_due()).alias("past_due"),
    )


def sum_measures(names: tuple[str, ...] = MEASURES) -> list[Column]:
    """Sums that roll ``loan_payment_stats`` columns up to the grouping they are used in."""
    return [F.sum(name).alias(name) for name in names]


def loan_activity(payments: DataFrame) -> DataFrame:
    """One row per loan, due month and status: its payments (``rows``), those with an id, and the exact past-due sum.

    What ``loan_payment_stats``, the monthly trend, the headline numbers and the monthly status are all rolled up from, so a run
    that stores it reads payments once for the four. It is combined before the shuffle, and as a loan has few months and
    statuses it is far smaller than the payments. NULL loans, months and statuses are groups like any other.
    """
    return payments.groupBy("loan_id", due_month(F.col("due_date")).alias("month"), "payment_status").agg(
        F.count(F.lit(1)).alias("rows"), F.count("payment_id").alias("total_payments"), F.sum(past_due()).alias("past_due")
    )


def activity_counts() -> list[Column]:
    """``payment_counts`` from ``loan_activity`` rows."""
    return [F.sum("total_payments").alias("total_payments"), rows_where(is_delinquent()).alias("late_payments")]


def rows_where(test: Column) -> Column:
    """How many payments the ``loan_activity`` rows that pass ``test`` stand for."""
    return F.sum(F.when(test, F.col("rows")).otherwise(F.lit(0).cast("bigint")))


def stats_of_activity(activity: DataFrame) -> DataFrame:
    """``loan_payment_stats`` from ``loan_activity``."""
    return activity.groupBy("loan_id").agg(
        *activity_counts(), rows_where(is_missed()).alias("missed_payments"), F.sum("past_due").alias("past_due")
    )


def joined_row(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """Every row of ``df`` with the ``aggregates`` over all of them as the column ``key``.

    The aggregates are one row, which is broadcast and joined by a column that is 0 everywhere. Catalyst can't know that, so the join
    stays a hash join, and whatever is computed from the row refers to the one broadcast instead of repeating how it came about,
    as a scalar subquery does in each filter that is pushed down. Both sides name the same columns, so Spark computes
    the part they share once.
    """
    everywhere = F.spark_partition_id() * 0
    row = df.withColumn("_all", everywhere).groupBy("_all").agg(F.struct(*aggregates).alias(key))
    # one row
    return df.withColumn("_all", everywhere).join(F.broadcast(row), "_all").drop("_all")
