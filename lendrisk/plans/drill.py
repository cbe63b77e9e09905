"""Dashboard queries: headline numbers, the filterable member list and one member's history."""

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendrisk.functions.measures import dollars, past_due, rate_pct
from lendrisk.operators.rollups import activity_counts, payment_counts, sum_measures
from lendrisk.plans.book import LoanBook
from lendrisk.plans.marts import member_loan_summary, payment_detail
from lendrisk.sources.clustered import Clustered

#: Places that loan ids are hashed to when one member's payments are looked for: less than a megabyte.
LOAN_PLACES = 1 << 16


def kpi_overview(book: LoanBook, delinquency: DataFrame) -> DataFrame:
    """One row of headline numbers over the cleaned tables, with the flagged members.

    Payment measures come from the written per-loan activity or statistics if the book has them, else from one pass over payments.
    """

    def rows(table: DataFrame) -> Column:
        return table.agg(F.count(F.lit(1)).alias("rows")).scalar()

    if book.activity is not None:
        totals = book.activity.agg(*activity_counts(), F.sum("past_due").alias("past_due"), F.sum("rows").alias("payments"))
    elif book.stats is None:
        totals = book.payments.agg(*payment_counts(), F.sum(past_due()).alias("past_due"), F.count(F.lit(1)).alias("payments"))
    else:
        totals = book.stats.agg(*sum_measures(("total_payments", "late_payments", "past_due"))).withColumn("payments", rows(book.payments))
    return totals.select(
        rows(book.members).alias("members"),
        rows(book.loans).alias("loans"),
        "payments",
        "late_payments",
        rate_pct(F.col("late_payments"), F.col("total_payments")).alias("delinquency_rate_pct"),
        dollars(F.col("past_due")).alias("amount_past_due"),
        rows(delinquency).alias("members_flagged"),
    )


def member_detail(
    scored: DataFrame, tier: str | None = None, city: str | None = None, min_score: float | None = None
) -> DataFrame:
    """Scored members that pass the given filters, riskiest first. Scores keep their meaning: they are made before."""
    c = F.col
    for wanted, test in (
        (tier, c("risk_tier") == tier),
        (city, c("city") == city),
        (min_score, c("risk_score") >= min_score),
    ):
        if wanted is not None:
            scored = scored.where(test)
    return scored.orderBy(F.desc("risk_score"), "member_id")


def _of_loans(rows: DataFrame, own: DataFrame) -> DataFrame:
    """``rows`` of the loans ``own``. Places of hashed ids, which are ``LOAN_PLACES`` at most and so are broadcast whatever the
    member, leave out nearly all other rows before any is shuffled; the ids themselves decide about the rest."""
    place = F.pmod(F.xxhash64("loan_id"), F.lit(LOAN_PLACES)).alias("_place_of_loan")
    places = F.broadcast(own.select(place).distinct())
    near = rows.select("*", place).join(places, "_place_of_loan", "left_semi").drop("_place_of_loan")
    return near.join(own, "loan_id", "left_semi")


def for_member(book: LoanBook, member_id: str) -> LoanBook:
    """The book of one member: the id filter reaches the member and loan scans, and payments keep only their loans.

    A member's loans are usually few, and only the payments that may be theirs are then shuffled, however many there are of
    other loans; a member with very many loans gets a shuffle join. Nothing runs before the result is asked for. All rows share
    the one member id, so it counts as hot.
    """
    loans = book.loans.where(F.col("member_id") == member_id)
    own = loans.select("loan_id")
    return replace(
        book,
        members=book.members.where(F.col("member_id") == member_id),
        loans=loans,
        payments=_of_loans(book.payments, own),
        hot_members=(member_id,),
        stats=None if book.stats is None else _of_loans(book.stats, own),
        activity=None if book.activity is None else _of_loans(book.activity, own),
        totals=None,
    )


def member_drill_loans(book: LoanBook, member_id: str) -> DataFrame:
    """D3: one member's loans with their payment measures (M6 for one member)."""
    return member_loan_summary(for_member(book, member_id)).orderBy("loan_id")


def member_drill_payments(book: LoanBook, member_id: str) -> DataFrame:
    """D3: one member's payment history (M7 for one member)."""
    return payment_detail(for_member(book, member_id)).orderBy("due_date", "payment_id")


def stored_member_loans(spark: SparkSession, summary: Clustered, member_id: str) -> DataFrame:
    """D3 from a stored M6: reads the files that may hold the member."""
    return summary.lookup(spark, member_id).orderBy("loan_id")


def stored_member_payments(spark: SparkSession, detail: Clustered, member_id: str, month: str | None = None) -> DataFrame:
    """D3 from a stored M7, of all months or of one: reads the files that may hold the member."""
    return detail.lookup(spark, member_id, part=month).orderBy("due_date", "payment_id")
