"""The seven analytical tables.

Payments are the large table. Five of the marts read it through ``loan_payment_stats``: one pass, combined before the only
shuffle that grows with it. ``payment_detail`` reads payments directly; the monthly tables roll up ``loan_activity``.
"""

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendrisk import fixed_values as V
from lendrisk.functions.measures import credit_band, days_late, dollars, due_month, rate_pct, shortfall
from lendrisk.functions.text import full_name
from lendrisk.operators.rollups import activity_counts, payment_counts, rows_where, sum_measures
from lendrisk.operators.skew import join_unique
from lendrisk.plans.book import LoanBook


def _rate(late: str = "late_payments") -> Column:
    return rate_pct(F.col(late), F.col("total_payments"))


def _member_name() -> Column:
    return full_name(F.col("first_name"), F.col("last_name")).alias("member_name")


def worst_first(df: DataFrame, key: str) -> DataFrame:
    """Groups by falling rate; equal rates by falling key (O1)."""
    return df.orderBy(F.desc("delinquency_rate_pct"), F.desc(key))


LOAN_SUMMARY_COLUMNS = ("loan_type", "original_amount", "interest_rate", "loan_status", "origination_date")


def loan_rollup(book: LoanBook) -> DataFrame:
    """Payment measures per loan that has payments: a row per id, member id and summary columns, in which equal copies add up.

    What the members' totals, the loan types and the loan summary are all made from in a run that stores it, so that loans meet
    their statistics once. ``first_of_type`` is 1 in one row of each id and type, which makes a type's number of loans a plain count; like the
    grouping it works on the partitioning of the join.
    """
    if book.loan_totals is not None:
        return book.loan_totals
    keys = ("loan_id", "member_id", *LOAN_SUMMARY_COLUMNS)
    rows = book.with_stats(book.loans.select(*keys)).groupBy(*keys).agg(*sum_measures())
    of_type = Window.partitionBy("loan_id", "loan_type").orderBy("member_id")
    return rows.withColumn("first_of_type", F.when(F.row_number().over(of_type) == 1, 1).otherwise(0))


def member_rollup(book: LoanBook) -> DataFrame:
    """Payment measures per member id.

    Summed per member before members are joined, so a member with very many loans is combined first and the join is
    one row to one row on an existing partitioning.
    """
    if book.totals is not None:
        return book.totals
    if book.loan_totals is not None:
        return book.loan_totals.groupBy("member_id").agg(*sum_measures())
    loans = book.loans.select("loan_id", "member_id")
    return book.with_stats(loans).groupBy("member_id").agg(*sum_measures())


def member_delinquency(book: LoanBook, min_late: int = V.MIN_LATE_PAYMENTS, status: str = V.ACTIVE) -> DataFrame:
    """M1: members of one account status with at least ``min_late`` late or missed payments."""
    flagged = member_rollup(book).where(F.col("late_payments") >= min_late)
    members = book.members.where(F.col("account_status") == status)
    return members.join(flagged, "member_id").select(
        "member_id",
        _member_name(),
        "city",
        "credit_score",
        "account_status",
        F.col("late_payments").alias("late_payment_count"),
        F.col("missed_payments").alias("missed_payment_count"),
        dollars(F.col("past_due")).alias("total_amount_past_due"),
        "total_payments",
        _rate().alias("delinquency_rate"),
    )


def delinquency_by_loan_type(book: LoanBook) -> DataFrame:
    """M2: measures per loan type over loans with payments; members play no part.

    Loans are first reduced to one row per id and type on the join's own partitioning, which makes the distinct count a
    plain count.
    """
    measures = ("total_payments", "late_payments", "past_due")
    if book.loan_totals is not None:
        per_type = book.loan_totals.groupBy("loan_type").agg(F.count_if(F.col("first_of_type") == 1).alias("total_loans"), *sum_measures(measures))
    else:
        loans = book.with_stats(book.loans.select("loan_id", "loan_type"))
        per_loan = loans.groupBy("loan_id", "loan_type").agg(*sum_measures(measures))
        per_type = per_loan.groupBy("loan_type").agg(F.count("loan_id").alias("total_loans"), *sum_measures(measures))
    return per_type.select(
        "loan_type",
        "total_loans",
        "late_payments",
        "total_payments",
        _rate().alias("delinquency_rate_pct"),
        dollars(F.col("past_due")).alias("amount_at_risk"),
    ).transform(worst_first, "loan_type")


def monthly_delinquency_trend(book: LoanBook) -> DataFrame:
    """M3: payments and late payments per due month. No join: payments of unknown loans count."""
    if book.activity is None:
        per_month = book.payments.groupBy(due_month(F.col("due_date")).alias("month")).agg(*payment_counts())
    else:
        per_month = book.activity.groupBy("month").agg(*activity_counts())
    return per_month.select(
        "month", "total_payments", "late_payments", _rate().alias("delinquency_rate_pct")
    ).orderBy("month")


def _by_member_group(book: LoanBook, group: Column, name: str) -> DataFrame:
    """Members with payments, of every account status, grouped by a member column; worst rate first."""
    measures = ("total_payments", "late_payments")
    members = book.members.select("member_id", group.alias(name)).join(member_rollup(book), "member_id")
    grouped = members.groupBy(name).agg(F.count("member_id").alias("member_count"), *sum_measures(measures))
    return grouped.select(
        name, "member_count", "late_payments", "total_payments", _rate().alias("delinquency_rate_pct")
    ).transform(worst_first, name)


def delinquency_by_credit_tier(book: LoanBook) -> DataFrame:
    """M4: measures per credit band."""
    return _by_member_group(book, credit_band(F.col("credit_score")), "credit_tier")


def delinquency_by_city(book: LoanBook) -> DataFrame:
    """M5: measures per city."""
    return _by_member_group(book, F.col("city"), "city")


def member_loan_summary(book: LoanBook) -> DataFrame:
    """M6: measures per member and loan (A8). Equal copies of a loan share one row and add up.

    The grouping that adds up copies works on the partitioning of the join with the statistics and shuffles nothing.
    """
    keys = ("member_id", "member_name", "loan_id", *LOAN_SUMMARY_COLUMNS)
    if book.loan_totals is not None:
        # copies are added up already
        measured = book.with_members(book.loan_totals, "first_name", "last_name").withColumn("member_name", _member_name())
    else:
        loans = book.loans.select("loan_id", "member_id", *LOAN_SUMMARY_COLUMNS)
        owned = book.with_members(loans, "first_name", "last_name").select(
            "loan_id", "member_id", _member_name(), *LOAN_SUMMARY_COLUMNS
        )
        measured = book.with_stats(owned).groupBy(*keys).agg(*sum_measures())
    return measured.select(
        *keys,
        "total_payments",
        "late_payments",
        "missed_payments",
        dollars(F.col("past_due")).alias("amount_past_due"),
        _rate().alias("loan_delinquency_rate"),
    )


def detail_measures() -> dict[str, Column]:
    """The columns of a payment detail row that follow from its others."""
    return {"shortfall": shortfall(), "days_late": days_late(F.col("payment_date"), F.col("due_date"))}


def _payment_detail(book: LoanBook, payments: DataFrame, *extra: str) -> DataFrame:
    owners = book.with_members(book.loans.select("loan_id", "loan_type", "member_id"), "first_name", "last_name")
    measures = detail_measures()
    return join_unique(payments, owners, "loan_id", book.hot_loans).select(
        "member_id",
        _member_name(),
        "loan_id",
        "loan_type",
        "payment_id",
        "due_date",
        "payment_date",
        "expected_amount",
        "actual_amount",
        measures["shortfall"].alias("shortfall"),
        "payment_status",
        measures["days_late"].alias("days_late"),
        *extra,
    )


def payment_detail(book: LoanBook) -> DataFrame:
    """M7: every payment of a known member's loan, with its shortfall and days late.

    Loans meet members first, so payments are shuffled once, by loan. Both sides of that join are plain shuffles, which
    lets the adaptive skew split take a loan with very many payments apart.
    """
    return _payment_detail(book, book.payments)


def with_place(scan: DataFrame) -> DataFrame:
    """Add each row's place in a file scan, for ``by_member_and_due_date``."""
    return scan.withColumn("_place", F.monotonically_increasing_id())


def by_member_and_due_date(placed: DataFrame) -> DataFrame:
    """Sort payment detail rows by member and due date (O3).

    A range-partitioned sort. The last key is the row's place in a scan, so that neither one member's payments nor equal
    copies of one payment have to share a range, and a repeated task finds the same places again.
    """
    return placed.orderBy("member_id", "due_date", "loan_id", "payment_id", "_place").drop("_place")


def sorted_detail(detail: DataFrame) -> DataFrame:
    """The rows of a stored ``payment_detail`` by member and due date. What follows from other columns isn't moved."""
    measures = detail_measures()
    return by_member_and_due_date(with_place(detail.drop(*measures))).withColumns(measures).select(*detail.columns)


def sorted_payment_detail(book: LoanBook) -> DataFrame:
    """M7 by member and due date, placed by the payments scan."""
    return by_member_and_due_date(_payment_detail(book, with_place(book.payments), "_place"))


def placed_payment_detail(book: LoanBook) -> DataFrame:
    """M7 with ``due_month`` and each payment's place in the payments scan, as it is laid out in storage."""
    rows = _payment_detail(book, with_place(book.payments), "_place")
    return rows.withColumn("due_month", due_month(F.col("due_date")))


def of_month(book: LoanBook, month: str | None) -> LoanBook:
    """The book with the payments due in one month alone."""
    return replace(book, payments=book.payments.where(due_month(F.col("due_date")).eqNullSafe(F.lit(month))), stats=None, activity=None, loan_totals=None, totals=None)


#: Columns of the monthly status, and the payment status that each counts.
STATUS_COLUMNS = {"on_time": V.ON_TIME, "late": V.LATE, "missed": V.MISSED, "partial": V.PARTIAL}


def monthly_status_of_detail(detail: DataFrame) -> DataFrame:
    """``member_monthly_status`` from a stored ``payment_detail``, which has the same payments with their members already.

    Its files hold a member's payments of a month together, so that all but one row of each is combined before the shuffle.
    """
    counts = [F.count_if(F.coalesce(F.col("payment_status") == status, F.lit(False))).alias(name) for name, status in STATUS_COLUMNS.items()]
    return detail.groupBy("member_id", F.col("due_month").alias("month")).agg(*counts)


def member_monthly_status(book: LoanBook) -> DataFrame:
    """Payments per member, due month and status. Other statuses add no column but keep their month.

    What is joined with the loans is ``loan_activity``, in which a loan's payments of one month and status are one row.
    """
    owners = book.with_members(book.loans.select("loan_id", "member_id"))
    counts = [rows_where(F.col("payment_status") == status).alias(name) for name, status in STATUS_COLUMNS.items()]
    activity = book.payment_activity().select("loan_id", "month", "payment_status", "rows")
    return activity.join(owners, "loan_id").groupBy("member_id", "month").agg(*counts)
