"""Every named query: ``(spark, directory of the provided tables) -> DataFrame``. Each runs over its whole tables."""

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lendrisk import fixed_values as V
from lendrisk.functions.measures import credit_band, dollars, due_month
from lendrisk.functions.text import capitalize_first, null_if_in
from lendrisk.operators.cleaning import clean_loan_type, dedup_keep_first, missing_flag
from lendrisk.operators.ordering import with_position
from lendrisk.plans import drill, marts, quality, scoring
from lendrisk.plans.book import LoanBook
from lendrisk.plans.refresh import detail_layout, full_refresh, replace_month, store_results, store_tables, summary_layout
from lendrisk.sources.clustered import Clustered
from lendrisk.sources.provided import raw_from_provided
from lendrisk.sources.raw import INGEST_SEQ, RawTables, read_csv, read_raw, register, row_counts
from lendrisk.sources.sinks import export_csv, read_export, scratch_path, write_table
from lendrisk.sources.store import TableStore

Query = Callable[[SparkSession, str], DataFrame]
c = F.col


class Opened:
    """The provided tables, opened once for any number of queries."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.raw = raw_from_provided(spark, sf_dir)

    @cached_property
    def book(self) -> LoanBook:
        return LoanBook.from_raw(self.raw)

    @cached_property
    def split(self) -> LoanBook:
        """The book with the hot members and loans looked up, at any size of the tables."""
        return self.book.with_hot_keys(payments=True, min_rows=50, min_share=0.02)

    @cached_property
    def active(self) -> LoanBook:
        """The book with what its tables roll up from."""
        return replace(self.book, activity=self.book.payment_activity())


# --- sources and cleaning operators ---------------------------------------------------------------------------------


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw tables registered by name and counted."""
    tables = raw_from_provided(spark, sf_dir).named()
    register(tables)
    return row_counts({name: spark.table(name) for name in tables})


def normalize_names(raw: RawTables) -> DataFrame:
    """C3, F1-F4 on every raw member row."""
    first = capitalize_first(c("first_name"), trim=True)
    last = capitalize_first(c("last_name"), trim=True)
    return raw.members.select("ingest_seq", "member_id", first.alias("first_name"), last.alias("last_name"))


def null_tokens_members(raw: RawTables) -> DataFrame:
    """C8, C9 on every raw member row."""
    return raw.members.select(
        "ingest_seq",
        null_if_in(c("phone"), V.PHONE_PLACEHOLDERS).alias("phone"),
        null_if_in(c("email"), V.EMAIL_PLACEHOLDERS).alias("email"),
    )


def null_tokens_payments(raw: RawTables) -> DataFrame:
    """C10 on every raw payment row."""
    date = null_if_in(c("payment_date"), V.PAYMENT_DATE_PLACEHOLDERS)
    return raw.payments.select("payment_id", date.alias("payment_date"))


def missing_flags_members(raw: RawTables) -> DataFrame:
    """C6, C14 on every raw member row."""
    return raw.members.select(
        "ingest_seq", "credit_score", missing_flag(c("credit_score")).alias("credit_score_missing")
    )


def missing_flags_loans(raw: RawTables) -> DataFrame:
    """C7, C14."""
    return raw.loans.select("loan_id", "interest_rate", missing_flag(c("interest_rate")).alias("rate_missing"))


def abs_amounts_loans(raw: RawTables) -> DataFrame:
    """C11."""
    return raw.loans.select("loan_id", F.abs("original_amount").alias("original_amount"))


def abs_amounts_payments(raw: RawTables) -> DataFrame:
    """C12."""
    return raw.payments.select("payment_id", F.abs("actual_amount").alias("actual_amount"))


def normalize_loan_type(raw: RawTables) -> DataFrame:
    """C4."""
    return raw.loans.select("loan_id", clean_loan_type(c("loan_type")).alias("loan_type"))


def canonical_loan_type(raw: RawTables) -> DataFrame:
    """C4 with every word raised, the documented intent."""
    return raw.loans.select("loan_id", clean_loan_type(c("loan_type"), canonical=True).alias("loan_type"))


def normalize_status(raw: RawTables) -> DataFrame:
    """Payments per cleaned status."""
    status = capitalize_first(c("payment_status")).alias("payment_status")
    return raw.payments.groupBy(status).agg(F.count(F.lit(1)).alias("payments"))


def member_credit_bands(book: LoanBook) -> DataFrame:
    """F8: the credit band of every clean member."""
    return book.members.select("member_id", "credit_score", credit_band(c("credit_score")).alias("credit_tier"))


def loan_payment_stats(book: LoanBook) -> DataFrame:
    """A1, A3, A4 per loan, with money as it leaves the library."""
    return book.payment_stats().select(
        "loan_id", "total_payments", "late_payments", "missed_payments", dollars(c("past_due")).alias("past_due")
    )


def _write_raw_csv(raw: RawTables, directory: str, *names: str) -> None:
    for name in names:
        table = raw.named()[name]
        if name == "raw_members":
            table = table.orderBy(raw.member_order).drop(raw.member_order)
        export_csv(table, f"{directory}/{name}.csv")


def csv_ingest_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members written to CSV files and cleaned from them; "first" is the place in the files."""
    directory = scratch_path(spark, "csv-members")
    _write_raw_csv(raw_from_provided(spark, sf_dir), directory, "raw_members")
    members = read_csv(spark, f"{directory}/raw_members.csv", V.RAW_MEMBERS)
    # No loans or payments are needed to clean members.
    return LoanBook.from_raw(
        RawTables(members, spark.createDataFrame([], V.RAW_LOANS), spark.createDataFrame([], V.RAW_PAYMENTS)),
    ).members


def csv_ingest_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments written to CSV, read back, and the monthly trend made from them, which needs no other table."""
    directory = scratch_path(spark, "csv-raw")
    _write_raw_csv(raw_from_provided(spark, sf_dir), directory, "raw_payments")
    payments = read_csv(spark, f"{directory}/raw_payments.csv", V.RAW_PAYMENTS).drop(INGEST_SEQ)
    members = spark.createDataFrame([], V.RAW_MEMBERS).withColumn(INGEST_SEQ, F.lit(0))
    return marts.monthly_delinquency_trend(
        LoanBook.from_raw(RawTables(members, spark.createDataFrame([], V.RAW_LOANS), payments))
    )


# --- scoring, reports, drill-down -----------------------------------------------------------------------------------


def _scored(book: LoanBook, scheme: str = "code") -> DataFrame:
    return scoring.member_delinquency_scored(marts.member_delinquency(book), scheme)


#: The member that the drill-down queries show, as somebody would click on one in a dashboard.
CHOSEN_MEMBER = "MBR-000005"


def _quality(t: Opened) -> DataFrame:
    """M9."""
    return quality.data_quality_report(t.raw, t.book, marts.member_delinquency(t.book))


def _canonical(t: Opened) -> LoanBook:
    return LoanBook.from_raw(t.raw, canonical_types=True)


def population_ranges(book: LoanBook) -> DataFrame:
    """Lowest and highest value of each scored column over the flagged members."""
    return scoring.population_ranges(marts.member_delinquency(book)).select("ranges.*")


def risk_score_terms(book: LoanBook) -> DataFrame:
    """The four terms of every flagged member's score."""
    terms = scoring.risk_terms(marts.member_delinquency(book))
    return terms.select("member_id", "late_norm", "missed_norm", "amount_norm", "rate_norm")


def export_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine tables stored and exported, their rows counted on the way out and on reading back."""
    directory = scratch_path(spark, "export")
    book = LoanBook.from_raw(raw_from_provided(spark, sf_dir))
    exported = store_results(book, directory).exported
    read_back = row_counts({
        name: spark.read.options(header=True, escape='"').csv(f"{directory}/export/{name}.csv")
        for name in V.EXPORTED_TABLES
    })
    return exported.withColumnRenamed("rows", "rows_written").join(
        read_back.withColumnRenamed("rows", "rows_read"), "table"
    )


# --- order as data ----------------------------------------------------------------------------------------------------


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df``, stored in the shared folder and read back."""
    return write_table(df, scratch_path(df.sparkSession, "stored"))


def _placed(df: DataFrame, *order: Column | str) -> DataFrame:
    return with_position(df, *order, store=stored)


def _worst_first(df: DataFrame, key: str) -> DataFrame:
    return _placed(df, F.desc("delinquency_rate_pct"), F.desc(key))


def payment_detail_positions(book: LoanBook) -> DataFrame:
    """O3: every payment's place by member, due date, loan and payment."""
    return _placed(marts.payment_detail(book), *(F.asc_nulls_first(name) for name in ("member_id", "due_date", "loan_id", "payment_id", "payment_date", "expected_amount", "actual_amount")))


# --- stored tables ----------------------------------------------------------------------------------------------------

#: Ranges that the stored tables of the queries are cut into (more if they have very many rows), and the month that is read or replaced alone.
BLOCKS, CHOSEN_MONTH = 16, "1997-03"


def stored_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables that readers find after one whole run and one that stopped, as recorded and as read."""
    directory = scratch_path(spark, "store")
    book = LoanBook.from_raw(raw_from_provided(spark, sf_dir))
    store = store_tables(book, directory)
    store.begin().write("members_clean", book.members.limit(0))  # and no commit
    recorded = spark.createDataFrame([(e.table, e.rows) for e in store.entries().values()], "table string, rows_recorded bigint")
    return recorded.join(row_counts(TableStore(spark, directory).tables()).withColumnRenamed("rows", "rows_read"), "table")


def stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored members as a reader of the store finds them."""
    return store_tables(LoanBook.from_raw(raw_from_provided(spark, sf_dir)), scratch_path(spark, "store")).table("member_delinquency_scored")


def _exported(df: DataFrame) -> DataFrame:
    """A table written as CSV and read back with its types."""
    path = f"{scratch_path(df.sparkSession, 'values')}/table.csv"
    export_csv(df, path)
    return read_export(df.sparkSession, path)


def _stored_detail(book: LoanBook) -> Clustered:
    placed = marts.placed_payment_detail(book)
    detail = detail_layout(scratch_path(placed.sparkSession, "detail"), placed.drop("_place").schema)
    detail.write(placed, BLOCKS, book.payments.count())
    return detail


def member_loans_stored(book: LoanBook) -> DataFrame:
    """D3 over M6 stored by member: reads the files that may hold the member."""
    summary = marts.member_loan_summary(book)
    table = summary_layout(scratch_path(summary.sparkSession, "summary"), summary.schema)
    table.write(summary, BLOCKS, book.loans.count())
    return drill.stored_member_loans(summary.sparkSession, table, CHOSEN_MEMBER)


def member_payments_stored(book: LoanBook) -> DataFrame:
    """D3 over M7 stored by month and member."""
    spark = book.payments.sparkSession
    return drill.stored_member_payments(spark, _stored_detail(book), CHOSEN_MEMBER).drop("due_month")


def payment_detail_month(book: LoanBook) -> DataFrame:
    """M7 of one month, read from its folder alone."""
    return _stored_detail(book).read(book.payments.sparkSession).where(c("due_month") == CHOSEN_MONTH).drop("due_month")


def payment_detail_month_replaced(book: LoanBook) -> DataFrame:
    """M7 stored with one month's payments wrong, after that month alone was made anew."""
    wrong = F.when(due_month(c("due_date")) == CHOSEN_MONTH, F.lit(0.0)).otherwise(c("actual_amount"))
    detail = _stored_detail(replace(book, payments=book.payments.withColumn("actual_amount", wrong)))
    return replace_month(detail, book, CHOSEN_MONTH, BLOCKS).drop("due_month")


# --- raw text with what can't be used ---------------------------------------------------------------------------------


def _write_lines(table: DataFrame, schema: T.StructType, path: str, broken: Column, line: Column, **cells: Column) -> None:
    """Write a raw table as CSV text with ``cells`` in place of its own, and ``line`` for records that are ``broken``."""
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    whole = F.to_csv(F.struct(*(cells.get(f, c(f)).cast("string").alias(f) for f in schema.names)), options)
    text = F.when(broken, line).otherwise(whole)
    # every file begins with the header
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit(",".join(schema.names) + "\n")
    table.select(F.concat(F.when(first, header).otherwise(F.lit("")), text).alias("value")).write.text(path)


def _raw_with_rejects(spark: SparkSession, sf_dir: str) -> RawTables:
    """The raw tables by way of CSV text, in which some cells are no numbers and some records are too short or too long."""
    raw, directory = raw_from_provided(spark, sf_dir), scratch_path(spark, "rejects")
    never = F.lit(False)
    members = raw.members.orderBy(raw.member_order)
    _write_lines(members, V.RAW_MEMBERS, f"{directory}/raw_members.csv", never, F.lit(""),
                 credit_score=F.when(c("phone") == "N/A", "n.b.").otherwise(c("credit_score").cast("string")))
    _write_lines(raw.loans, V.RAW_LOANS, f"{directory}/raw_loans.csv", c("loan_type") == "home equity", F.concat_ws(",", "loan_id", "member_id"),
                 interest_rate=F.when(c("loan_status") == "Default", "5,5 %").otherwise(c("interest_rate").cast("string")))
    _write_lines(raw.payments, V.RAW_PAYMENTS, f"{directory}/raw_payments.csv", c("payment_status") == "MISSED",
                 F.concat(c("loan_id"), F.lit(",a,b,c,d,e,f,g")),
                 actual_amount=F.when(c("payment_status") == "PARTIAL", "half").otherwise(c("actual_amount").cast("string")))
    return read_raw(spark, directory)


def rejected_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records and cells that reading could not use."""
    return _raw_with_rejects(spark, sf_dir).rejects.select("source", "key", "column", "text")


def data_quality_report_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 with what reading could not use."""
    raw = _raw_with_rejects(spark, sf_dir)
    book = LoanBook.from_raw(raw)
    return quality.data_quality_report(raw, book, marts.member_delinquency(book))


def refresh_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run from CSV files; its report holds what was counted while tables were written."""
    directory = scratch_path(spark, "refresh")
    raw = raw_from_provided(spark, sf_dir)
    _write_raw_csv(raw, directory, *raw.named())
    report = full_refresh(spark, directory, f"{directory}/out")
    loaded = report.loaded.select(F.lit("loaded").alias("section"), c("table").alias("measure"), c("rows").alias("value"))
    return loaded.unionByName(report.quality)


# Queries over opened tables.
OPENED_QUERIES: dict[str, Callable[[Opened], DataFrame]] = {
    "dedup_members": lambda t: dedup_keep_first(t.raw.members, ["member_id"], t.raw.member_order),
    "normalize_names": lambda t: normalize_names(t.raw),
    "null_tokens_members": lambda t: null_tokens_members(t.raw),
    "null_tokens_payments": lambda t: null_tokens_payments(t.raw),
    "missing_flags_members": lambda t: missing_flags_members(t.raw),
    "missing_flags_loans": lambda t: missing_flags_loans(t.raw),
    "abs_amounts_loans": lambda t: abs_amounts_loans(t.raw),
    "abs_amounts_payments": lambda t: abs_amounts_payments(t.raw),
    "normalize_loan_type": lambda t: normalize_loan_type(t.raw),
    "canonical_loan_type": lambda t: canonical_loan_type(t.raw),
    "normalize_status": lambda t: normalize_status(t.raw),
    "members_clean": lambda t: t.book.members,
    "loans_clean": lambda t: t.book.loans,
    "payments_clean": lambda t: t.book.payments,
    "member_credit_bands": lambda t: member_credit_bands(t.book),
    "loan_payment_stats": lambda t: loan_payment_stats(t.book),
    "member_delinquency": lambda t: marts.member_delinquency(t.book),
    "member_delinquency_min12": lambda t: marts.member_delinquency(t.book, min_late=12),
    "delinquency_by_loan_type": lambda t: marts.delinquency_by_loan_type(t.book),
    "delinquency_by_canonical_loan_type": lambda t: marts.delinquency_by_loan_type(_canonical(t)),
    "monthly_delinquency_trend": lambda t: marts.monthly_delinquency_trend(t.book),
    "delinquency_by_credit_tier": lambda t: marts.delinquency_by_credit_tier(t.book),
    "delinquency_by_city": lambda t: marts.delinquency_by_city(t.book),
    "member_loan_summary": lambda t: marts.member_loan_summary(t.book),
    "payment_detail": lambda t: marts.payment_detail(t.book),
    "payment_detail_sorted": lambda t: marts.sorted_payment_detail(t.book),
    "population_ranges": lambda t: population_ranges(t.book),
    "risk_score_terms": lambda t: risk_score_terms(t.book),
    "member_delinquency_scored": lambda t: _scored(t.book),
    "member_delinquency_scored_documented_tiers": lambda t: _scored(t.book, "documented"),
    "risk_tier_counts": lambda t: scoring.risk_tier_counts(_scored(t.book)),
    "risk_tier_counts_documented": lambda t: scoring.risk_tier_counts(_scored(t.book, "documented"), "documented"),
    "data_quality_report": _quality,
    "highest_delinquency": lambda t: quality.highest_delinquency(marts.member_delinquency(t.book)),
    "kpi_overview": lambda t: drill.kpi_overview(t.book, marts.member_delinquency(t.book)),
    "member_detail_high_risk": lambda t: drill.member_detail(_scored(t.book), tier="High Risk"),
    "member_detail_city": lambda t: drill.member_detail(_scored(t.book), city="NATION_7", min_score=20.0),
    "member_drill_loans": lambda t: drill.member_drill_loans(t.book, CHOSEN_MEMBER),
    "member_drill_payments": lambda t: drill.member_drill_payments(t.book, CHOSEN_MEMBER),
    "member_monthly_status": lambda t: marts.member_monthly_status(t.book),
    "trend_from_activity": lambda t: marts.monthly_delinquency_trend(t.active),
    "kpi_from_activity": lambda t: drill.kpi_overview(t.active, marts.member_delinquency(t.book)),
    "loan_stats_from_activity": lambda t: loan_payment_stats(t.active),
    "loan_type_positions": lambda t: _worst_first(marts.delinquency_by_loan_type(t.book), "loan_type"),
    "credit_tier_positions": lambda t: _worst_first(marts.delinquency_by_credit_tier(t.book), "credit_tier"),
    "city_positions": lambda t: _worst_first(marts.delinquency_by_city(t.book), "city"),
    "month_positions": lambda t: _placed(marts.monthly_delinquency_trend(t.book), F.asc_nulls_first("month")),
    "risk_positions": lambda t: _placed(_scored(t.book), F.desc("risk_score"), "member_id"),
    "payment_detail_positions": lambda t: payment_detail_positions(t.book),
    "payment_detail_hot_keys": lambda t: marts.payment_detail(t.split),
    "member_loan_summary_hot_keys": lambda t: marts.member_loan_summary(t.split),
    "member_delinquency_hot_keys": lambda t: marts.member_delinquency(t.split),
    "export_values_payment_detail": lambda t: _exported(marts.payment_detail(t.book)),
    "export_values_member_loan_summary": lambda t: _exported(marts.member_loan_summary(t.book)),
    "member_loans_stored": lambda t: member_loans_stored(t.book),
    "member_payments_stored": lambda t: member_payments_stored(t.book),
    "payment_detail_month": lambda t: payment_detail_month(t.book),
    "payment_detail_month_replaced": lambda t: payment_detail_month_replaced(t.book),
}


def _open_and_run(query: Callable[[Opened], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return query(Opened(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "load_counts": load_counts,
    "csv_ingest_members": csv_ingest_members,
    "csv_ingest_trend": csv_ingest_trend,
    **{name: partial(_open_and_run, query) for name, query in OPENED_QUERIES.items()},
    "export_round_trip": export_round_trip,
    "stored_versions": stored_versions,
    "stored_scores": stored_scores,
    "rejected_cells": rejected_cells,
    "data_quality_report_rejects": data_quality_report_rejects,
    "refresh_quality": refresh_quality,
}
