"""The full refresh: raw files in, cleaned tables, marts, scores, reports and CSV exports out."""

from collections.abc import Callable, Sequence
from concurrent.futures import Executor, ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from lendrisk import fixed_values as V
from lendrisk.functions.measures import due_month
from lendrisk.operators.rollups import stats_of_activity
from lendrisk.plans import marts, quality, scoring
from lendrisk.plans.book import LoanBook
from lendrisk.sources.clustered import Clustered
from lendrisk.sources.raw import SPARED_COLUMNS, RawTables, raw_tables, read_raw, read_raw_checked, register
from lendrisk.sources.sinks import export_tables
from lendrisk.sources.store import Draft, TableStore, shuffles_removed

# Row order of the exported files; the others have none.
EXPORT_ORDER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "member_delinquency_scored": scoring.by_risk,
    "delinquency_by_loan_type": partial(marts.worst_first, key="loan_type"),
    "monthly_delinquency_trend": lambda df: df.orderBy("month"),
    "delinquency_by_credit_tier": partial(marts.worst_first, key="credit_tier"),
    "delinquency_by_city": partial(marts.worst_first, key="city"),
    "payment_detail": lambda df: marts.sorted_detail(df.drop("due_month")),
}


# Independent tables written at the same time, so that small ones fill the cores a large one leaves idle.
WRITERS = 4


def summary_layout(path: str, schema: T.StructType) -> Clustered:
    """How ``member_loan_summary`` is stored: by member."""
    return Clustered(path, "member_id", schema, ("loan_id",))


def detail_layout(path: str, schema: T.StructType) -> Clustered:
    """How ``payment_detail`` is stored: a folder per due month, by member within it. ``_place`` spreads equal copies."""
    derived = {**marts.detail_measures(), "due_month": due_month(F.col("due_date"))}
    return Clustered(path, "member_id", schema, ("due_date", "loan_id", "payment_id", "_place"), "due_month", derived)


def stored_summary(store: TableStore) -> Clustered:
    """The last version's ``member_loan_summary``."""
    entry = store.entries()["member_loan_summary"]
    return summary_layout(f"{store.directory}/{entry.path}".removesuffix("/rows"), entry.schema)


def stored_detail(store: TableStore) -> Clustered:
    """The last version's ``payment_detail``."""
    entry = store.entries()["payment_detail"]
    return detail_layout(f"{store.directory}/{entry.path}".removesuffix("/rows"), entry.schema)


def replace_month(detail: Clustered, book: LoanBook, month: str | None, blocks: int | None = None) -> DataFrame:
    """Make one month of a stored ``payment_detail`` anew from ``book`` and leave the others as they are."""
    book = marts.of_month(book, month)
    return detail.rewrite(marts.placed_payment_detail(book), blocks, book.payments.count() if blocks else 0)


@dataclass(frozen=True)
class StoredResults:
    """Result tables as stored, by name, the row counts of their exports, and what was counted while they were written."""

    book: LoanBook
    tables: dict[str, DataFrame]
    exported: DataFrame
    counted: dict[str, dict[str, int]]
    store: TableStore


@dataclass(frozen=True)
class RefreshReport:
    """What a run reports. All five tables are small; ``rejects`` has what reading raw CSV could not use, if that was read."""

    loaded: DataFrame
    quality: DataFrame
    highest_delinquency: DataFrame
    risk_tiers: DataFrame
    exported: DataFrame
    store: TableStore
    rejects: DataFrame | None = None


def store_results(book: LoanBook, directory: str, scheme: str = "code", *, blocks: int | None = None) -> StoredResults:
    """Store every mart as a new version of the tables below ``directory`` and export nine of them below ``<directory>/export``.

    Cleaned tables and the per-loan activity and statistics are stored first, so each mart starts from plain scans, payments
    are scanned once for all that rolls up from them, loans meet their statistics once and members' totals are made once for the
    marts that start from them, a step's shuffles are removed when it has ended, the monthly status is counted over the stored detail, and a lost executor costs no more than the running step. Readers find the
    old version until the last table is there (``sources.store``). The exports are made from the new version then; they sort
    stored tables, as a range sort reads its input twice, and this way that is a scan and not a join. ``blocks`` is the number
    of ranges that the tables stored by member are cut into, or the least if they have very many rows.
    """
    spark = book.payments.sparkSession
    with shuffles_removed(spark), ThreadPoolExecutor(WRITERS) as pool:
        draft = TableStore(spark, directory).begin()
        return _finish(pool, draft, _fill(pool, draft, book, scheme, blocks))


def store_tables(book: LoanBook, directory: str, scheme: str = "code", *, blocks: int | None = None) -> TableStore:
    """``store_results`` without the exports."""
    spark = book.payments.sparkSession
    with shuffles_removed(spark), ThreadPoolExecutor(WRITERS) as pool:
        draft = TableStore(spark, directory).begin()
        _fill(pool, draft, book, scheme, blocks)
    draft.commit()
    return draft.store


def _fill(pool: Executor, draft: Draft, book: LoanBook, scheme: str, blocks: int | None) -> tuple[LoanBook, dict[str, dict[str, int]]]:
    """Write all tables of a version; returns the stored book and what was counted."""
    counted: dict[str, dict[str, int]] = {}

    def store(tables: dict[str, DataFrame], metrics: dict[str, list[Column]] | None = None) -> dict[str, DataFrame]:
        def write(name: str) -> DataFrame:
            stored, counted[name] = draft.write(name, tables[name], *(metrics or {}).get(name, ()))
            return stored

        return dict(zip(tables, pool.map(write, tables)))

    inputs = store(
        {"members_clean": book.members, "loans_clean": book.loans, "payments_clean": book.payments},
        {"members_clean": quality.clean_member_measures()},
    )
    book = replace(book, members=inputs["members_clean"], loans=inputs["loans_clean"], payments=inputs["payments_clean"])
    book = replace(book, activity=store({"loan_activity": book.payment_activity()})["loan_activity"])
    book = replace(book, stats=store({"loan_payment_stats": stats_of_activity(book.activity)})["loan_payment_stats"])
    book = replace(book, loan_totals=draft.step("loan_rollup", marts.loan_rollup(book)))
    book = replace(book, totals=draft.step("member_rollup", marts.member_rollup(book)))
    delinquency = store({"member_delinquency": marts.member_delinquency(book)})["member_delinquency"]
    clustered = [
        pool.submit(_write_clustered, draft, "payment_detail", detail_layout, marts.placed_payment_detail(book), blocks, counted["payments_clean"]["rows"]),
        pool.submit(_write_clustered, draft, "member_loan_summary", summary_layout, marts.member_loan_summary(book), blocks, counted["loans_clean"]["rows"]),
    ]
    store({
        "member_delinquency_scored": scoring.member_delinquency_scored(delinquency, scheme),
        "delinquency_by_loan_type": marts.delinquency_by_loan_type(book),
        "monthly_delinquency_trend": marts.monthly_delinquency_trend(book),
        "delinquency_by_credit_tier": marts.delinquency_by_credit_tier(book),
        "delinquency_by_city": marts.delinquency_by_city(book),
    })
    detail, _ = (done.result() for done in clustered)
    store({"member_monthly_status": marts.monthly_status_of_detail(detail)})
    return book, counted


def _write_clustered(
    draft: Draft, name: str, layout: Callable[[str, T.StructType], Clustered], df: DataFrame, blocks: int | None, about: int
) -> DataFrame:
    table = layout(draft.folder(f"tables/{name}"), df.drop("_place").schema)
    table.write(df, blocks, about)
    rows = table.files(df.sparkSession).agg(F.sum("rows")).first()[0] or 0
    return draft.add(name, table.schema, rows, f"{draft.slot}/tables/{name}/rows")


def _finish(pool: Executor, draft: Draft, filled: tuple[LoanBook, dict[str, dict[str, int]]]) -> StoredResults:
    """Commit the version and export it."""
    draft.commit()
    book, counted = filled
    tables = draft.store.tables(draft.version)
    exports = {name: EXPORT_ORDER.get(name, lambda df: df)(tables[name]) for name in V.EXPORTED_TABLES}
    exported = export_tables(exports, f"{draft.store.directory}/export", pool, first=EXPORT_ORDER)
    return StoredResults(book, tables, exported, counted, draft.store)


def full_refresh(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    *,
    file_format: str = "csv",
    canonical_types: bool = False,
    scheme: str = "code",
    null_tokens: Sequence[str] = V.NULL_TOKENS,
    spared_columns: Sequence[str] = SPARED_COLUMNS,
    blocks: int | None = None,
) -> RefreshReport:
    """Read the raw tables below ``raw_dir``, write parquet tables and CSV exports below ``out_dir`` (full refresh, S7).

    Raw CSV is parsed once and stored columnar, with what could not be used of it beside; ``null_tokens`` and ``spared_columns``
    say what counts as missing in it. Every raw table is read once more, to be cleaned, and nothing is read only to be
    counted: the reports' numbers are observed while tables are written. Afterwards every table can be queried by name in the
    session. All tables of a run appear together when it is done; one that stops before leaves the last run's. ``out_dir``
    must be reachable by every executor.
    """
    with shuffles_removed(spark), ThreadPoolExecutor(WRITERS) as pool:
        draft = TableStore(spark, out_dir).begin()
        rejected: dict[str, dict[str, int]] = {}
        if file_format == "csv":
            checked = read_raw_checked(spark, raw_dir, null_tokens=null_tokens, spared_columns=spared_columns)

            def keep(name: str) -> DataFrame:
                stored, seen = draft.write(name, checked[name], *quality.reject_measures())
                rejected[name.removeprefix("raw_")] = {k: seen[k] for k in ("malformed_records", "unreadable_cells")}
                return stored

            raw = raw_tables(dict(zip(checked, pool.map(keep, checked))))
        else:
            raw = read_raw(spark, raw_dir, file_format)
            # rows of members are counted where no shuffle can make a task count twice
            raw = replace(raw, members=draft.write("raw_members", raw.members)[0])
        seen = {"loans": Observation(), "payments": Observation()}
        rows = F.count(F.lit(1)).alias("rows")
        watched = replace(
            raw,
            loans=raw.loans.observe(seen["loans"], rows, *quality.raw_loan_measures()),
            payments=raw.payments.observe(seen["payments"], rows, *quality.raw_payment_measures()),
        )
        book, counted = _fill(pool, draft, LoanBook.from_raw(watched, canonical_types=canonical_types), scheme, blocks)
        results = _finish(pool, draft, (book, counted))
    register({**raw.named(), **{name: table for name, table in results.tables.items() if not name.startswith("raw_")}})

    found = {name: dict(o.get) for name, o in seen.items()}
    loaded = {
        "raw_members": draft.entries["raw_members"].rows - rejected.get("members", {}).get("malformed_records", 0),
        "raw_loans": found["loans"].pop("rows"),
        "raw_payments": found["payments"].pop("rows"),
    }
    members = {k: v for k, v in counted["members_clean"].items() if k != "rows"}
    members["duplicate_rows_removed"] = loaded["raw_members"] - members["total_clean_members"]
    measures = {"members": members, **found, "delinquency": {"members_flagged": counted["member_delinquency"]["rows"]}}
    for name, more in rejected.items():
        measures[name] = {**measures[name], **more}
    delinquency = results.tables["member_delinquency"]
    return RefreshReport(
        loaded=spark.createDataFrame(list(loaded.items()), "table string, rows bigint"),
        quality=quality.observed_report(spark, measures),
        highest_delinquency=quality.highest_delinquency(delinquency),
        risk_tiers=scoring.risk_tier_counts(results.tables["member_delinquency_scored"], scheme),
        exported=results.exported,
        store=results.store,
        rejects=raw.rejects,
    )
