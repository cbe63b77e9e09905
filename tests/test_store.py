"""Versions behind a manifest, tables laid out by member and month, rejects, typed exports and reports made while writing."""

import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from helpers import BruteForce, as_set, messy_data, plan_text, rows
from pyspark.sql import functions as F
from test_sources import write_raw

from lendrisk import fixed_values as V
from lendrisk.__main__ import main
from lendrisk.catalog.queries import Opened
from lendrisk.plans import drill, marts, quality, refresh
from lendrisk.plans.book import LoanBook
from lendrisk.sources.clustered import Clustered, complete
from lendrisk.sources.raw import read_csv, read_csv_checked, read_raw, rejected_cells, usable_rows
from lendrisk.sources.sinks import export_csv, export_tables, read_export
from lendrisk.sources.store import REMOVE_SHUFFLES, TableStore, shuffles_removed


def files_read(df):
    """How many files the scans of a query read, from their metrics."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.metrics().contains("numFiles"):
            total += node.metrics().apply("numFiles").value()
        plan = getattr(node, "plan", None) if "QueryStage" in node.getClass().getSimpleName() else None
        todo += [plan()] if plan else []
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return total


# --- manifest ---------------------------------------------------------------------------------------------------------


def test_readers_see_a_whole_version(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.version() == 0 and store.manifests().count() == 0
    for n in (3, 5, 7):
        draft = store.begin()
        draft.write("a", spark.range(n))
        before = store.version()
        draft.write("b", spark.range(2 * n).toDF("x"))
        assert store.version() == before  # not seen yet
        draft.commit()
        assert {name: t.count() for name, t in store.tables().items()} == {"a": n, "b": 2 * n}
    assert store.version() == 3
    assert store.table("a", 2).count() == 5
    with pytest.raises(ValueError, match="isn't there"):
        store.entries(1)


def test_a_run_that_stops_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    data = messy_data(21)
    source, out = tmp_path / "raw", tmp_path / "out"
    source.mkdir()
    write_raw(source, data)
    refresh.full_refresh(spark, str(source), str(out))
    old = {name: as_set(t) for name, t in TableStore(spark, str(out)).tables().items() if name == "delinquency_by_city"}
    later = messy_data(22)
    write_raw(source, later)

    def broken(*_):
        raise RuntimeError("stopped between two tables")

    with monkeypatch.context() as patch:
        patch.setattr(marts, "delinquency_by_city", broken)
        with pytest.raises(RuntimeError, match="between two tables"):
            refresh.full_refresh(spark, str(source), str(out))
    store = TableStore(spark, str(out))
    assert store.version() == 1 and as_set(store.table("delinquency_by_city")) == old["delinquency_by_city"]
    assert store.table("members_clean").count() == len(BruteForce(**data).members)
    for entry in store.entries().values():
        assert store.read(entry).count() == entry.rows
    # the next run takes the same slot and finishes
    report = refresh.full_refresh(spark, str(source), str(out))
    assert report.store.version() == 2 and report.store.table("payment_detail").count() == len(BruteForce(**later).joined)


def test_two_runs_at_once_cannot_both_commit(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    one, two = store.begin(), store.begin()
    for draft in (one, two):
        draft.write("a", spark.range(1))
    one.commit()
    with pytest.raises(Exception, match="already exists"):
        two.commit()


def test_register_and_metrics(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    draft = store.begin()
    _, seen = draft.write("numbers_of_a_test", spark.range(10), F.sum("id").alias("total"))
    draft.commit()
    store.register()
    assert seen == {"rows": 10, "total": 45} and spark.table("numbers_of_a_test").count() == 10


# --- layout -----------------------------------------------------------------------------------------------------------


def test_one_member_reads_few_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 4).select(F.concat(F.lit("M"), F.lpad((F.col("id") % 997).cast("string"), 4, "0")).alias("member_id"), "id")
    table = Clustered(str(tmp_path / "t"), "member_id", df.schema, ("id",))
    assert as_set(table.write(df, 20)) == as_set(df)
    n = table.files(spark).count()
    assert n == 20 and complete(table, spark)
    found = table.lookup(spark, "M0500")
    assert as_set(found) == as_set(df.where("member_id = 'M0500'")) and files_read(found) <= 2
    assert files_read(table.read(spark)) == n
    assert table.lookup(spark, "nobody").count() == 0 and files_read(table.lookup(spark, "nobody")) == 0


def test_ranges_grow_in_number_and_not_in_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("lendrisk.sources.clustered.RANGE_ROWS", 250)
    df = spark.range(0, 4000, 1, 4).select((F.col("id") % 997).cast("string").alias("k"), "id")
    table = Clustered(str(tmp_path / "t"), "k", df.schema, ("id",))
    assert as_set(table.write(df, 4, 4000)) == as_set(df)
    sizes = [r["rows"] for r in rows(table.files(spark))]
    assert len(sizes) == 16 and max(sizes) < 2 * 250
    table.write(df, 20, 4000)
    assert table.files(spark).count() == 20


def test_a_hot_member_spans_files(spark, tmp_path):
    df = spark.range(0, 3000, 1, 4).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    table = Clustered(str(tmp_path / "t"), "k", df.schema, ("id",))
    table.write(df, 12)
    sizes = [r["rows"] for r in rows(table.files(spark))]
    assert max(sizes) < 3000 / 6 and table.lookup(spark, "hot").count() == 1000


def test_one_month_is_read_and_replaced_alone(spark, tmp_path, make_raw):
    book = LoanBook.from_raw(make_raw(**messy_data(23)))
    placed = marts.placed_payment_detail(book)
    detail = refresh.detail_layout(str(tmp_path / "d"), placed.drop("_place").schema)
    wrong = F.when(F.col("due_date").startswith("2022-03"), 0.25).otherwise(F.col("actual_amount"))
    stale = LoanBook(book.members, book.loans, book.payments.withColumn("actual_amount", wrong))
    detail.write(marts.placed_payment_detail(stale), 6)
    month = detail.read(spark).where("due_month = '2022-03'")
    names = {r["file"] for r in rows(detail.files(spark).where("due_month = '2022-03'"))}
    assert files_read(month) == len(names) < detail.files(spark).count()

    def others():
        return {(r["due_month"], r["file"]) for r in rows(detail.files(spark).where("due_month <> '2022-03'"))}

    before = others()
    refresh.replace_month(detail, book, "2022-03", 2)
    assert others() == before and complete(detail, spark)
    assert names.isdisjoint({r["file"] for r in rows(detail.files(spark).where("due_month = '2022-03'"))})
    assert as_set(detail.read(spark).drop("due_month")) == as_set(marts.payment_detail(book))
    member = rows(marts.payment_detail(book))[0]["member_id"]
    of_month = drill.stored_member_payments(spark, detail, member, "2022-03").drop("due_month")
    assert as_set(of_month) == as_set(marts.payment_detail(book).where(F.col("member_id") == member).where("due_date like '2022-03%'"))


def test_totals_and_status_over_stored_tables(spark, tmp_path, make_raw):
    book = LoanBook.from_raw(make_raw(**messy_data(25)))
    store = refresh.store_tables(book, str(tmp_path), blocks=3)
    assert "member_rollup" not in store.entries()
    assert as_set(store.table("member_monthly_status")) == as_set(marts.member_monthly_status(book))
    assert store.table("member_monthly_status").schema == marts.member_monthly_status(book).schema
    for mart in (marts.member_delinquency, marts.delinquency_by_credit_tier, marts.delinquency_by_city):
        assert as_set(store.table(mart.__name__)) == as_set(mart(book))


def shuffle_files(spark):
    """How many shuffle files the session has on disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def test_a_run_leaves_no_shuffles(spark, tmp_path, make_raw):
    book = LoanBook.from_raw(make_raw(**messy_data(32)))
    before, setting = shuffle_files(spark), spark.conf.get(REMOVE_SHUFFLES)
    store = refresh.store_results(book, str(tmp_path), blocks=3).store
    assert spark.conf.get(REMOVE_SHUFFLES) == setting
    for _ in range(50):  # they are removed in the background
        if shuffle_files(spark) > before:
            time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert store.table("payment_detail").count() == marts.payment_detail(book).count()
    with pytest.raises(RuntimeError), shuffles_removed(spark):
        raise RuntimeError("a step failed")
    assert spark.conf.get(REMOVE_SHUFFLES) == setting


def test_derived_columns_are_not_moved(spark, tmp_path):
    df = spark.range(0, 300, 1, 3).select("id", (F.col("id") % 7).cast("string").alias("k"), F.concat(F.lit("p"), F.col("id") % 2).alias("part"), (F.col("id") * 2).alias("twice"))
    derived = {"twice": F.col("id") * 2, "part": F.concat(F.lit("p"), F.col("id") % 2)}
    table = Clustered(str(tmp_path / "t"), "k", df.schema, ("id",), "part", derived)
    # what is derived is worked out of the columns it follows from, wherever the rows come from
    assert as_set(table.write(df.withColumn("twice", F.lit(-1).cast("bigint")), 4).select(df.columns)) == as_set(df)
    assert complete(table, spark) and {r["part"] for r in rows(table.files(spark))} == {"p0", "p1"}
    table.rewrite(df.where("part = 'p1'"), 2)
    assert as_set(table.read(spark).select(df.columns)) == as_set(df) and complete(table, spark)


def test_a_stored_detail_is_sorted_by_what_is_moved(spark, make_raw):
    detail = marts.payment_detail(LoanBook.from_raw(make_raw(**messy_data(33)))).localCheckpoint()
    found = marts.sorted_detail(detail)
    assert found.columns == detail.columns and as_set(found) == as_set(detail)
    keys = ("member_id", "due_date", "loan_id", "payment_id")
    whole = rows(marts.by_member_and_due_date(marts.with_place(detail)))
    assert [[r[k] for k in keys] for r in rows(found)] == [[r[k] for k in keys] for r in whole]
    plan = plan_text(found)
    assert plan.index("shortfall") < plan.index("Exchange") and "shortfall" not in plan[plan.index("Exchange"):plan.index("Scan")]


def test_marts_from_loans_with_their_statistics(spark, tmp_path, make_raw):
    data = messy_data(34)
    data["loans"] += data["loans"][:20] + [{**row, "loan_type": None} for row in data["loans"][:3]] + [{**row, "member_id": None} for row in data["loans"][3:6]]
    book = LoanBook.from_raw(make_raw(**data))
    marts.loan_rollup(book).write.parquet(str(tmp_path / "r"))
    rolled = replace(book, loan_totals=spark.read.parquet(str(tmp_path / "r")))
    for mart in (marts.member_rollup, marts.delinquency_by_loan_type, marts.member_loan_summary, marts.member_delinquency, marts.delinquency_by_city):
        assert mart(rolled).dtypes == mart(book).dtypes and as_set(mart(rolled)) == as_set(mart(book))
    by_type = marts.delinquency_by_loan_type
    assert by_type(rolled).schema["total_loans"] == by_type(book).schema["total_loans"]
    assert "Join" not in plan_text(marts.delinquency_by_loan_type(rolled))


def test_drill_through_over_the_store(spark, tmp_path, make_raw):
    book = LoanBook.from_raw(make_raw(**messy_data(24)))
    store = refresh.store_tables(book, str(tmp_path), blocks=5)
    for member in ("M01", "M02", "nobody"):
        loans = drill.stored_member_loans(spark, refresh.stored_summary(store), member)
        assert rows(loans) == rows(drill.member_drill_loans(book, member))
        payments = drill.stored_member_payments(spark, refresh.stored_detail(store), member).drop("due_month")
        assert as_set(payments) == as_set(drill.member_drill_payments(book, member))


# --- rejects ----------------------------------------------------------------------------------------------------------


LOANS = (
    "loan_id,member_id,loan_type,original_amount,interest_rate,term_months,origination_date,loan_status\n"
    "L1,M1,Mortgage,100,3.5,60,2020-01-01,Current\n"
    "L2,M1\n"
    'L3,M1,"Auto, ""x""",1e3,N/A,60.0,2020-01-01,Current\n'
    "L4,M1,Mortgage,100,3.5,60,2020-01-01,Current,extra\n"
    "L5,M1,Mortgage,1OO,5%,60.5,2020-01-01,Current\n"
    "\n"
    "L6,M1,,,,,,\n"
)


def test_rejects(spark, tmp_path):
    path = tmp_path / "raw_loans.csv"
    path.write_text(LOANS)
    checked = read_csv_checked(spark, str(path), V.RAW_LOANS)
    found = rows(rejected_cells(checked, "raw_loans").orderBy("place", "column"))
    assert [(r["key"], r["column"], r["text"]) for r in found] == [
        (None, None, "L2,M1"),
        (None, None, "L4,M1,Mortgage,100,3.5,60,2020-01-01,Current,extra"),
        ("L5", "interest_rate", "5%"), ("L5", "original_amount", "1OO"), ("L5", "term_months", "60.5"),
    ]
    assert all(r["source"] == "raw_loans" and r["file"].endswith("raw_loans.csv") for r in found)
    kept = rows(usable_rows(checked).orderBy("loan_id"))
    assert [(r["loan_id"], r["original_amount"], r["interest_rate"], r["term_months"]) for r in kept] == [
        ("L1", 100.0, 3.5, 60), ("L3", 1000.0, None, 60), ("L5", None, None, None), ("L6", None, None, None),
    ]
    assert as_set(read_csv(spark, str(path), V.RAW_LOANS).select("loan_id")) == [("L1",), ("L3",), ("L5",), ("L6",)]
    assert read_csv(spark, str(path), V.RAW_LOANS).count() == 4  # whatever columns are asked for


def test_rejects_are_counted(spark, tmp_path):
    data = messy_data(25)
    write_raw(tmp_path, {**data, "loans": []})
    (tmp_path / "raw_loans.csv").write_text(LOANS)
    raw = read_raw(spark, str(tmp_path))
    book = LoanBook.from_raw(raw)
    report = {(r["section"], r["measure"]): r["value"] for r in rows(quality.data_quality_report(raw, book, marts.member_delinquency(book)))}
    assert (report["loans", "malformed_records"], report["loans", "unreadable_cells"]) == (2, 3)
    assert (report["payments", "malformed_records"], report["members", "unreadable_cells"]) == (0, 0)
    assert report["loans", "missing_interest_rates"] == 3
    whole = refresh.full_refresh(spark, str(tmp_path), str(tmp_path / "out"))
    assert {(r["section"], r["measure"]): r["value"] for r in rows(whole.quality)} == report
    assert {r["table"]: r["rows"] for r in rows(whole.loaded)}["raw_loans"] == 4
    assert whole.rejects.count() == 5


def test_reports_read_no_table(spark, tmp_path):
    """A run's counts were made while it wrote: its reports scan nothing, and raw tables are read for cleaning alone."""
    write_raw(tmp_path, messy_data(26))
    report = refresh.full_refresh(spark, str(tmp_path), str(tmp_path / "out"))
    for table in (report.loaded, report.quality, report.exported):
        assert "FileScan" not in plan_text(table) and "Scan" in plan_text(table)


def test_tokens_reach_the_whole_run(spark, tmp_path, monkeypatch, capsys):
    data = messy_data(27)
    for row in data["members"]:
        row["city"] = "n.k." if row["city"] is None else row["city"]
    write_raw(tmp_path, data)
    monkeypatch.setattr("sys.argv", ["lendrisk", str(tmp_path), str(tmp_path / "out"), "--null-token", "", "--null-token", "n.k.", "--spare", "city"])
    main()
    spared = TableStore(spark, str(tmp_path / "out")).table("members_clean")
    assert spared.where("city = 'n.k.'").count() > 0 and spared.where("phone = 'NA'").count() == 0
    refresh.full_refresh(spark, str(tmp_path), str(tmp_path / "out"), null_tokens=("", "n.k."))
    read = TableStore(spark, str(tmp_path / "out")).table("members_clean")
    assert read.where("city = 'n.k.'").count() == 0 and read.where("city is null").count() == spared.where("city = 'n.k.'").count()


# --- exports ----------------------------------------------------------------------------------------------------------


def test_export_keeps_types_and_tells_null_from_empty(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "", None, 25000000.5, True), (2, None, "", 1e-7, None), (None, ' "q", x ', "null", None, False), (4, "NA", " ", -0.125, True)],
        "n int, a string, b string, original_amount double, t boolean",
    )
    path = str(tmp_path / "e.csv")
    assert export_csv(df, path) == 4
    back = read_export(spark, path)
    assert back.dtypes == df.dtypes and as_set(back) == as_set(df)
    assert not json.loads(spark.read.text(f"{path}.schema").first()[0])["multiLine"]
    broken = df.withColumn("a", F.concat("a", F.lit("\r\nnext,\n")))
    export_csv(broken, path)
    assert as_set(read_export(spark, path)) == as_set(broken)
    export_csv(df.limit(0), path)
    assert read_export(spark, path).count() == 0


def test_exported_marts_come_back(spark, tmp_path, make_raw):
    book = LoanBook.from_raw(make_raw(**messy_data(28)))
    for name, mart in (("d", marts.payment_detail(book)), ("s", marts.member_loan_summary(book)), ("m", book.members)):
        export_csv(mart, str(tmp_path / name))
        assert as_set(read_export(spark, str(tmp_path / name))) == as_set(mart)


def test_sorted_tables_are_exported_before_the_others(spark, tmp_path, monkeypatch):
    done = []

    def slow(df, path, single=False):
        time.sleep(0.3 if path.endswith("c.csv") else 0)
        done.append(path.rpartition("/")[2])
        return export_csv(df, path, single)

    monkeypatch.setattr("lendrisk.sources.sinks.export_csv", slow)
    tables = {name: spark.range(n) for n, name in enumerate("abcd", 1)}
    with ThreadPoolExecutor(4) as pool:
        exported = export_tables(tables, str(tmp_path), pool, first={"c", "b"})
    assert set(done[:2]) == {"b.csv", "c.csv"}
    assert [(r["table"], r["rows"]) for r in rows(exported)] == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]


# --- order, hot keys, one pre-aggregate, data that can fail -------------------------------------------------------------


def test_marts_from_activity(spark, make_raw, tmp_path):
    book = LoanBook.from_raw(make_raw(**messy_data(29)))
    book.payment_activity().write.parquet(str(tmp_path / "activity"))
    active = replace(book, activity=spark.read.parquet(str(tmp_path / "activity")))
    assert as_set(active.payment_stats()) == as_set(book.payment_stats())
    for mart in (marts.monthly_delinquency_trend, marts.member_monthly_status, marts.member_delinquency):
        assert as_set(mart(active)) == as_set(mart(book))
    flagged = marts.member_delinquency(book)
    assert rows(drill.kpi_overview(active, flagged)) == rows(drill.kpi_overview(book, flagged))
    # what is joined with the loans is combined already
    plan = plan_text(marts.member_monthly_status(book))
    assert plan.index("Join") < plan.rindex("HashAggregate(keys=[loan_id")


def test_mapped_data_can_fail(spark):
    """Swapping the subtraction or dropping a join changes the marts over the provided tables."""
    book = Opened(spark, "/root/testdata/sf0.001").book
    swapped = book.payments.withColumns({"expected_amount": F.col("actual_amount"), "actual_amount": F.col("expected_amount")})
    for mart in (marts.delinquency_by_loan_type, marts.member_delinquency):
        assert as_set(mart(book)) != as_set(mart(replace(book, payments=swapped)))
    late = book.payments.where("payment_status = 'Late'")
    assert late.where("actual_amount < expected_amount").count() and late.where("actual_amount > expected_amount").count()
    assert book.payments.where("payment_status = 'Missed' and actual_amount > 0").count()
    assert book.payments.join(book.loans, "loan_id", "left_anti").count() and book.loans.join(book.members, "member_id", "left_anti").count()
    assert book.payments.where("payment_status is null or due_date is null or payment_id is null").count() > 3
    assert {"Default"} <= {r[0] for r in book.loans.select("loan_status").distinct().collect()}
    assert {"Home Equity", "Home equity"} <= {r[0] for r in book.loans.select("loan_type").distinct().collect()}
