"""One id with a third of all rows: the results stay whole and the work stays spread."""

import re

from helpers import as_set, plan_text, rows
from pyspark.sql import functions as F

from lendrisk.operators.cleaning import clean_members
from lendrisk.operators.skew import hot_keys, join_unique
from lendrisk.plans import drill, marts
from lendrisk.plans.book import LoanBook
from lendrisk.sources.raw import RawTables

N = 30_000


def skewed(spark, n=N):
    """A third of the members are copies of one, a third of the loans are one member's, a third of the payments one loan's."""
    third = F.col("id") % 3 == 0
    ids = spark.range(0, n, 1, 8)

    def key(prefix, parts):
        return F.when(third, F.lit(f"{prefix}0")).otherwise(F.concat(F.lit(prefix), (F.col("id") % parts).cast("string")))

    members = ids.select(
        F.col("id").alias("ingest_seq"), key("M", n).alias("member_id"), F.lit("ANN").alias("first_name"),
        F.lit(" lee").alias("last_name"), F.lit("01/15/2015").alias("join_date"),
        F.when(third, "Dallas").otherwise("Hurst").alias("city"), F.lit("TX").alias("state"),
        (F.col("id") % 500 + 350).cast("double").alias("credit_score"), F.lit("").alias("email"),
        F.lit("N/A").alias("phone"), F.lit("Active").alias("account_status"),
    )
    loans = ids.select(
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("loan_id"), key("M", n).alias("member_id"),
        F.lit("Auto Loan").alias("loan_type"), F.lit(1000.0).alias("original_amount"), F.lit(5.0).alias("interest_rate"),
        F.lit(12).cast("long").alias("term_months"), F.lit("2020-01-01").alias("origination_date"),
        F.lit("Current").alias("loan_status"),
    )
    payments = ids.select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("payment_id"), key("L", n).alias("loan_id"),
        F.lit("2023-01-10").alias("due_date"), F.lit("2023-01-15").alias("payment_date"),
        F.lit(100.0).alias("expected_amount"), F.lit(40.0).alias("actual_amount"),
        F.when(F.col("id") % 2 == 0, "LATE").otherwise("On Time").alias("payment_status"),
    )
    return RawTables(members, loans, payments)


def test_hot_keys(spark):
    raw = skewed(spark)
    assert hot_keys(raw.loans, ["loan_id", "member_id"], min_rows=1000) == {"loan_id": (), "member_id": ("M0",)}
    assert hot_keys(raw.loans, ["member_id"]) == {"member_id": ()}
    nulls = raw.loans.withColumn("member_id", F.lit(None).cast("string"))
    assert hot_keys(nulls, ["member_id"], min_rows=1000) == {"member_id": ()}


def test_join_unique_is_the_plain_join(spark):
    many = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("z", 5)], "k string, x int")
    one = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C"), (None, "N")], "k string, y string")
    plain = as_set(many.join(one, "k"))
    for hot in ((), ("a",), ("a", "b", "z", "none")):
        assert as_set(join_unique(many, one, "k", hot)) == plain


def test_hot_member_is_not_shuffled(spark, setting):
    """With the hot member joined apart, no shuffled partition of loans holds a third of them."""
    setting(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", shuffle__partitions="16")
    book = LoanBook.from_raw(skewed(spark), find_hot_keys=False).with_hot_keys(min_rows=1000)
    assert book.hot_members == ("M0",)
    joined = book.with_members(book.loans.select("loan_id", "member_id"), "city")
    sizes = [row["count"] for row in joined.where("member_id <> 'M0'").groupBy(F.spark_partition_id()).count().collect()]
    hot = [row["count"] for row in joined.where("member_id = 'M0'").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < N / 8 and max(hot) <= N / 8 and sum(hot) == N // 3


def test_marts_on_skewed_input(spark):
    raw = skewed(spark)
    plain = LoanBook.from_raw(raw)
    apart = plain.with_hot_keys(min_rows=1000)
    assert not plain.hot_members and apart.hot_members
    for mart in (marts.member_delinquency, marts.delinquency_by_city, marts.delinquency_by_loan_type):
        assert as_set(mart(plain)) == as_set(mart(apart))
    for mart in (marts.member_loan_summary, marts.payment_detail, marts.member_monthly_status):
        left, right = mart(plain), mart(apart)
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    by_city = {row["city"]: row["total_payments"] for row in marts.delinquency_by_city(apart).collect()}
    assert by_city["Dallas"] == N // 3 + 0 and sum(by_city.values()) == marts.payment_detail(apart).count()


def test_copies_are_combined_before_the_shuffle(spark, setting):
    """A loan with a third of the payments, and a member with a third of the copies, send a few rows per map task."""
    setting(adaptive__enabled="false")
    book = LoanBook.from_raw(skewed(spark), find_hot_keys=False)
    stats_plan = plan_text(book.payment_stats())
    assert re.search(r"Exchange hashpartitioning\(loan_id.*\n\s+\+- \*\(1\) HashAggregate.*partial_count", stats_plan)
    members_plan = plan_text(clean_members(skewed(spark).members))
    assert re.search(r"Exchange hashpartitioning\(member_id.*\n\s+\+- WindowGroupLimit.*Partial", members_plan)


def test_adaptive_split_of_a_hot_loan(spark, setting):
    """payment_detail joins two fresh shuffles, so the adaptive skew split applies to a loan with very many payments."""
    setting(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        shuffle__partitions="16",
    )
    book = LoanBook.from_raw(skewed(spark)).with_hot_keys(min_rows=1000)
    assert "skewed=" in plan_text(marts.payment_detail(book), run=True) or "skew=true" in plan_text(
        marts.payment_detail(book), run=True
    )


def test_payments_are_shuffled_once(spark, setting):
    """Plans of the heavy marts: how often rows of payment size meet a shuffle, and where partial sums sit."""
    setting(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    book = LoanBook.from_raw(skewed(spark), find_hot_keys=False)
    detail = plan_text(marts.payment_detail(book))
    # members: dedup; loans: by member, then by loan; payments: by loan.
    assert detail.count("Exchange hashpartitioning") == 4
    by_type = plan_text(marts.delinquency_by_loan_type(book))
    # loans and statistics by loan, then the few types; the distinct count adds none.
    assert by_type.count("Exchange hashpartitioning") == 3
    summary = plan_text(marts.member_loan_summary(book))
    # members: dedup; loans: by member, then by loan; statistics by loan. Adding up copies adds none.
    assert summary.count("Exchange hashpartitioning") == 4
    by_city = plan_text(marts.delinquency_by_city(book))
    # dedup, loans and statistics by loan, member sums, the few cities; the member join adds none.
    assert by_city.count("Exchange hashpartitioning") == 5


def test_copies_of_one_payment_are_sorted_in_many_ranges(spark, setting):
    """A third of the payments equal in every column: the sort by member and due date still spreads them."""
    setting(adaptive__enabled="false", shuffle__partitions="12")
    raw = skewed(spark)
    same = F.col("loan_id") == "L0"
    payments = raw.payments.withColumn("payment_id", F.when(same, "P0").otherwise(F.col("payment_id"))).withColumn(
        "payment_status", F.lit("Late")
    )
    book = LoanBook.from_raw(RawTables(raw.members, raw.loans, payments)).with_hot_keys(min_rows=1000)
    sizes = marts.sorted_payment_detail(book).groupBy(F.spark_partition_id()).count().collect()
    total = sum(row["count"] for row in sizes)
    assert total == marts.payment_detail(book).count() and max(row["count"] for row in sizes) < total / 4


def test_scans_read_only_what_is_used(spark, setting, tmp_path):
    """Over stored tables, filters and column choices reach the parquet scans."""
    setting(maxMetadataStringLength="2000")
    raw = skewed(spark, 300)
    stored = {name: f"{tmp_path}/{name}" for name in raw.named()}
    for name, table in raw.named().items():
        table.write.parquet(stored[name])
    members, loans, payments = (spark.read.parquet(path) for path in stored.values())
    book = LoanBook.from_raw(RawTables(members, loans, payments))
    book.members.write.parquet(f"{tmp_path}/members_clean")
    book = LoanBook(spark.read.parquet(f"{tmp_path}/members_clean"), book.loans, book.payments)

    def scans(df):
        return {
            re.search(r"/(\w+)\]", line).group(1): line for line in plan_text(df).splitlines() if "FileScan parquet" in line
        }

    trend = scans(marts.monthly_delinquency_trend(book))
    assert "ReadSchema: struct<payment_id:string,due_date:string,payment_status:string>" in trend["raw_payments"]
    flagged = scans(marts.member_delinquency(book))
    assert "EqualTo(account_status,Active)" in flagged["members_clean"]
    assert "ReadSchema: struct<loan_id:string,member_id:string>" in flagged["raw_loans"]
    assert "due_date" not in flagged["raw_payments"] and "IsNotNull(loan_id)" in flagged["raw_payments"]
    one = scans(drill.member_drill_payments(book, "M7"))
    assert "EqualTo(member_id,M7)" in one["raw_loans"] and "EqualTo(member_id,M7)" in one["members_clean"]


def test_drill_into_one_member_runs_nothing_before_it_is_asked(spark):
    """The loans' number isn't counted while the query is built; adaptive execution broadcasts them when it sees their size."""
    book = LoanBook.from_raw(skewed(spark, 300), find_hot_keys=False)
    spark.sparkContext.setJobGroup("building", "building")
    payments = drill.for_member(book, "M7").payments
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    payments.collect()
    assert "BroadcastHashJoin" in payments._jdf.queryExecution().executedPlan().toString()



def test_one_members_payments_are_found_before_a_shuffle(spark, setting):
    """Other loans' payments don't reach the join by loan, neither when the member's loans are too many to be broadcast."""
    book = LoanBook.from_raw(skewed(spark, 300))
    expected = rows(drill.for_member(book, "M7").payments.orderBy("payment_id"))
    setting(autoBroadcastJoinThreshold="-1")
    payments = drill.for_member(book, "M7").payments
    plan = plan_text(payments)
    assert re.search(r"BroadcastHashJoin \[_place_of_loan.*LeftSemi, BuildRight", plan)
    assert plan.index("SortMergeJoin [loan_id") < plan.index("hashpartitioning(loan_id") < plan.index("BroadcastHashJoin [_place_of_loan")
    assert expected and rows(payments.orderBy("payment_id")) == expected
