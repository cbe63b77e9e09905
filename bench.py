"""Time the headline queries over the provided tables and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores. The tables are opened
and looked through for hot ids once, as its own line. Every query is built and run to completion into a no-op sink; the first
round warms the JVM and is not counted.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from lendrisk.catalog.queries import OPENED_QUERIES, Opened

HEADLINE = (
    "dedup_members",
    "members_clean",
    "loans_clean",
    "payments_clean",
    "loan_payment_stats",
    "member_delinquency",
    "delinquency_by_loan_type",
    "monthly_delinquency_trend",
    "delinquency_by_credit_tier",
    "delinquency_by_city",
    "member_loan_summary",
    "payment_detail",
    "payment_detail_sorted",
    "member_delinquency_scored",
    "risk_tier_counts",
    "data_quality_report",
    "highest_delinquency",
    "kpi_overview",
    "member_detail_high_risk",
    "member_drill_loans",
    "member_drill_payments",
    "member_monthly_status",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lendrisk-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds_since(start: float) -> float:
        return round(time.perf_counter() - start, 3)

    def one_round() -> dict[str, float]:
        start = time.perf_counter()
        tables = Opened(spark, sf_dir)
        tables.book
        seconds = {"open_tables": seconds_since(start)}
        for name in HEADLINE:
            start = time.perf_counter()
            OPENED_QUERIES[name](tables).write.format("noop").mode("overwrite").save()
            seconds[name] = seconds_since(start)
        return seconds

    one_round()
    seconds = one_round()
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
