"""``python -m lendrisk RAW_DIR OUT_DIR``: run everything and print the reports."""

import argparse

from pyspark.sql import SparkSession

from lendrisk import fixed_values as V
from lendrisk.plans.refresh import full_refresh
from lendrisk.sources.raw import SPARED_COLUMNS


def main() -> None:
    parser = argparse.ArgumentParser(prog="lendrisk", description=__doc__)
    parser.add_argument("raw_dir", help="folder with raw_members, raw_loans and raw_payments")
    parser.add_argument("out_dir", help="folder for the tables and CSV exports, reachable by every executor")
    parser.add_argument("--format", default="csv", help="format of the raw tables: csv or parquet")
    parser.add_argument("--canonical-types", action="store_true", help="merge the casings of loan types")
    parser.add_argument("--tiers", choices=("code", "documented"), default="code", help="risk tier scheme")
    parser.add_argument("--null-token", action="append", metavar="TEXT", help="a CSV text that means missing, once for each; replaces the usual ones")
    parser.add_argument("--spare", action="append", metavar="COLUMN", help="a text column in which no null token is read, once for each; replaces the names")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("lendrisk").getOrCreate()
    result = full_refresh(
        spark, args.raw_dir, args.out_dir,
        file_format=args.format, canonical_types=args.canonical_types, scheme=args.tiers,
        null_tokens=V.NULL_TOKENS if args.null_token is None else args.null_token,
        spared_columns=SPARED_COLUMNS if args.spare is None else args.spare,
    )
    for title, report in (
        ("Loaded", result.loaded),
        ("Data quality", result.quality),
        ("Highest delinquency", result.highest_delinquency),
        ("Members per risk tier", result.risk_tiers),
        ("Exported", result.exported),
    ):
        print(title)
        report.show(truncate=False)


if __name__ == "__main__":
    main()
