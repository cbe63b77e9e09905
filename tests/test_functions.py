"""Column functions, one edge per case."""

import random

import numpy as np
import pytest
from helpers import rate
from pyspark.sql import functions as F

from lendrisk.functions import measures as M
from lendrisk.functions.text import capitalize_first, full_name, null_if_in, plain_money
from lendrisk.operators.cleaning import clean_loan_type, missing_flag


def values(spark, inputs, ddl, *exprs):
    """Evaluate expressions over one-column input, in input order."""
    df = spark.createDataFrame([(i, value) for i, value in enumerate(inputs)], f"i int, x {ddl}")
    out = df.select("i", *[e.alias(f"e{k}") for k, e in enumerate(exprs)]).orderBy("i").collect()
    columns = [[row[f"e{k}"] for row in out] for k in range(len(exprs))]
    return columns[0] if len(exprs) == 1 else columns



def test_names(spark):
    x = F.col("x")
    got = values(spark, ["  smith", "MARY ANN", "mary ann", "", None, "\tbob"], "string", capitalize_first(x, trim=True))
    assert got == ["Smith", "Mary ann", "Mary ann", "", None, "\tbob"]


def test_status_and_loan_type(spark):
    x = F.col("x")
    status, faithful, canonical = values(
        spark, ["ON TIME", "LATE", "auto loan", "Auto Loan", None], "string",
        capitalize_first(x), clean_loan_type(x), clean_loan_type(x, canonical=True),
    )
    assert status == ["On time", "Late", "Auto loan", "Auto loan", None]
    assert faithful == ["ON TIME", "LATE", "Auto loan", "Auto Loan", None]
    assert canonical == ["On Time", "Late", "Auto Loan", "Auto Loan", None]


def test_placeholders(spark):
    x = F.col("x")
    phone, email = values(
        spark, ["N/A", "n/a", "", " ", None, "5"], "string",
        null_if_in(x, ("N/A", "n/a", "")), null_if_in(x, ("", " ")),
    )
    assert phone == [None, None, None, " ", None, "5"]
    assert email == ["N/A", "n/a", None, None, None, "5"]


def test_full_name_is_null_if_a_part_is(spark):
    x = F.col("x")
    assert values(spark, ["Ann", None], "string", full_name(x, F.lit("Lee"))) == ["Ann Lee", None]


def test_missing_flag(spark):
    x = F.col("x")
    assert values(spark, [None, 0.0], "double", missing_flag(x)) == [1, 0]


def test_credit_bands(spark):
    x = F.col("x")
    got = values(spark, [850.0, 750.0, 749.5, 700.0, 699.0, 650.0, 600.0, 599.0, None], "double", M.credit_band(x))
    assert got == [
        "750+ (Excellent)", "750+ (Excellent)", "700-749 (Good)", "700-749 (Good)", "650-699 (Fair)", "650-699 (Fair)",
        "600-649 (Below Avg)", "Below 600 (Poor)", "Unknown",
    ]


@pytest.mark.parametrize(
    "late, total, expected",
    [(0, 5, 0.0), (1, 8, 12.5), (1, 16, 6.3), (0, 0, None), (545, 1740, 31.3), (6, 31, 19.4), (263, 784, 33.5)],
)
def test_rate(spark, late, total, expected):
    got = spark.range(1).select(M.rate_pct(F.lit(late), F.lit(total)).alias("r")).first()["r"]
    assert got == expected


def test_half_even(spark):
    x = F.col("x")
    assert values(spark, [0.25, 50.05, 12.35, 0.75, None], "double", M.half_even(x)) == [0.2, 50.0, 12.4, 0.8, None]


def test_tiers(spark):
    x = F.col("x")
    scores = [0.0, 25.0, 25.1, 50.0, 50.1, 75.0, 75.1, 100.0, -0.1, 100.1, None]
    low, mod, high, crit = M.tier_labels()
    assert values(spark, scores, "double", M.risk_tier(x)) == [low, low, mod, mod, high, high, crit, crit, None, None, None]
    documented = values(spark, [19.9, 20.0, 40.0, 40.1, None], "double", M.risk_tier(x, "documented"))
    assert documented == [low, mod, mod, high, None]
    with pytest.raises(ValueError):
        M.risk_tier(x, "other")


def test_days_late(spark):
    x = F.col("x")
    due = F.lit("2023-01-10")
    paid = ["2023-01-13", "2023-01-10", "2023-01-02", None, "2023-13-99", "z", "2024-02-29"]
    assert values(spark, paid, "string", M.days_late(x, due)) == [3, 0, 0, None, None, None, 415]


AMOUNTS = "payment_status string, expected_amount double, actual_amount double"


def test_past_due_keeps_small_and_large_amounts(spark):
    rows = [
        ("Late", 10.0, 4.0), ("Missed", 0.3, 0.1), ("Partial", 10.0, 4.0), (None, 10.0, 4.0), ("Late", None, 4.0),
        ("Late", 4.0, 10.5), ("Late", 1e17, 0.0), ("Late", 0.004, 0.0),
    ]
    df = spark.createDataFrame(rows, AMOUNTS)
    got = [None if row[0] is None else float(row[0]) for row in df.select(M.past_due()).collect()]
    assert got == [6, 0.2, 0, 0, None, -6.5, 1e17, 0.004]
    many = spark.createDataFrame([("Late", 0.004, 0.0)] * 1000 + [("Late", 6e16, 0.0)] * 2, AMOUNTS)
    assert float(many.agg(F.sum(M.past_due())).first()[0]) == 120000000000000004.0


@pytest.mark.parametrize("amount", [float("inf"), float("nan"), 1e300])
def test_an_impossible_amount_stops_the_run(spark, amount):
    df = spark.createDataFrame([("Late", 5.0, 0.0), ("Late", amount, 1.0)], AMOUNTS)
    with pytest.raises(Exception, match="finite|NUMERIC_VALUE_OUT_OF_RANGE"):
        df.agg(F.sum(M.past_due())).collect()


def test_rates_are_exact_half_up(spark):
    """Every late count of every total up to 150, and some large ones, against decimal arithmetic."""
    r = random.Random(1)
    pairs = [(late, total) for total in range(1, 151) for late in range(total + 1)]
    pairs += [(r.randrange(total + 1), total) for total in (r.randrange(1, 10**7) for _ in range(2000))]
    df = spark.createDataFrame(pairs, "late long, total long")
    for row in df.select("late", "total", M.rate_pct(F.col("late"), F.col("total")).alias("rate")).collect():
        assert row["rate"] == rate(row["late"], row["total"]), row


def test_half_even_is_the_array_rounding(spark):
    r = random.Random(2)
    numbers = [r.uniform(0, 100) for _ in range(3000)] + [k / 20 for k in range(2000)]
    x = F.col("x")
    assert values(spark, numbers, "double", M.half_even(x)) == np.round(np.array(numbers), 1).tolist()


def test_plain_money_never_has_an_exponent(spark):
    x = F.col("x")
    amounts = [12345678.125, 0.3 - 0.1 - 0.2, 1e17, 1.5e300, -1.25e-7, 1.0e20, 123456789012.3456]
    got = values(spark, amounts, "double", plain_money(x))
    assert not any("E" in text for text in got) and [float(text) for text in got] == amounts


def test_a_score_that_is_no_number_is_unknown(spark):
    x = F.col("x")
    assert values(spark, [float("nan"), 800.0], "double", M.credit_band(x)) == ["Unknown", "750+ (Excellent)"]


def test_plain_money(spark):
    x = F.col("x")
    got = values(spark, [12345678.5, 0.0, -3.25, 0.125, None], "double", plain_money(x))
    assert got == ["12345678.50", "0.00", "-3.25", "0.125", None]
