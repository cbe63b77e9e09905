"""Risk scores, tiers, and the reports made from them."""

import numpy as np
import pytest
from helpers import loan, member, messy_data, payment, plan_text, rows

from lendrisk.plans import drill, marts, quality, scoring
from lendrisk.plans.book import LoanBook

COLUMNS = (
    "member_id string, member_name string, city string, credit_score double, account_status string, "
    "late_payment_count long, missed_payment_count long, total_amount_past_due double, total_payments long, "
    "delinquency_rate double"
)


def flagged(spark, *measures):
    data = [
        (f"M{i}", f"Ann Lee{i}", "Dallas", 700.0, "Active", late, missed, owed, 100, rate)
        for i, (late, missed, owed, rate) in enumerate(measures)
    ]
    return spark.createDataFrame(data, COLUMNS)


def test_scores_against_arrays(spark):
    rng = np.random.default_rng(7)
    data = [
        (int(late), int(rng.integers(0, late + 1)), round(float(rng.uniform(0, 9000)), 2), round(float(rng.uniform(3, 100)), 1))
        for late in rng.integers(3, 40, 60)
    ]
    late, missed, owed, rate = (np.array(column, dtype=float) for column in zip(*data))

    def norm(x):
        return (x - x.min()) / (x.max() - x.min() + 1)

    expected = np.round((norm(late) * 0.4 + norm(missed) * 0.3 + norm(owed) * 0.2 + rate / 100 * 0.1) * 100, 1)
    scored = scoring.member_delinquency_scored(flagged(spark, *data))
    got = {row["member_id"]: row for row in rows(scored)}
    assert [got[f"M{i}"]["risk_score"] for i in range(60)] == expected.tolist()
    tiers = np.select([expected <= 25, expected <= 50, expected <= 75], ["Low Risk", "Moderate Risk", "High Risk"], "Critical Risk")
    assert [got[f"M{i}"]["risk_tier"] for i in range(60)] == tiers.tolist()
    assert scored.columns == [*flagged(spark).columns, "risk_score", "risk_tier"]


def test_nobody_and_one_member(spark):
    assert rows(scoring.member_delinquency_scored(flagged(spark))) == []
    # All ranges are 0: the score is a tenth of the rate.
    only = rows(scoring.member_delinquency_scored(flagged(spark, (5, 5, 100.0, 62.5))))[0]
    assert (only["risk_score"], only["risk_tier"]) == (float(np.round(62.5 / 100 * 0.1 * 100, 1)), "Low Risk")


def test_weights_and_scheme(spark):
    data = flagged(spark, (3, 0, 0.0, 30.0), (12, 9, 50.0, 90.0))
    weights = {"late": 0.0, "missed": 0.0, "amount": 0.0, "rate": 1.0}
    found = rows(scoring.member_delinquency_scored(data, "documented", weights))
    assert {(row["risk_score"], row["risk_tier"]) for row in found} == {(30.0, "Moderate Risk"), (90.0, "High Risk")}


def test_tier_counts_keep_empty_tiers(spark):
    scored = scoring.member_delinquency_scored(flagged(spark, (3, 0, 0.0, 10.0), (3, 0, 0.0, 10.0), (30, 9, 5.0, 60.0)))
    assert [tuple(row.values()) for row in rows(scoring.risk_tier_counts(scored))] == [
        ("Low Risk", 2), ("Critical Risk", 1), ("Moderate Risk", 0), ("High Risk", 0),
    ]
    assert len(rows(scoring.risk_tier_counts(scored, "documented"))) == 3


def test_scoring_plan_reads_payments_once(make_raw, setting):
    """The ranges and the rows they are applied to share the payment pass; nothing is a cross join or a one-task window."""
    setting(autoBroadcastJoinThreshold="-1")
    book = LoanBook.from_raw(make_raw(**messy_data(6)))
    plan = plan_text(scoring.member_delinquency_scored(marts.member_delinquency(book)), run=True)
    assert "ReusedExchange" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange SinglePartition") == plan.count("Exchange SinglePartition, ENSURE_REQUIREMENTS")


def test_quality_report(make_raw):
    raw = make_raw(
        members=[
            member("M1", 1, credit_score=None, email="", phone="N/A"), member("M1", 2), member("M2", 3, email=None),
        ],
        loans=[loan("L1", "M1", original_amount=-1.0), loan("L2", "M2", interest_rate=None)],
        payments=[payment(f"P{i}", "L1", "Missed") for i in range(3)] + [payment("P9", "L2", actual_amount=-1.0)],
    )
    book = LoanBook.from_raw(raw)
    delinquency = marts.member_delinquency(book)
    report = {(row["section"], row["measure"]): row["value"] for row in rows(quality.data_quality_report(raw, book, delinquency))}
    assert report == {
        ("members", "total_clean_members"): 2,
        ("members", "duplicate_rows_removed"): 1,
        ("members", "missing_credit_scores"): 1,
        ("members", "missing_emails"): 2,
        ("members", "missing_phones"): 1,
        ("loans", "negative_amounts_corrected"): 1,
        ("loans", "missing_interest_rates"): 1,
        ("payments", "negative_payments_fixed"): 1,
        ("delinquency", "members_flagged"): 1,
    }
    assert rows(quality.highest_delinquency(delinquency)) == [
        {"member_id": "M1", "member_name": "Ann Lee", "late_payment_count": 3}
    ]
    assert rows(quality.highest_delinquency(delinquency.where("false"))) == []


def test_highest_delinquency_takes_the_lower_id(spark):
    data = flagged(spark, (4, 0, 0.0, 1.0), (9, 0, 0.0, 1.0), (9, 0, 0.0, 1.0))
    assert rows(quality.highest_delinquency(data.repartition(3)))[0]["member_id"] == "M1"


def test_member_detail_filters_after_scoring(spark):
    scored = scoring.member_delinquency_scored(flagged(spark, (3, 0, 0.0, 10.0), (20, 9, 5.0, 60.0), (30, 9, 5.0, 60.0)))
    everyone = rows(drill.member_detail(scored))
    assert [row["risk_score"] for row in everyone] == sorted((row["risk_score"] for row in everyone), reverse=True)
    assert rows(drill.member_detail(scored, tier="Low Risk")) == everyone[-1:]
    assert rows(drill.member_detail(scored, min_score=everyone[1]["risk_score"])) == everyone[:2]
    assert rows(drill.member_detail(scored, city="Keller")) == []


@pytest.mark.parametrize("written_stats", [False, True])
def test_kpis(make_raw, written_stats):
    raw = make_raw(
        members=[member("M1", 1), member("M1", 2)],
        loans=[loan("L1", "M1"), loan("L2", "M2")],
        payments=[payment(f"P{i}", "L1", "Missed") for i in range(3)]
        + [payment("P4", "L7", "Late", actual_amount=99.5), payment(None, None)],
    )
    book = LoanBook.from_raw(raw)
    if written_stats:
        book = LoanBook(book.members, book.loans, book.payments, stats=book.payment_stats())
    assert rows(drill.kpi_overview(book, marts.member_delinquency(book))) == [{
        "members": 1, "loans": 2, "payments": 5, "late_payments": 4, "delinquency_rate_pct": 100.0,
        "amount_past_due": 300.5, "members_flagged": 1,
    }]


def test_drill_through(make_raw):
    data = messy_data(8)
    book = LoanBook.from_raw(make_raw(**data))
    for member_id in ("M01", "M02", "nobody"):
        loans, payments = drill.member_drill_loans(book, member_id), drill.member_drill_payments(book, member_id)
        key = f"member_id = '{member_id}'"
        assert rows(loans) == rows(marts.member_loan_summary(book).where(key).orderBy("loan_id"))
        expected = rows(marts.payment_detail(book).where(key))
        assert sorted(map(str, rows(payments))) == sorted(map(str, expected))
