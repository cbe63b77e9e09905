"""Marts on small messy tables against brute force, and the rules that random data may miss."""

import pytest
from helpers import BruteForce, as_set, band, loan, member, messy_data, payment, rows
from hypothesis import HealthCheck, given, settings, strategies as st

from lendrisk.plans import marts
from lendrisk.plans.book import LoanBook


def ordered(expected, columns):
    """Tuples in mart column order, rearranged as ``as_set`` does."""
    place = [columns.index(name) for name in sorted(columns)]
    return sorted((tuple(row[i] for i in place) for row in expected), key=repr)


def check(df, expected):
    assert as_set(df) == ordered(expected, df.columns)


def all_marts(book, truth):
    d = "member_id member_name city credit_score account_status late_payment_count missed_payment_count " \
        "total_amount_past_due total_payments delinquency_rate"
    for min_late in (1, 3, 8):
        got = marts.member_delinquency(book, min_late).select(*d.split())
        check(got, truth.member_delinquency(min_late))
    check(marts.delinquency_by_loan_type(book), truth.by_loan_type())
    check(marts.monthly_delinquency_trend(book), truth.by_month())
    check(marts.delinquency_by_city(book), truth.by_member_group(lambda who: who["city"]))
    check(marts.delinquency_by_credit_tier(book), truth.by_member_group(lambda who: band(who["credit_score"])))
    check(marts.member_loan_summary(book), truth.loan_summary())
    check(marts.payment_detail(book), truth.detail())
    check(marts.member_monthly_status(book), truth.monthly_status())


# late, missed, past due, total, rate is the order of the brute force, and of the mart but for one swap.
@pytest.mark.parametrize("seed", [1, 2])
def test_marts_against_brute_force(make_raw, seed):
    data = messy_data(seed)
    book = LoanBook.from_raw(make_raw(**data))
    all_marts(book, BruteForce(**data))


def test_marts_with_hot_keys_joined_apart(make_raw):
    """The same results when some ids, known and unknown ones, take the broadcast branch."""
    data = messy_data(3)
    raw = make_raw(**data)
    book = LoanBook.from_raw(raw).with_hot_keys(min_rows=2, min_share=0.05)
    assert book.hot_members
    all_marts(book, BruteForce(**data))


def test_marts_do_not_depend_on_partitioning(make_raw):
    data = messy_data(4)
    raw = make_raw(**data)
    book = LoanBook.from_raw(raw)
    spread = LoanBook(book.members.repartition(17), book.loans.repartition(17), book.payments.repartition(17))
    for mart in (marts.member_delinquency, marts.delinquency_by_loan_type, marts.member_loan_summary):
        assert as_set(mart(book)) == as_set(mart(spread))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(100, 10_000))
def test_totals_agree_without_orphans(make_raw, seed):
    book = LoanBook.from_raw(make_raw(**messy_data(seed, n_payments=60, orphans=False)))
    tables = [
        marts.delinquency_by_loan_type(book), marts.monthly_delinquency_trend(book),
        marts.delinquency_by_city(book), marts.delinquency_by_credit_tier(book),
    ]
    sums = {
        (sum(row["total_payments"] for row in found), sum(row["late_payments"] for row in found))
        for found in map(rows, tables)
    }
    assert len(sums) == 1 and next(iter(sums))[0] == 60


def test_flagging_rules(make_raw):
    late = lambda loan_id, n: [payment(f"{loan_id}-{i}", loan_id, "LATE") for i in range(n)]
    raw = make_raw(
        members=[member("M2"), member("M3"), member("M4", account_status="Inactive")],
        loans=[loan("L2", "M2"), loan("L3", "M3"), loan("L4", "M4"), loan("L9", "M9")],
        payments=late("L2", 2) + late("L3", 3) + late("L4", 5) + late("L9", 5) + late("L8", 5),
    )
    book = LoanBook.from_raw(raw)
    assert [row["member_id"] for row in rows(marts.member_delinquency(book))] == ["M3"]
    # Orphan payments count in the trend, which joins nothing.
    assert rows(marts.monthly_delinquency_trend(book))[0]["total_payments"] == 20


def test_ties_sort_by_descending_key(make_raw):
    raw = make_raw(
        members=[member("M1", city="Bedford"), member("M2", city="Cleburne"), member("M3", city="Keller")],
        loans=[loan("L1", "M1"), loan("L2", "M2"), loan("L3", "M3")],
        payments=[payment("P1", "L1"), payment("P2", "L2"), payment("P3", "L3", "Late")],
    )
    book = LoanBook.from_raw(raw)
    assert [row["city"] for row in rows(marts.delinquency_by_city(book))] == ["Keller", "Cleburne", "Bedford"]


def test_sorted_detail(make_raw):
    data = messy_data(5)
    book = LoanBook.from_raw(make_raw(**data))
    found = rows(marts.sorted_payment_detail(book))
    keys = [(row["member_id"], row["due_date"]) for row in found]
    assert keys == sorted(keys)
    assert as_set(marts.payment_detail(book)) == as_set(marts.sorted_payment_detail(book))
