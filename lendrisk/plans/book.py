"""The cleaned tables that every analysis starts from."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from lendrisk.operators.cleaning import clean_loans, clean_members, clean_payments
from lendrisk.operators.rollups import loan_activity, loan_payment_stats, stats_of_activity
from lendrisk.operators.skew import hot_keys, join_unique
from lendrisk.sources.raw import RawTables


@dataclass(frozen=True)
class LoanBook:
    """Cleaned members, loans and payments, with the loan and member ids whose rows are dealt out in joins.

    ``stats``, ``activity``, ``loan_totals`` and ``totals`` may hold written ``loan_payment_stats``, ``loan_activity``,
    ``loan_rollup`` and ``member_rollup`` tables; without them the marts compute what they need in their own plan.
    """

    members: DataFrame
    loans: DataFrame
    payments: DataFrame
    hot_loans: tuple[str, ...] = ()
    hot_members: tuple[str, ...] = ()
    stats: DataFrame | None = None
    activity: DataFrame | None = None
    loan_totals: DataFrame | None = None
    totals: DataFrame | None = None

    @classmethod
    def from_raw(cls, raw: RawTables, *, canonical_types: bool = False, find_hot_keys: bool = False) -> LoanBook:
        """Clean the raw tables; nothing runs until a result is asked for.

        ``find_hot_keys`` adds the step ``with_hot_keys``, which does run. Store raw CSV as parquet first if it is large; a full
        refresh does.
        """
        book = cls(
            clean_members(raw.members, raw.member_order),
            clean_loans(raw.loans, canonical_types),
            clean_payments(raw.payments),
        )
        return book.with_hot_keys() if find_hot_keys else book

    def with_hot_keys(self, *, payments: bool = False, **limits: float) -> LoanBook:
        """The same book with the hot member ids looked up among the loans, in one pass; ``limits`` go to ``hot_keys``.

        ``payments`` also looks for hot loan ids among the payments. The marts that combine payments per loan first don't need
        them, and the adaptive skew split serves ``payment_detail`` too; look them up where that is off.
        """
        members = hot_keys(self.loans, ["member_id"], **limits)["member_id"]
        loans = hot_keys(self.payments, ["loan_id"], **limits)["loan_id"] if payments else self.hot_loans
        return replace(self, hot_members=members, hot_loans=loans)

    def payment_stats(self) -> DataFrame:
        if self.stats is not None:
            return self.stats
        return loan_payment_stats(self.payments) if self.activity is None else stats_of_activity(self.activity)

    def payment_activity(self) -> DataFrame:
        return loan_activity(self.payments) if self.activity is None else self.activity

    def with_stats(self, loans: DataFrame) -> DataFrame:
        """Loan rows that have payments, with the loan's payment measures."""
        return loans.join(self.payment_stats(), "loan_id")

    def with_members(self, loans: DataFrame, *columns: str) -> DataFrame:
        """Loan rows that have a member, with the chosen member columns."""
        return join_unique(loans, self.members.select("member_id", *columns), "member_id", self.hot_members)
