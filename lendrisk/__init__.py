"""Loan-delinquency analytics as Spark DataFrame functions.

Raw member, loan and payment tables go in; cleaned tables, delinquency marts, risk scores, a data-quality report and
drill-down views come out. Everything is a lazy ``DataFrame -> DataFrame`` or ``Column -> Column`` function.
"""

from lendrisk.plans.book import LoanBook
from lendrisk.sources.raw import RawTables, read_raw

__all__ = ["LoanBook", "RawTables", "read_raw"]
