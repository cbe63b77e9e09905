"""Small raw tables and a plain-Python statement of what each mart should hold."""

import contextlib
import io
import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import types as T

from lendrisk import fixed_values as V
from lendrisk.sources.raw import RawTables

MEMBERS = T.StructType([T.StructField("ingest_seq", T.LongType()), *V.RAW_MEMBERS.fields])


def member(member_id, seq=0, **values):
    row = {
        "ingest_seq": seq, "member_id": member_id, "first_name": "Ann", "last_name": "Lee", "join_date": "01/15/2015",
        "city": "Dallas", "state": "TX", "credit_score": 700.0, "email": "a@example.com", "phone": "(817)555-0000",
        "account_status": "Active",
    }
    assert not values.keys() - row.keys()
    return {**row, **values}


def loan(loan_id, member_id, **values):
    row = {
        "loan_id": loan_id, "member_id": member_id, "loan_type": "Auto Loan", "original_amount": 1000.0,
        "interest_rate": 5.0, "term_months": 12, "origination_date": "2020-01-01", "loan_status": "Current",
    }
    assert not values.keys() - row.keys()
    return {**row, **values}


def payment(payment_id, loan_id, status="On Time", **values):
    row = {
        "payment_id": payment_id, "loan_id": loan_id, "due_date": "2023-01-10", "payment_date": "2023-01-10",
        "expected_amount": 100.0, "actual_amount": 0.0 if status == "Missed" else 100.0, "payment_status": status,
    }
    assert not values.keys() - row.keys()
    return {**row, **values}


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(row[name] for name in schema.names) for row in rows], schema)


def raw_tables(spark, members=(), loans=(), payments=()):
    return RawTables(
        frame(spark, members, MEMBERS), frame(spark, loans, V.RAW_LOANS), frame(spark, payments, V.RAW_PAYMENTS)
    )


def rows(df):
    """The rows as plain dictionaries."""
    return [row.asDict() for row in df.collect()]


def as_set(df):
    """The rows as a sorted list, for comparing without order."""
    return sorted((tuple(row) for row in df.select(*sorted(df.columns)).collect()), key=repr)


def plan_text(df, run=False):
    """What ``explain`` prints; after running the query, the final adaptive plan."""
    if run:
        df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


# --- random messy input and brute-force results -----------------------------------------------------------------------


def messy_data(seed, n_members=12, n_loans=25, n_payments=160, orphans=True):
    r = random.Random(seed)
    members, loans, payments = [], [], []
    for i in range(n_members):
        row = member(
            f"M{i:02d}", 10 * i + 5,
            first_name=r.choice(["ann", "MARY ANN", " joe", "Bo", None]),
            last_name=r.choice(["lee", "  smith", "O'NEIL", "von berg"]),
            city=r.choice(["Dallas", "Hurst", "Keller", None]),
            credit_score=r.choice([599.0, 600.0, 649.9, 650.0, 700.0, 749.5, 750.0, None]),
            email=r.choice(["", " ", None, "x@example.com"]),
            phone=r.choice(["N/A", "n/a", "", None, "(817)555-1234"]),
            account_status=r.choice(["Active", "Active", "Active", "Inactive", "Closed"]),
        )
        members.append(row)
        if r.random() < 0.3:
            members.append({**row, "ingest_seq": 10 * i, "account_status": r.choice(["Active", "Closed"])})
    for i in range(n_loans):
        owner = f"M{r.randrange(n_members + (2 if orphans else 0)):02d}"
        loans.append(loan(
            f"L{i:02d}", owner if r.random() < 0.95 or not orphans else None,
            loan_type=r.choice(["Auto Loan", "auto loan", "Mortgage", "mortgage", "Credit Card"]),
            original_amount=r.choice([-1.0, 1.0]) * round(r.uniform(100, 90000), 2),
            interest_rate=r.choice([None, 3.5, 7.25]),
        ))
    if orphans:
        loans += [dict(loans[0]), {**loans[1], "member_id": "M00"}]
    for i in range(n_payments):
        status = r.choice(["On Time", "ON TIME", "Late", "LATE", "Missed", "Partial", None])
        due = date(2022, 1, 1) + timedelta(days=r.randrange(300))
        expected = round(r.uniform(1, 3000), 2)
        # late and missed payments may be paid in part, in excess and with fractions of a cent
        late = r.choice([expected, round(expected / 3, 2), expected * 0.875, expected + 1.5])
        actual = {"Missed": r.choice([0.0, expected * 0.125]), "Partial": round(expected / 3, 2)}.get(status, expected)
        actual = late if status in ("Late", "LATE") else actual
        paid = None if status == "Missed" else (due + timedelta(days=r.randrange(-4, 40))).isoformat()
        payments.append(payment(
            f"P{i:03d}" if r.random() < 0.95 or not orphans else None,
            f"L{r.randrange(n_loans + (2 if orphans else 0)):02d}" if r.random() < 0.97 or not orphans else None,
            status,
            due_date=due.isoformat(),
            payment_date=r.choice(["", " "]) if paid is None else paid,
            expected_amount=expected if r.random() < 0.95 else None,
            actual_amount=actual * r.choice([1, 1, 1, -1]),
        ))
    return {"members": members, "loans": loans, "payments": payments}


def _first_up(text, lower=True, strip=False):
    if text is None:
        return None
    text = text.strip(" ") if strip else text
    return text[:1].upper() + (text[1:].lower() if lower else text[1:])


def rate(late, total):
    if total == 0:
        return None
    return float((Decimal(100 * late) / Decimal(total)).quantize(Decimal("0.1"), ROUND_HALF_UP))


class BruteForce:
    """The marts by nested loops over the raw rows."""

    def __init__(self, members, loans, payments):
        kept = {}
        for row in sorted(members, key=lambda row: row["ingest_seq"]):
            kept.setdefault(row["member_id"], row)
        self.members = [self._member(row) for row in kept.values()]
        self.loans = [
            {**row, "loan_type": _first_up(row["loan_type"], lower=False), "original_amount": abs(row["original_amount"])}
            for row in loans
        ]
        self.payments = [self._payment(row) for row in payments]
        self.loan_payments = [
            (one, paid) for one in self.loans for paid in self.payments
            if one["loan_id"] == paid["loan_id"] and one["loan_id"] is not None
        ]
        self.joined = [
            (who, one, paid) for who in self.members for one, paid in self.loan_payments
            if who["member_id"] == one["member_id"]
        ]

    @staticmethod
    def _member(row):
        first, last = (_first_up(row[name], strip=True) for name in ("first_name", "last_name"))
        return {
            **row, "first_name": first, "last_name": last,
            "member_name": None if first is None or last is None else f"{first} {last}",
            "email": None if row["email"] in ("", " ") else row["email"],
            "phone": None if row["phone"] in ("", "N/A", "n/a") else row["phone"],
        }

    @staticmethod
    def _payment(row):
        status = _first_up(row["payment_status"])
        expected, actual = row["expected_amount"], abs(row["actual_amount"])
        short = None if expected is None else expected - actual
        late = status in ("Late", "Missed")
        return {
            **row, "payment_status": status, "actual_amount": actual, "shortfall": short, "late": late,
            "missed": status == "Missed",
            "owed": (None if short is None else Decimal(repr(short)).quantize(Decimal("0.000001"), ROUND_HALF_UP)) if late else Decimal(0),
            "payment_date": None if row["payment_date"] in ("", " ") else row["payment_date"],
        }

    @staticmethod
    def measures(paid):
        total = sum(p["payment_id"] is not None for p in paid)
        late = sum(p["late"] for p in paid)
        owed = [p["owed"] for p in paid if p["owed"] is not None]
        return late, sum(p["missed"] for p in paid), float(sum(owed)) if owed else None, total, rate(late, total)

    def grouped(self, key):
        groups = defaultdict(list)
        for who, one, paid in self.joined:
            groups[key(who, one)].append((who, paid))
        return groups

    def member_delinquency(self, min_late=3):
        out = []
        by_member = self.grouped(lambda who, one: who["member_id"])
        for members in by_member.values():
            who = members[0][0]
            measures = self.measures([paid for _, paid in members])
            if who["account_status"] == "Active" and measures[0] >= min_late:
                out.append((
                    who["member_id"], who["member_name"], who["city"], who["credit_score"], who["account_status"], *measures
                ))
        return out

    def by_member_group(self, key):
        out = []
        for name, members in self.grouped(lambda who, one: key(who)).items():
            late, _, _, total, pct = self.measures([paid for _, paid in members])
            out.append((name, len({who["member_id"] for who, _ in members}), late, total, pct))
        return out

    def by_loan_type(self):
        groups = defaultdict(list)
        for one, paid in self.loan_payments:
            groups[one["loan_type"]].append((one["loan_id"], paid))
        out = []
        for name, found in groups.items():
            late, _, owed, total, pct = self.measures([paid for _, paid in found])
            out.append((name, len({loan_id for loan_id, _ in found}), late, total, pct, owed))
        return out

    def by_month(self):
        groups = defaultdict(list)
        for paid in self.payments:
            groups[paid["due_date"][:7]].append(paid)
        out = []
        for month, paid in groups.items():
            late, _, _, total, pct = self.measures(paid)
            out.append((month, total, late, pct))
        return out

    def loan_summary(self):
        columns = ("loan_id", "loan_type", "original_amount", "interest_rate", "loan_status", "origination_date")
        groups = self.grouped(lambda who, one: (who["member_id"], who["member_name"], *(one[c] for c in columns)))
        out = []
        for key, found in groups.items():
            late, missed, owed, total, pct = self.measures([paid for _, paid in found])
            out.append((*key, total, late, missed, owed, pct))
        return out

    def detail(self):
        def days(paid):
            if paid["payment_date"] is None:
                return None
            return max((date.fromisoformat(paid["payment_date"]) - date.fromisoformat(paid["due_date"])).days, 0)

        return [
            (who["member_id"], who["member_name"], one["loan_id"], one["loan_type"], paid["payment_id"], paid["due_date"],
             paid["payment_date"], paid["expected_amount"], paid["actual_amount"], paid["shortfall"],
             paid["payment_status"], days(paid))
            for who, one, paid in self.joined
        ]

    def monthly_status(self):
        groups = defaultdict(list)
        for who, _, paid in self.joined:
            groups[who["member_id"], paid["due_date"][:7]].append(paid["payment_status"])
        return [
            (*key, *(found.count(status) for status in ("On time", "Late", "Missed", "Partial")))
            for key, found in groups.items()
        ]


def band(score):
    if score is None:
        return "Unknown"
    for lowest, label in (
        (750, "750+ (Excellent)"), (700, "700-749 (Good)"), (650, "650-699 (Fair)"), (600, "600-649 (Below Avg)")
    ):
        if score >= lowest:
            return label
    return "Below 600 (Poor)"
