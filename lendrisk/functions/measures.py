"""Delinquency, rate, band, lateness and risk expressions."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from lendrisk import fixed_values as V

#: Money as it is summed.
EXACT_MONEY = "decimal(28,6)"


def is_delinquent(status: str = "payment_status", statuses: Sequence[str] = V.DELINQUENT_STATUSES) -> Column:
    """True for a late or missed payment; NULL status stays NULL, which counts as neither."""
    return F.col(status).isin(*statuses)


def is_missed(status: str = "payment_status") -> Column:
    return F.col(status) == V.MISSED


def shortfall(expected: str = "expected_amount", actual: str = "actual_amount") -> Column:
    return F.col(expected) - F.col(actual)


def past_due(status: str = "payment_status") -> Column:
    """Shortfall of a delinquent payment as an exact decimal of six places, 0 otherwise (A3).

    Only late and missed payments count: a late payment made in full adds 0, a partial payment adds nothing. Decimal sums don't
    depend on row order and keep fractions of a cent. No amount is left out unseen: one that is NaN, infinite or beyond 1e22
    stops the run, as does a sum beyond 1e32. An amount that is NULL adds nothing.
    """
    amount = shortfall()
    finite = F.when(F.isnan(amount) | (F.abs(amount) == float("inf")), F.raise_error(F.lit("a payment's amount is no finite number")))
    exact = finite.otherwise(amount).cast("double").cast(EXACT_MONEY)
    return F.when(is_delinquent(status), exact).otherwise(F.lit(0).cast(EXACT_MONEY))


def dollars(exact: Column) -> Column:
    """An exact sum as the nearest double."""
    return exact.cast("double")


def rate_pct(part: Column, whole: Column) -> Column:
    """Percentage to one decimal, halves up; NULL for an empty whole."""
    return F.round(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), 1)


def credit_band(
    score: Column,
    bands: Sequence[tuple[float, str]] = V.CREDIT_BANDS,
    below: str = V.CREDIT_BAND_BELOW,
    unknown: str = V.CREDIT_BAND_UNKNOWN,
) -> Column:
    """Label of the first band whose lowest score is reached (F8, A9). A score that is no number is unknown."""
    band = F.when(score.isNull() | F.isnan(score.cast("double")), unknown)
    for lowest, label in bands:
        band = band.when(score >= lowest, label)
    return band.otherwise(below)


def due_month(due_date: Column) -> Column:
    """``YYYY-MM`` of an ISO date text (F2)."""
    return F.substring(due_date, 1, 7)


def days_late(payment_date: Column, due_date: Column) -> Column:
    """Whole days from due to paid (F9, F10, F11): NULL if unpaid, 0 if not later, NULL if a later text is no date."""
    days = F.datediff(F.try_to_date(payment_date), F.try_to_date(due_date))
    return F.when(payment_date.isNull(), None).when(payment_date > due_date, days).otherwise(0).cast("int")


def half_even(value: Column, digits: int = 1) -> Column:
    """Round with ties to the even digit after scaling, as array libraries do (F7). ``rate_pct`` rounds halves up instead."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def min_max_plus_one(value: Column, lowest: Column, highest: Column) -> Column:
    """Position in the population's range; the 1 keeps the divisor positive and the result below 1."""
    return (value - lowest) / (highest - lowest + F.lit(1))


def risk_tier(score: Column, scheme: str = "code", tiers: Sequence[tuple[float, str]] = V.RISK_TIERS) -> Column:
    """Tier label of a score (F13, R4). ``scheme`` is ``code`` (right-closed bins, NULL outside) or ``documented``."""
    if scheme == "documented":
        low, moderate, high = V.DOCUMENTED_TIERS
        return (
            F.when(score < V.DOCUMENTED_LOW_BELOW, low)
            .when(score <= V.DOCUMENTED_HIGH_ABOVE, moderate)
            .when(score > V.DOCUMENTED_HIGH_ABOVE, high)
        )
    if scheme != "code":
        raise ValueError(f"unknown tier scheme {scheme!r}")
    tier = F.when(score < 0, None)
    for highest, label in tiers:
        tier = tier.when(score <= highest, label)
    return tier


def tier_labels(scheme: str = "code") -> list[str]:
    return list(V.DOCUMENTED_TIERS) if scheme == "documented" else [label for _, label in V.RISK_TIERS]
