"""Text cleaning expressions."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def capitalize_first(text: Column, *, trim: bool = False, lower_rest: bool = True) -> Column:
    """Raise the first letter (C3, C4, C5). Unlike ``initcap`` it never touches later words: ``MARY ANN`` -> ``Mary ann``.

    ``trim`` strips blanks first; ``lower_rest=False`` leaves everything after the first letter as it is.
    """
    if trim:
        text = F.trim(text)
    rest = F.substr(text, F.lit(2))
    return F.concat(F.upper(F.substr(text, F.lit(1), F.lit(1))), F.lower(rest) if lower_rest else rest)


def null_if_in(text: Column, tokens: Sequence[str]) -> Column:
    """NULL where the text is one of ``tokens``."""
    return F.when(~text.isin(*tokens), text)


def full_name(first: Column, last: Column) -> Column:
    """First and last name with one blank between; NULL if either is NULL."""
    return F.concat(first, F.lit(" "), last)


def plain_money(amount: Column) -> Column:
    """Money as plain decimal text, two decimals where they lose nothing, never with an exponent."""
    cents = amount.try_cast("decimal(18,2)")
    return F.when(cents.cast("double") == amount.cast("double"), cents.cast("string")).otherwise(without_exponent(amount.cast("string")))


def without_exponent(number: Column) -> Column:
    """A number's text with its digits written out: ``1.25E-7`` -> ``0.000000125``. Other texts stay as they are."""
    sign = F.regexp_extract(number, r"^(-?)", 1)
    digits = F.translate(F.regexp_extract(number, r"^-?([0-9.]+)E", 1), ".", "")
    point = F.length(F.regexp_extract(number, r"^-?([0-9]+)", 1)) + F.regexp_extract(number, r"E([-+]?[0-9]+)$", 1).try_cast("int")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    large = F.concat(F.rpad(digits, F.greatest(point, F.length(digits)), F.lit("0")))
    mixed = F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1))
    written = F.when(point <= 0, small).when(point >= F.length(digits), large).otherwise(F.regexp_replace(mixed, r"\.0*$", ""))
    return F.when(number.rlike(r"^-?[0-9.]+E[-+]?[0-9]+$"), F.concat(sign, written)).otherwise(number)
