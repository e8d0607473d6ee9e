"""Code -> label expressions, null defaults, number formatting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Labels of vendor and payment codes.
VENDORS = {1: "Creative Mobile Technologies, LLC", 2: "VeriFone Inc."}
PAYMENT_FORMS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}


def label(code: Column, labels: Mapping, default: str | None = None) -> Column:
    """CASE over a small fixed mapping; NULL (or ``default``) for other codes."""
    result = None
    for value, text in labels.items():
        result = (F if result is None else result).when(code == value, F.lit(text))
    if result is None:
        return F.lit(default).cast("string")
    return result if default is None else result.otherwise(F.lit(default))


def vendor_name(code: Column) -> Column:
    return label(code, VENDORS, default="Other")


def payment_form(code: Column) -> Column:
    return label(code, PAYMENT_FORMS)


def or_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def at_most(value: Column, bound, when_null) -> Column:
    """``value <= bound`` with a stand-in for NULL."""
    return or_default(value, when_null) <= bound


def money(value: Column) -> Column:
    """Dollar text with at most two digits, halves to even: 12.5 is ``$12.5``."""
    return F.concat(F.lit("$"), F.bround(value, 2).cast("string"))


def percent_to_fraction(text: Column) -> Column:
    return F.regexp_replace(text, "%", "").try_cast("double") / 100
