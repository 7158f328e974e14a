"""Text for readers. An absent number is an em dash, never a zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mark for an absent number and the compaction steps.
ABSENT = "—"
STEPS = ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K"))


def _or_absent(value: Column, text: Column) -> Column:
    number = value.cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(ABSENT)).otherwise(text)


def money(value: Column, places: int = 2) -> Column:
    """``$1,234.50``"""
    return _or_absent(value, F.concat(F.lit("$"), F.format_number(value.cast("double"), places)))


def compact_money(value: Column) -> Column:
    """``$1.23B``: scaled to the largest step the amount reaches."""
    number = value.cast("double")
    text = F.format_number(number, 0)
    for cutoff, suffix in reversed(STEPS):
        scaled = F.concat(F.format_number(number / cutoff, 2), F.lit(suffix))
        text = F.when(F.abs(number) >= cutoff, scaled).otherwise(text)
    return _or_absent(value, F.concat(F.lit("$"), text))


def signed_percent(value: Column) -> Column:
    """``+1.23%``; null when there is nothing to compare with."""
    digits = F.translate(F.format_number(value.cast("double"), 2), ",", "")
    sign = F.when(digits.startswith("-"), F.lit("")).otherwise(F.lit("+"))
    return F.concat(sign, digits, F.lit("%"))


def long_date(day: Column) -> Column:
    """``04 Nov 2001``"""
    return F.date_format(day, "dd MMM yyyy")


def label(ticker: Column, company: Column) -> Column:
    """``TICKER - Company``"""
    return F.concat(ticker, F.lit(" - "), F.coalesce(company, F.lit(ABSENT)))
