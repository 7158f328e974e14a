"""Scalar expressions over bars: casts, keys, comparisons and measures."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the zone that decides which trading day an instant falls on.
MARKET_ZONE = "America/New_York"


def epoch_ms_to_date(ms: Column) -> Column:
    """UTC date of an instant given in epoch milliseconds."""
    return utc_ntz(F.timestamp_millis(ms)).cast("date")


def utc_ntz(instant: Column) -> Column:
    """An instant (or its text with an offset) as UTC wall time without a zone."""
    local = instant.cast("timestamp").cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def utc_literal(instant: datetime.datetime) -> Column:
    """A Python UTC wall time as a literal.

    Passed as text, since a naive datetime literal is read in the driver's own zone.
    """
    return F.lit(instant.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def trading_day(utc_wall_time: Column) -> Column:
    """Date in the market's zone of a UTC wall time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(MARKET_ZONE), utc_wall_time).cast("date")


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def price_key(ticker: Column, trade_date: Column) -> Column:
    """Grain of the bar tables as one column; null when either part is."""
    return F.concat(ticker, F.lit("|"), trade_date.cast("string"))


def bar_fingerprint(numbers: Iterable[Column]) -> Column:
    """64-bit hash of a bar's numbers.

    The hash function skips nulls, so each number is paired with its null flag:
    a null that moves from one column to another changes the fingerprint.
    """
    return F.xxhash64(*[part for n in numbers for part in (n, n.isNull())])


def same_bar(left: Column, right: Column, fields: Iterable[str]) -> Column:
    """True when two structs agree on every field, null equal to null."""
    return reduce(
        lambda acc, name: acc & left[name].eqNullSafe(right[name]), fields, F.lit(True)
    )


def percent_change(value: Column, prior: Column) -> Column:
    """Unrounded percent change; null without a prior value or with a zero one."""
    return F.when(prior.isNotNull() & (prior != 0), (value - prior) / prior * 100)


def dollar_volume(vwap: Column, close: Column, volume: Column) -> Column:
    """Notional traded, at the close where no average price was sent."""
    return F.coalesce(vwap, close) * volume


def latency_seconds(loaded_at: Column, ingested_at_utc: Column) -> Column:
    """Whole seconds from the provider's answer to the load, both UTC wall time."""
    return F.timestamp_diff("SECOND", ingested_at_utc, loaded_at)


def lowest_if_complete(*prices: Column) -> Column:
    """Smallest of the prices, null as soon as one of them is null."""
    complete = reduce(lambda acc, p: acc & p.isNotNull(), prices, F.lit(True))
    return F.when(complete, F.least(*prices))


# The names under which contradictions are reported.
HIGH_BELOW_LOW = "high is below low"
HIGH_BELOW_OPEN_OR_CLOSE = "high is below open or close"
LOW_ABOVE_OPEN_OR_CLOSE = "low is above open or close"
PRICE_NOT_POSITIVE = "a price is zero or negative"
VOLUME_NEGATIVE = "volume is negative"


def contradictions() -> dict[str, Column]:
    """Rules a bar cannot break and still be a bar, by the name reported for them."""
    open_, high, low, close = (F.col(c) for c in ("open", "high", "low", "close"))
    return {
        HIGH_BELOW_LOW: high < low,
        HIGH_BELOW_OPEN_OR_CLOSE: (high < open_) | (high < close),
        LOW_ABOVE_OPEN_OR_CLOSE: (low > open_) | (low > close),
        PRICE_NOT_POSITIVE: lowest_if_complete(open_, high, low, close) <= 0,
        VOLUME_NEGATIVE: F.col("volume") < 0,
    }


def object_key(prefix: str, trade_date: Column) -> Column:
    """Path of a day's object under a prefix."""
    return F.concat(F.lit(f"{prefix}/date="), trade_date.cast("string"), F.lit("/prices.jsonl"))


def run_id(instant: Column) -> Column:
    """Name of a run: its UTC start, to the minute."""
    return F.date_format(instant, "yyyy-MM-dd'T'HHmm")
