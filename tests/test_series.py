"""Session windows against plain Python, and cut series against whole ones."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import measures
from daybook.operators.series import MEASURES, positioned, session_measures, sliced_measures
from daybook.plans.marts import dim_tickers, fct_daily_prices
from daybook.schemas import DIM_TICKERS, FCT_DAILY_PRICES
from helpers import DAY, day, load, rows_of, staged, staged_row


def by_hand(rows):
    """Measures of (ticker, date, loaded, line, high, low, close) tuples."""
    series = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2], r[3])):
        series.setdefault(r[0], []).append(r)
    out = []
    for bars in series.values():
        for i, r in enumerate(bars):
            def window(n, column):
                values = [b[column] for b in bars[max(0, i - n + 1): i + 1] if b[column] is not None]
                return values if len(values) == n else None

            closes, highs, lows = window(20, 6), window(252, 4), window(252, 5)
            out.append((r[0], r[3], bars[i - 1][6] if i else None, sum(closes) / 20 if closes else None,
                        max(highs) if highs else None, min(lows) if lows else None))
    return sorted(out, key=lambda r: (str(r[0]), r[1]))


def random_series(seed, tickers):
    rnd, rows, line = random.Random(seed), [], 0
    for ticker, length in tickers:
        d = 0
        for _ in range(length):
            d += rnd.choice([0, 1, 1, 1, 3])
            line += 1
            value = rnd.randrange(64, 6400) / 64
            gone = rnd.random() < 0.002
            rows.append((ticker, day(d), load(rnd.randrange(3)), line, None if gone else value + 1, value - 1,
                         None if rnd.random() < 0.01 else value))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(t, d, l, f"f{n % 3}", n, h, lo, c) for t, d, l, n, h, lo, c in rows],
        "ticker string, trade_date date, loaded_at timestamp_ntz, source_file string, "
        "file_row_number bigint, high double, low double, close double",
    ).withColumn("source_file", F.lit("f"))


def result(df):
    rows = df.select("ticker", "file_row_number", *MEASURES).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (str(r[0]), r[1]))


TICKERS = [("A", 1300), ("B", 251), ("C", 252), ("D", 1), (None, 600), ("E", 505)]


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 500, 252])
def test_measures_against_plain_python(spark, rows_per_slice):
    """Whole series, some cut, and nearly all cut into slices of the least size."""
    rows = random_series(7, TICKERS)
    assert result(session_measures(frame(spark, rows), rows_per_slice)) == by_hand(rows)


def test_one_day_may_hold_most_of_a_series(spark):
    """Copies of a single day are cut like any other rows."""
    rows = [("A", DAY, load(0), n, float(n % 97), float(n % 89), float(n % 83)) for n in range(2000)]
    assert result(sliced_measures(frame(spark, rows), 2000, 300)) == by_hand(rows)


def test_positions_are_exact(spark):
    rows = random_series(3, TICKERS)
    placed = positioned(frame(spark, rows), 9).select("ticker", "file_row_number", "position").collect()
    got = {(r.ticker, r.file_row_number): r.position for r in placed}
    for ticker, length in TICKERS:
        ordered = sorted((r for r in rows if r[0] == ticker), key=lambda r: r[1:4])
        assert [got[(ticker, r[3])] for r in ordered] == list(range(length))


def test_slices_must_cover_the_longest_frame(spark):
    with pytest.raises(ValueError):
        sliced_measures(frame(spark, random_series(1, [("A", 5)])), 5, 251)


def test_fact_columns_and_guards(spark):
    bars = staged(spark, [staged_row("A", day(n), float(n)) for n in range(25)] + [staged_row("B", day(0), None)])
    fct = fct_daily_prices(bars)
    assert tuple(fct.columns) == FCT_DAILY_PRICES
    rows = {(r.ticker, r.trade_date): r for r in fct.collect()}
    assert rows["A", day(1)].daily_return_pct is None, "a prior close of zero has no return"
    assert rows["A", day(2)].daily_return_pct == 100.0
    assert rows["A", day(18)].moving_avg_20d is None and rows["A", day(19)].moving_avg_20d == 9.5
    assert rows["B", day(0)].dollar_volume is None
    check = measures.ticker_start_check(fct).first()
    assert (check.prior_close_nulls, check.tickers) == (2, 2)


def test_missing_average_price_falls_back_to_the_close(spark):
    bars = staged(spark, [staged_row("A", day(0), 10.0, vwap=None), staged_row("A", day(1), 10.0, vwap=11.0)])
    assert sorted(r.dollar_volume for r in fct_daily_prices(bars).collect()) == [1000.0, 1100.0]


def test_dimension_shows_both_kinds_of_gap(spark):
    bars = staged(spark, [staged_row("A", day(0)), staged_row("A", day(0)), staged_row("X", day(1))])
    listed = spark.createDataFrame([("A", "Aye", "Energy"), ("Z", "Zed", "Energy")], "ticker string, company_name string, sector string")
    dim = dim_tickers(listed, bars)
    assert tuple(dim.columns) == DIM_TICKERS
    assert rows_of(dim, "ticker", "company_name", "trading_days", "price_rows") == [
        ("A", "Aye", 1, 2), ("X", None, 1, 1), ("Z", "Zed", None, None)]


def test_grid_gaps_by_hand(spark):
    held = [("A", 0), ("A", 1), ("A", 4), ("B", 2), ("B", 2)]
    bars = spark.createDataFrame([(t, day(d)) for t, d in held], "ticker string, trade_date date")
    universe = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    sessions = {d for _, d in held}
    want = {(t, day(d)) for t in "ABC" for d in sessions if (t, d) not in held}
    assert set(rows_of(measures.grid_gaps(bars, universe))) == want
