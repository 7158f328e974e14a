"""The fact table, its measures one by one, the dimension and the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions.bars import dollar_volume, percent_change
from daybook.operators import measures
from daybook.operators.series import session_measures
from daybook.plans import marts, reports
from daybook.plans.staging import stg_prices
from daybook.scratch import settle
from workload import inputs
from workload.oracle import BARS, FLAGGED, MARTS, REPORT, STAGED, dim, fact, text
from workload.registry import query

GRAIN = ("ticker", "trade_date")


def staged_measures(spark, sf):
    return session_measures(inputs.staged_once(spark, sf))


FACT = f"{STAGED}, {fact('staged')}"


@query("prior_close", text("SELECT ticker, trade_date, close, prior_close FROM fct", "trade_date", ctes=FACT))
def prior_close(spark, sf):
    return staged_measures(spark, sf).select(*GRAIN, "close", "prior_close")


@query("moving_avg_20d", text("SELECT ticker, trade_date, moving_avg_20d FROM fct", "trade_date", ctes=FACT))
def moving_avg_20d(spark, sf):
    return staged_measures(spark, sf).select(*GRAIN, "moving_avg_20d")


@query("high_52w", text("SELECT ticker, trade_date, high_52w FROM fct", "trade_date", ctes=FACT))
def high_52w(spark, sf):
    return staged_measures(spark, sf).select(*GRAIN, "high_52w")


@query("low_52w", text("SELECT ticker, trade_date, low_52w FROM fct", "trade_date", ctes=FACT))
def low_52w(spark, sf):
    return staged_measures(spark, sf).select(*GRAIN, "low_52w")


@query("daily_return", text("SELECT ticker, trade_date, daily_return_pct FROM fct", "trade_date", ctes=FACT))
def daily_return(spark, sf):
    change = percent_change(F.col("close"), F.col("prior_close"))
    return staged_measures(spark, sf).select(*GRAIN, change.alias("daily_return_pct"))


@query(
    "dollar_volume",
    text(
        """SELECT ticker, trade_date,
                  coalesce(CASE WHEN transaction_count % 2 = 1 THEN vwap END, close) * volume
                      AS dollar_volume FROM bars""",
        "trade_date", ctes=BARS,
    ),
)
def dollar_volume_query(spark, sf):
    sent = F.when(F.col("transaction_count") % 2 == 1, F.col("vwap"))
    value = dollar_volume(sent, F.col("close"), F.col("volume"))
    return inputs.daily_bars(spark, sf).select(*GRAIN, value.alias("dollar_volume"))


@query("fct_daily_prices", text("SELECT * FROM fct", "trade_date", "loaded_at", ctes=FACT))
def fct_daily_prices(spark, sf):
    return marts.fct_daily_prices(inputs.staged_once(spark, sf))


@query(
    "fct_daily_prices_sliced",
    text("SELECT * FROM fct", "trade_date", "loaded_at", ctes=f"{FLAGGED}, {fact('stg')}"),
)
def fct_daily_prices_sliced(spark, sf):
    """From raw rows with reloads, every series cut into slices as if too long for one task."""
    staged = settle(stg_prices(inputs.raw_table(spark, sf)), "staged")
    return marts.fct_daily_prices(staged, rows_per_slice=800)


@query(
    "traded_by_ticker",
    text(
        """SELECT ticker, min(trade_date) AS first_trade_date, max(trade_date) AS last_trade_date,
                  count(DISTINCT trade_date) AS trading_days, count(*) AS price_rows
           FROM stg GROUP BY ticker""",
        "first_trade_date", "last_trade_date", ctes=FLAGGED,
    ),
)
def traded_by_ticker(spark, sf):
    return marts.traded_by_ticker(stg_prices(inputs.raw_table(spark, sf)))


@query(
    "dim_tickers",
    text("SELECT * FROM dim", "first_trade_date", "last_trade_date", ctes=f"{FLAGGED}, {dim('stg')}"),
)
def dim_tickers(spark, sf):
    return marts.dim_tickers(inputs.reference(spark, sf), stg_prices(inputs.raw_table(spark, sf)))


@query(
    "prior_close_null_check",
    f"""WITH {FACT} SELECT count_if(prior_close IS NULL) AS prior_close_nulls,
            count(DISTINCT ticker) AS tickers,
            count_if(prior_close IS NULL) = count(DISTINCT ticker) AS windows_stay_in_ticker FROM fct""",
)
def prior_close_null_check(spark, sf):
    return measures.ticker_start_check(marts.fct_daily_prices(inputs.staged_once(spark, sf)))


def star(spark, sf):
    staged = inputs.staged_once(spark, sf)
    return marts.fct_daily_prices(staged), marts.dim_tickers(inputs.reference(spark, sf), staged)


def report_rows(spark, sf):
    return reports.report_rows(*star(spark, sf))


@query("marts_query", text("SELECT * FROM report", "trade_date", "loaded_at", ctes=REPORT))
def marts_query(spark, sf):
    return reports.marts_query(*star(spark, sf))


@query("catalogue", f"WITH {REPORT} SELECT DISTINCT ticker, company_name, sector FROM report")
def catalogue(spark, sf):
    fct, dimension = star(spark, sf)
    return reports.catalogue(dimension, fct)


@query(
    "ticker_history",
    text("SELECT * FROM report WHERE ticker = 'Brand#12'", "trade_date", "loaded_at", ctes=REPORT),
)
def ticker_history(spark, sf):
    return reports.ticker_history(report_rows(spark, sf), "Brand#12")


LATEST = f"""{REPORT}, latest AS (
    SELECT * FROM report
    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC, loaded_at DESC) = 1
)"""


@query("latest_tiles", text("SELECT * FROM latest", "trade_date", "loaded_at", ctes=LATEST))
def latest_tiles(spark, sf):
    return reports.latest_rows(report_rows(spark, sf))


def money_sql(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '—' ELSE '$' || format('{{:,.2f}}', {column}) END"


@query(
    "latest_tiles_text",
    f"""WITH {LATEST} SELECT ticker,
            ticker || ' - ' || coalesce(company_name, '—') || ' - ' || strftime(trade_date, '%d %b %Y')
                AS heading,
            {money_sql('close')} AS close_text,
            CASE WHEN daily_return_pct IS NOT NULL THEN format('{{:+.2f}}%', daily_return_pct) END
                AS change_text,
            {money_sql('high_52w')} AS high_52w_text,
            {money_sql('low_52w')} AS low_52w_text,
            CASE WHEN dollar_volume IS NULL THEN '—'
                 WHEN abs(dollar_volume) >= 1e12 THEN '$' || format('{{:,.2f}}T', dollar_volume / 1e12)
                 WHEN abs(dollar_volume) >= 1e9 THEN '$' || format('{{:,.2f}}B', dollar_volume / 1e9)
                 WHEN abs(dollar_volume) >= 1e6 THEN '$' || format('{{:,.2f}}M', dollar_volume / 1e6)
                 WHEN abs(dollar_volume) >= 1e3 THEN '$' || format('{{:,.2f}}K', dollar_volume / 1e3)
                 ELSE '$' || format('{{:,.0f}}', dollar_volume) END AS dollar_volume_text
        FROM latest""",
)
def latest_tiles_text(spark, sf):
    return reports.tiles_text(reports.latest_rows(report_rows(spark, sf)))


@query(
    "chart_series",
    text(
        """SELECT ticker, trade_date, 'Close' AS series, close AS value FROM report
           UNION ALL
           SELECT ticker, trade_date, '20-session average', moving_avg_20d FROM report""",
        "trade_date", ctes=REPORT,
    ),
)
def chart_series(spark, sf):
    return reports.chart_series(report_rows(spark, sf))


@query(
    "chart_domain",
    f"""WITH {REPORT}, bounds AS (
            SELECT ticker, least(min(close), coalesce(min(moving_avg_20d), min(close))) AS lo,
                   greatest(max(close), coalesce(max(moving_avg_20d), max(close))) AS hi
            FROM report GROUP BY ticker
        ) SELECT ticker, lo - (hi - lo) * CAST(0.04 AS DOUBLE) AS domain_low,
                 hi + (hi - lo) * CAST(0.04 AS DOUBLE) AS domain_high FROM bounds""",
)
def chart_domain(spark, sf):
    return reports.chart_domain(report_rows(spark, sf))


@query(
    "data_as_of",
    text(
        "SELECT max(trade_date) AS latest_trade_date, max(loaded_at) AS latest_load FROM report",
        "latest_trade_date", "latest_load", ctes=REPORT,
    ),
)
def data_as_of(spark, sf):
    return reports.data_as_of(report_rows(spark, sf))


@query(
    "rows_per_date",
    text(
        """SELECT trade_date, count(*) AS bars, count(DISTINCT ticker) AS tickers
           FROM bars GROUP BY trade_date""",
        "trade_date", ctes=BARS,
    ),
)
def rows_per_date(spark, sf):
    return measures.rows_per_date(inputs.daily_bars(spark, sf))


PROFILED = ("open", "close", "volume", "vwap", "prior_close", "moving_avg_20d", "high_52w")


@query(
    "profile_columns",
    f"WITH {FACT} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count_if({c} IS NULL) AS null_count,
                   avg(CASE WHEN {c} <> floor({c}) THEN 1 WHEN {c} = floor({c}) THEN 0 END)
                       AS fractional_share FROM fct"""
        for c in PROFILED
    ),
)
def profile_columns(spark, sf):
    return measures.numeric_profile(marts.fct_daily_prices(inputs.staged_once(spark, sf)), PROFILED)


@query(
    "grid_gaps",
    text(
        f"""SELECT t.ticker, d.trade_date FROM reference AS t, (SELECT DISTINCT trade_date FROM bars) AS d
            WHERE NOT EXISTS (SELECT 1 FROM bars
                              WHERE bars.ticker = t.ticker AND bars.trade_date = d.trade_date)""",
        "trade_date", ctes=f"{MARTS}",
    ),
)
def grid_gaps(spark, sf):
    bars = inputs.daily_bars(spark, sf).select(*GRAIN)
    return measures.grid_gaps(settle(bars, "bars"), inputs.reference(spark, sf))


@query(
    "short_dates",
    text(
        """SELECT trade_date, count(DISTINCT ticker) AS tickers,
                  (SELECT count(*) FROM reference) - count(DISTINCT ticker) AS missing
           FROM bars WHERE ticker IN (SELECT ticker FROM reference)
           GROUP BY trade_date
           HAVING count(DISTINCT ticker) < (SELECT count(*) FROM reference)""",
        "trade_date", ctes=MARTS,
    ),
)
def short_dates(spark, sf):
    return measures.short_dates(inputs.daily_bars(spark, sf), inputs.reference(spark, sf))
