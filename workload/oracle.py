"""Shared parts of the SQL twins: the same inputs, written in SQL."""

from __future__ import annotations

ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"

BARS = f"""
trades AS (
    SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS trade_date,
           floor(l_extendedprice / l_quantity * 64) / 64 AS price,
           l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey
), bars AS (
    SELECT ticker, trade_date,
           first(price ORDER BY {ORDER}) AS open,
           max(price) AS high, min(price) AS low,
           last(price ORDER BY {ORDER}) AS close,
           sum(l_quantity) AS volume,
           sum(price * l_quantity) / sum(l_quantity) AS vwap,
           count(*) AS transaction_count
    FROM trades GROUP BY ticker, trade_date
)"""

PLACED = """
placed AS (
    SELECT ticker || '|' || CAST(trade_date AS VARCHAR) AS price_key, bars.*,
           CAST(trade_date + 1 AS TIMESTAMP) + INTERVAL 11 HOUR AS ingested_at_utc,
           'raw/prices/date=' || CAST(trade_date AS VARCHAR) || '/prices.jsonl' AS source_file,
           row_number() OVER (PARTITION BY trade_date ORDER BY ticker) AS file_row_number
    FROM bars
)"""

STAGED = f"""{BARS}, {PLACED}, staged AS (
    SELECT *, TIMESTAMP '2001-12-01 00:00:00' AS loaded_at FROM placed
)"""

LOADS = f"""{BARS}, {PLACED}, loads AS (
    SELECT *, TIMESTAMP '2001-12-01 00:00:00' AS loaded_at FROM placed
    UNION ALL
    SELECT * REPLACE (
               CASE WHEN length(ticker) = 7 THEN vwap + 0.0009765625 ELSE vwap END AS vwap),
           TIMESTAMP '2001-12-02 00:00:00'
    FROM placed WHERE day(trade_date) = 8
    UNION ALL
    SELECT *, TIMESTAMP '2001-12-03 00:00:00'
    FROM placed WHERE day(trade_date) = 15 AND month(trade_date) = 1
)"""

BAR = "open, high, low, close, volume, vwap, transaction_count"

FLAGGED = f"""{LOADS}, flagged AS (
    SELECT loads.*, changed.bars > 1 AS key_was_revised
    FROM loads JOIN (
        SELECT price_key, count(DISTINCT row({BAR})) AS bars FROM loads GROUP BY price_key
    ) AS changed USING (price_key)
), scoped AS (
    SELECT flagged.*, bool_or(key_was_revised) OVER (PARTITION BY source_file) AS file_was_revised
    FROM flagged
), stg AS (
    SELECT * EXCLUDE (key_was_revised, file_was_revised) FROM scoped
    QUALIFY NOT file_was_revised OR row_number() OVER (
        PARTITION BY price_key ORDER BY loaded_at DESC, source_file DESC, file_row_number DESC) = 1
)"""


def fact(source: str) -> str:
    """The fact table over a staging relation."""
    series = "PARTITION BY ticker ORDER BY trade_date, loaded_at, source_file, file_row_number"
    month = f"({series} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    year = f"({series} ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)"
    return f"""windowed AS (
    SELECT *, lag(close) OVER ({series}) AS prior_close,
           CASE WHEN count(close) OVER {month} = 20 THEN avg(close) OVER {month} END AS moving_avg_20d,
           CASE WHEN count(high) OVER {year} = 252 THEN max(high) OVER {year} END AS high_52w,
           CASE WHEN count(low) OVER {year} = 252 THEN min(low) OVER {year} END AS low_52w
    FROM {source}
), fct AS (
    SELECT price_key, ticker, trade_date, open, high, low, close, volume, vwap, transaction_count,
           prior_close,
           CASE WHEN prior_close <> 0 THEN (close - prior_close) / prior_close * 100 END
               AS daily_return_pct,
           moving_avg_20d, high_52w, low_52w,
           coalesce(vwap, close) * volume AS dollar_volume, loaded_at
    FROM windowed
)"""


REFERENCE = """
reference AS (
    SELECT ticker, 'Maker ' || CAST(n AS VARCHAR) || ', Inc.' AS company_name,
           (['Communication Services', 'Consumer Discretionary', 'Consumer Staples', 'Energy',
             'Financials', 'Health Care', 'Industrials', 'Information Technology'])[n % 8 + 1]
               AS sector
    FROM (
        SELECT ticker, CAST(split_part(ticker, '#', 2) AS INTEGER) AS n
        FROM (SELECT DISTINCT p_brand AS ticker FROM part WHERE p_brand <> 'Brand#25'
              UNION ALL SELECT 'Brand#99')
    )
)"""


def dim(source: str) -> str:
    """The dimension over the reference and a staging relation."""
    return f"""{REFERENCE}, dim AS (
    SELECT coalesce(reference.ticker, traded.ticker) AS ticker, company_name, sector,
           first_trade_date, last_trade_date, trading_days, price_rows
    FROM reference FULL OUTER JOIN (
        SELECT ticker, min(trade_date) AS first_trade_date, max(trade_date) AS last_trade_date,
               count(DISTINCT trade_date) AS trading_days, count(*) AS price_rows
        FROM {source} GROUP BY ticker
    ) AS traded ON reference.ticker = traded.ticker
)"""


MARTS = f"{STAGED}, {fact('staged')}, {dim('staged')}"

REPORT = f"""{MARTS}, report AS (
    SELECT fct.ticker, company_name, sector, trade_date, close, volume, prior_close,
           daily_return_pct, moving_avg_20d, high_52w, low_52w, dollar_volume, loaded_at
    FROM fct JOIN dim ON fct.ticker = dim.ticker
)"""

FAULTY = f"""{STAGED}, faulty AS (
    SELECT * EXCLUDE (open, high, low, close, volume, file_row_number, hit),
           CASE WHEN hit = 11 THEN NULL ELSE open END AS open,
           CASE WHEN hit = 3 THEN low - 1 ELSE high END AS high,
           CASE WHEN hit IN (7, 11) THEN -low ELSE low END AS low,
           CASE WHEN hit = 9 THEN NULL ELSE close END AS close,
           CASE WHEN hit = 5 THEN -volume ELSE volume END AS volume,
           file_row_number + 100 * c AS file_row_number
    FROM (
        SELECT *, CASE WHEN ticker LIKE 'Brand#1_' THEN day(trade_date) ELSE 0 END AS hit
        FROM staged
    ) JOIN (SELECT unnest([0, 1, 2]) AS c) ON c = 0 OR hit = 17
)"""

CONTRADICTION = """
    high < low OR high < open OR high < close OR low > open OR low > close
    OR (open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
        AND least(open, high, low, close) <= 0)
    OR volume < 0"""


def text(sql: str, *columns: str, ctes: str = "") -> str:
    """``sql`` with the named day and instant columns as text."""
    with_part = f"WITH {ctes} " if ctes else ""
    if not columns:
        return f"{with_part}{sql}"
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
    return f"{with_part}SELECT * REPLACE ({casts}) FROM ({sql})"
