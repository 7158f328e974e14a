"""The star schema: one fact table and one dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.bars import dollar_volume, percent_change
from daybook.operators.series import ROWS_PER_SLICE, SERIES_ORDER, session_measures
from daybook.schemas import DIM_TICKERS, FCT_DAILY_PRICES


def measured_bars(stg: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """The columns of the fact table and the lineage that orders a series."""
    given = [c for c in FCT_DAILY_PRICES if c in stg.columns]
    lineage = [c for c in SERIES_ORDER if c not in given]
    measured = session_measures(stg.select(*given, *lineage), rows_per_slice)
    return measured.withColumns(
        {
            "daily_return_pct": percent_change(F.col("close"), F.col("prior_close")),
            "dollar_volume": dollar_volume(F.col("vwap"), F.col("close"), F.col("volume")),
        }
    ).select(*FCT_DAILY_PRICES, *lineage)


def fct_daily_prices(stg: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """What happened per ticker and session, with measures against its neighbours.

    ``stg`` should be a table: it is scanned once for series lengths, once for
    the windows.
    """
    return measured_bars(stg, rows_per_slice).select(*FCT_DAILY_PRICES)


def traded_by_ticker(stg: DataFrame) -> DataFrame:
    """First and last day, distinct days and rows held per ticker."""
    return stg.groupBy("ticker").agg(
        F.min("trade_date").alias("first_trade_date"),
        F.max("trade_date").alias("last_trade_date"),
        F.countDistinct("trade_date").alias("trading_days"),
        F.count("*").alias("price_rows"),
    )


def dim_tickers(reference: DataFrame, stg: DataFrame) -> DataFrame:
    """One row per ticker that is listed or has traded; the missing half is null."""
    listed = reference.select("ticker", "company_name", "sector")
    return listed.join(traded_by_ticker(stg), "ticker", "full_outer").select(*DIM_TICKERS)
