"""Counts that say what a table holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.bars import price_key


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row aggregates as one row, without joining them."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def table_measure(rows: DataFrame) -> DataFrame:
    """Rows, files, distinct keys, tickers and days of a table of loads.

    Keys are counted from one narrow aggregate instead of several DISTINCT
    counts in one pass, which would copy every row once per count.
    """
    key = price_key(F.col("ticker"), F.col("trade_date"))
    per_key = rows.groupBy("ticker", "trade_date").agg(F.count("*").alias("n"))
    by_key = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_total"),
        F.count(key).alias("distinct_keys"),
        F.countDistinct("ticker").alias("tickers"),
        F.min("trade_date").alias("first_day"),
        F.max("trade_date").alias("last_day"),
    )
    files = rows.agg(F.countDistinct("source_file").alias("files_total"))
    return side_by_side(by_key, files).select(
        "rows_total", "files_total", "distinct_keys", "tickers", "first_day", "last_day"
    )


def rows_per_date(rows: DataFrame) -> DataFrame:
    """Per trade date, how many bars and how many tickers.

    Which tickers they are stays in the rows: a list per date would gather one
    date's tickers into a single value.
    """
    return rows.groupBy("trade_date").agg(
        F.count("*").alias("bars"), F.countDistinct("ticker").alias("tickers")
    )


def numeric_profile(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Per column: rows, nulls and the share of values with a fraction, in one pass."""
    fractional = {c: (F.col(c) != F.floor(c)).cast("int") for c in columns}
    totals = rows.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
        *[F.avg(fractional[c]).alias(f"{c}_share") for c in columns],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"{c}_nulls").alias("null_count"),
                F.col(f"{c}_share").alias("fractional_share"),
            )
            for c in columns
        ]
    )
    return totals.select(F.inline(entries))


def session_numbers(rows: DataFrame) -> DataFrame:
    """(trade_date, session): the distinct days numbered from 1.

    This is the one window without a partition. It holds a row per calendar day
    on which anything traded, some 25,000 per century whatever the data volume.
    """
    days = rows.select("trade_date").filter(F.col("trade_date").isNotNull()).distinct()
    return days.select(
        "trade_date", F.row_number().over(Window.orderBy("trade_date")).alias("session")
    )


def grid_gaps(rows: DataFrame, universe: DataFrame) -> DataFrame:
    """(ticker, trade_date) cells of the tickers-by-sessions grid without a bar.

    Only the gaps are generated: each ticker's sessions are numbered, and the
    numbers skipped between neighbours, before the first and after the last are
    expanded. After ``distinct`` a ticker has one row per day at most.
    """
    sessions = session_numbers(rows)
    last = sessions.agg(F.max("session").alias("last_session"))
    present = rows.select("ticker", "trade_date").distinct().join(sessions, "trade_date")
    by_ticker = Window.partitionBy("ticker").orderBy("session")
    between = present.select(
        "ticker",
        (F.coalesce(F.lag("session").over(by_ticker), F.lit(0)) + 1).alias("from_session"),
        (F.col("session") - 1).alias("to_session"),
    ).join(universe.select("ticker"), "ticker", "left_semi")
    newest = present.groupBy("ticker").agg(F.max("session").alias("newest"))
    after = universe.select("ticker").join(newest, "ticker", "left").select(
        "ticker", (F.coalesce("newest", F.lit(0)) + 1).alias("from_session")
    )
    after = after.withColumn("to_session", F.lit(last.first()["last_session"] or 0))
    runs = between.unionByName(after).filter(F.col("from_session") <= F.col("to_session"))
    missing = runs.select(
        "ticker", F.explode(F.sequence("from_session", "to_session")).alias("session")
    )
    return missing.join(sessions, "session").select("ticker", "trade_date")


def short_dates(rows: DataFrame, universe: DataFrame) -> DataFrame:
    """Days holding fewer tickers than the universe has, with the shortfall."""
    expected = universe.select("ticker").distinct().count()
    held = rows.join(universe.select("ticker"), "ticker", "left_semi")
    return (
        held.groupBy("trade_date")
        .agg(F.countDistinct("ticker").alias("tickers"))
        .filter(F.col("tickers") < expected)
        .withColumn("missing", F.lit(expected) - F.col("tickers"))
    )


def ticker_start_check(fct: DataFrame) -> DataFrame:
    """One row: missing prior closes equal tickers when windows stay per ticker."""
    return fct.agg(
        F.count_if(F.col("prior_close").isNull()).alias("prior_close_nulls"),
        F.countDistinct("ticker").alias("tickers"),
    ).withColumn("windows_stay_in_ticker", F.col("prior_close_nulls") == F.col("tickers"))
