"""The read queries behind the dashboard, over the marts only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import display

# Columns of the dashboard's query.
REPORT_COLUMNS = (
    "ticker",
    "company_name",
    "sector",
    "trade_date",
    "close",
    "volume",
    "prior_close",
    "daily_return_pct",
    "moving_avg_20d",
    "high_52w",
    "low_52w",
    "dollar_volume",
    "loaded_at",
)

# Chart series names and the air left above and below them.
SERIES = {"close": "Close", "moving_avg_20d": "20-session average"}
CHART_AIR = 0.04


def report_rows(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts with their company and sector, unsorted for further use."""
    return fct.join(dim.select("ticker", "company_name", "sector"), "ticker").select(*REPORT_COLUMNS)


def marts_query(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """The dashboard's one query, in reading order."""
    return report_rows(fct, dim).orderBy("ticker", "trade_date")


def catalogue(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """The tickers that have rows to show, with company and sector."""
    shown = fct.select("ticker").distinct()
    return (
        dim.join(shown, "ticker", "left_semi")
        .select("ticker", "company_name", "sector")
        .distinct()
        .orderBy("ticker")
    )


def ticker_history(rows: DataFrame, ticker: str) -> DataFrame:
    """One ticker's rows; the filter reaches the scan of the fact table."""
    return rows.filter(F.col("ticker") == ticker)


def latest_rows(rows: DataFrame) -> DataFrame:
    """The newest row of every ticker, by aggregation rather than by ranking.

    The newest day of a ticker is hashed, not sorted; only the rows of that day are
    then ordered by the remaining columns, which decide between copies the same way in
    every run. Rows without a ticker or a day are no candidates.
    """
    days = rows.groupBy("ticker").agg(F.max("trade_date").alias("newest"))
    newest = (F.col("rows.ticker") == F.col("days.ticker")) & (F.col("trade_date") == F.col("newest"))
    top = rows.alias("rows").join(days.alias("days"), newest, "left_semi")
    others = [c for c in rows.columns if c != "ticker"]
    first = ["trade_date", "loaded_at"]
    order = F.struct(*first, *[c for c in others if c not in first])
    chosen = top.groupBy("ticker").agg(F.max_by(F.struct(*others), order).alias("row"))
    return chosen.select("ticker", "row.*")


def tiles_text(latest: DataFrame) -> DataFrame:
    """The four tiles and the heading as the reader sees them."""
    return latest.select(
        "ticker",
        F.concat(
            display.label(F.col("ticker"), F.col("company_name")),
            F.lit(" - "),
            display.long_date(F.col("trade_date")),
        ).alias("heading"),
        display.money(F.col("close")).alias("close_text"),
        display.signed_percent(F.col("daily_return_pct")).alias("change_text"),
        display.money(F.col("high_52w")).alias("high_52w_text"),
        display.money(F.col("low_52w")).alias("low_52w_text"),
        display.compact_money(F.col("dollar_volume")).alias("dollar_volume_text"),
    )


def chart_series(rows: DataFrame) -> DataFrame:
    """Long form of the chart's lines; the average's missing start stays null."""
    named = rows.select("ticker", "trade_date", *[F.col(c).alias(n) for c, n in SERIES.items()])
    return named.unpivot(["ticker", "trade_date"], list(SERIES.values()), "series", "value")


def chart_domain(rows: DataFrame) -> DataFrame:
    """Per ticker, the value axis: both lines plus four percent of air."""

    def over_lines(aggregate, pick) -> Column:
        return pick(*[aggregate(c) for c in SERIES])

    bounds = rows.groupBy("ticker").agg(
        over_lines(F.min, F.least).alias("lowest"), over_lines(F.max, F.greatest).alias("highest")
    )
    air = (F.col("highest") - F.col("lowest")) * CHART_AIR
    return bounds.select(
        "ticker",
        (F.col("lowest") - air).alias("domain_low"),
        (F.col("highest") + air).alias("domain_high"),
    )


def data_as_of(rows: DataFrame) -> DataFrame:
    """Newest session and newest load."""
    return rows.agg(
        F.max("trade_date").alias("latest_trade_date"), F.max("loaded_at").alias("latest_load")
    )


def to_pandas(rows: DataFrame, max_rows: int = 1_000_000):
    """A report as pandas over Arrow, refused when it is too long for a client.

    Rows are counted first, so that a refused report is never fetched.
    """
    if rows.count() > max_rows:
        raise ValueError(f"more than {max_rows} rows; filter the report before fetching it")
    return rows.select(*[F.col(c).alias(c.lower()) for c in rows.columns]).toPandas()
