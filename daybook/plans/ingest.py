"""From landed provider responses to day partitions."""

from __future__ import annotations

import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.bars import MARKET_ZONE
from daybook.operators.upsert import merge_counts, merge_days
from daybook.plans.manifests import (
    append_manifest,
    finished_at,
    ingest_manifest,
    run_name,
    ticker_outcomes,
    with_reasons,
)
from daybook.schemas import LANDED_FIELDS
from daybook.scratch import settle, settled_inside
from daybook.sources.commits import DaysChanged, newest_snapshot
from daybook.sources.ledger import path_exists
from daybook.sources.day_files import among_days, read_day_lines, write_days
from daybook.sources.responses import (
    bars_to_rows,
    envelope_bars,
    envelope_states,
    land_responses,
    read_landed_envelopes,
)

# Trailing days of a daily run and of a first load.
DAILY_DAYS = 7
BACKFILL_DAYS = 730

# How often a run merges its rows anew because others committed the same days.
ATTEMPTS = 5


def market_date(utc: datetime.datetime) -> datetime.date:
    """Which trading day a UTC instant falls on."""
    return utc.replace(tzinfo=datetime.timezone.utc).astimezone(ZoneInfo(MARKET_ZONE)).date()


def in_window(trade_date: Column, as_of: Column, days_back: int) -> Column:
    """Trade dates from ``as_of - days_back`` to ``as_of``, both included."""
    return trade_date.between(F.date_sub(as_of, days_back), as_of)


def undatable_tickers(rows: DataFrame) -> DataFrame:
    """Tickers that sent a bar without a time."""
    return rows.filter(F.col("trade_date").isNull()).select("ticker").distinct()


def usable_rows(rows: DataFrame, universe: DataFrame) -> DataFrame:
    """Rows of requested tickers, without any ticker that sent an undatable bar."""
    requested = universe.select("ticker").distinct()
    kept = rows.join(undatable_tickers(rows), "ticker", "left_anti")
    return kept.join(requested, "ticker", "left_semi")


def upsert_days(spark: SparkSession, root: str, rows: DataFrame) -> dict[str, int]:
    """Merge received rows into the day partitions and replace the changed days at once.

    Where another run commits one of these days in between, the rows are merged anew with
    what it wrote.
    """
    days = rows.select("trade_date").distinct()
    touched = among_days(days, "trade_date")
    if touched is None:
        return {"dates_touched": 0, "dates_rewritten": 0}
    read = [r.day for r in days.select(F.col("trade_date").cast("string").alias("day")).collect() if r.day]
    for attempt in range(ATTEMPTS):
        base = newest_snapshot(spark, root)
        if path_exists(spark, root):
            old = read_day_lines(spark, root, touched).join(days, "trade_date", "left_semi")
        else:
            old = rows.select(*LANDED_FIELDS).limit(0)
        # Settled, because the files it was read from may be replaced.
        merged = settle(merge_days(old, rows), "merged-days")
        counts = merge_counts(merged, rows).first()
        try:
            if counts["dates_rewritten"]:
                changed = merged.filter("changed").select("trade_date").distinct()
                write_days(merged.join(changed, "trade_date", "left_semi"), root, base=base, read=read)
            break
        except DaysChanged:
            if attempt == ATTEMPTS - 1:
                raise
    return {k: int(counts[k] or 0) for k in ("dates_touched", "dates_rewritten")}


def ingest(
    spark: SparkSession,
    responses: DataFrame,
    universe: DataFrame,
    root: str,
    started_at: datetime.datetime,
    days_back: int = DAILY_DAYS,
    mode: str = "daily",
    as_of: datetime.date | None = None,
) -> dict:
    """One run: keep the responses, merge their bars, write the manifest.

    ``responses`` has a ``value`` column with one response document per row.
    They are kept before anything is derived, and read back from where they were
    kept. Returns the manifest with the merge counts. An empty universe is an error.
    """
    with settled_inside(spark):
        run = run_name(started_at)
        as_of = as_of or market_date(started_at)
        if universe.isEmpty():
            raise ValueError("the universe is empty: there is nothing to ask for")
        kept = read_landed_envelopes(spark, land_responses(responses, f"{root}/_raw", run))
        stamp = started_at.strftime("%Y-%m-%dT%H:%M:%S+00:00")
        window = in_window(F.col("trade_date"), F.lit(as_of), days_back)
        rows = bars_to_rows(envelope_bars(kept), stamp)
        rows = settle(rows.filter(window | F.col("trade_date").isNull()), "parsed-bars")
        received = settle(usable_rows(rows, universe), "received")
        counts = upsert_days(spark, f"{root}/days", received)
        outcomes = with_reasons(
            ticker_outcomes(received, universe), envelope_states(kept), undatable_tickers(rows)
        )
        manifest = ingest_manifest(received, universe, F.lit(as_of)).select(
            F.lit(run).alias("run_id"),
            F.lit(mode).alias("mode"),
            finished_at(),
            F.date_sub(F.lit(as_of), days_back).alias("requested_from"),
            F.lit(as_of).alias("requested_to"),
            "*",
            *[F.lit(v).alias(k) for k, v in counts.items() if k != "dates_touched"],
        )
        append_manifest(outcomes.select(F.lit(run).alias("run_id"), "*"), f"{root}/_runs/tickers")
        record = manifest.first()
        append_manifest(spark.createDataFrame([record], manifest.schema), f"{root}/_runs/ingest")
        return record.asDict()
