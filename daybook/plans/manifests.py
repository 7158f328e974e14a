"""Run records: what was received, published and loaded, as appended JSON rows."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.bars import utc_ntz
from daybook.operators.measures import side_by_side
from daybook.schemas import USABLE_STATES


def append_manifest(rows: DataFrame, path: str) -> None:
    """Add a run's record to the ones before it."""
    rows.write.mode("append").option("ignoreNullFields", False).json(path)


def ticker_outcomes(received: DataFrame, universe: DataFrame) -> DataFrame:
    """(ticker, bars, outcome) per requested symbol; no bars at all is a failure.

    The lists of succeeded and failed tickers are kept as rows, which a long
    universe cannot turn into an oversized single record.
    """
    bars = received.groupBy("ticker").agg(F.count("*").alias("bars"))
    return (
        universe.select("ticker")
        .distinct()
        .join(bars, "ticker", "left")
        .select(
            "ticker",
            F.coalesce("bars", F.lit(0)).alias("bars"),
            F.when(F.col("bars") > 0, "succeeded").otherwise("failed").alias("outcome"),
        )
    )


def with_reasons(outcomes: DataFrame, states: DataFrame, undatable: DataFrame) -> DataFrame:
    """Adds why each failed ticker failed, from (ticker, status) of the responses."""
    answered = states.groupBy("ticker").agg(F.max("status").alias("status"))
    undated = undatable.select("ticker", F.lit(True).alias("undated")).distinct()
    state = F.coalesce("status", F.lit("none"))
    reason = (
        F.when(F.col("outcome") == "succeeded", F.lit(None))
        .when(~state.isin(*USABLE_STATES), F.concat(F.lit("response status "), state))
        .when(F.col("undated"), "a bar without a time")
        .otherwise("no bars in the window")
    )
    joined = outcomes.join(answered, "ticker", "left").join(undated, "ticker", "left")
    return joined.select("ticker", "bars", "outcome", reason.alias("reason"))


def failed_tickers(received: DataFrame, universe: DataFrame) -> DataFrame:
    """Requested symbols without a single bar in the window."""
    wanted = universe.select("ticker").distinct()
    return wanted.join(received.select("ticker"), "ticker", "left_anti")


def ingest_manifest(received: DataFrame, universe: DataFrame, as_of: Column) -> DataFrame:
    """One row: what came back, not what was asked for, and how far it lags."""
    bars = received.agg(
        F.count("*").alias("bars_received"),
        F.countDistinct("trade_date").alias("trade_dates_touched"),
        F.min("trade_date").alias("oldest_trade_date"),
        F.max("trade_date").alias("newest_trade_date"),
    )
    outcomes = ticker_outcomes(received, universe).agg(
        F.count("*").alias("tickers_requested"),
        F.count_if(F.col("outcome") == "succeeded").alias("tickers_succeeded"),
        F.count_if(F.col("outcome") == "failed").alias("tickers_failed"),
    )
    return side_by_side(outcomes, bars).withColumn(
        "lag_days_vs_run", F.datediff(as_of, "newest_trade_date")
    )


def publish_manifest(
    plan: DataFrame, run: str, dry_run: bool, failed: list[tuple[str, str]] = ()
) -> DataFrame:
    """One row from a publish plan and the (object_key, reason) of what failed."""
    names = F.array(*[F.lit(key) for key, _ in failed]).cast("array<string>")
    lost = F.array_contains(names, F.col("object_key"))
    sent = (F.col("action") == "upload") & ~lost
    reasons = [F.struct(F.lit(k).alias("object_key"), F.lit(r).alias("reason")) for k, r in failed]
    failures = F.array(*reasons).cast("array<struct<object_key:string,reason:string>>")
    return plan.agg(
        F.count_if(sent).alias("files_uploaded"),
        F.count_if(F.col("action") == "skip").alias("files_skipped_identical"),
        F.count_if(lost).alias("files_failed"),
        F.coalesce(F.sum(F.when(sent, F.col("bytes"))), F.lit(0)).alias("bytes_uploaded"),
        F.min(F.when(sent, F.col("object_key"))).alias("oldest_partition_uploaded"),
        F.max(F.when(sent, F.col("object_key"))).alias("newest_partition_uploaded"),
    ).select(
        F.lit(run).alias("run_id"),
        F.lit("publish").alias("kind"),
        F.lit(dry_run).alias("dry_run"),
        "files_uploaded",
        "files_skipped_identical",
        "files_failed",
        F.when(F.lit(dry_run), F.lit(0)).otherwise(F.col("bytes_uploaded")).alias("bytes_uploaded"),
        "oldest_partition_uploaded",
        "newest_partition_uploaded",
        failures.alias("failures"),
        finished_at(),
    )


def finished_at() -> Column:
    """When the record of a run is written, in UTC."""
    return utc_ntz(F.current_timestamp()).alias("finished_at_utc")


def load_manifest(
    rows_before: int, after: DataFrame, loaded: dict, staged: DataFrame, run: str, dry_run: bool
) -> DataFrame:
    """One row: the raw table before and after a load, and what the load did."""
    return side_by_side(
        staged,
        after.select(
            F.col("rows_total").alias("rows_after"),
            F.col("distinct_keys").alias("distinct_keys_after"),
            F.col("files_total").alias("files_after"),
            F.col("tickers").alias("tickers_after"),
            "first_day",
            "last_day",
        ),
    ).select(
        F.lit(run).alias("run_id"),
        F.lit("load").alias("kind"),
        F.lit(dry_run).alias("dry_run"),
        F.lit(loaded["files_processed"]).alias("files_processed"),
        F.lit(loaded["rows_loaded"]).alias("rows_loaded_this_run"),
        F.lit(rows_before).alias("rows_before"),
        "*",
        finished_at(),
    )


def run_name(instant: datetime.datetime) -> str:
    """Name of a run on the driver: its UTC start, to the minute."""
    return instant.strftime("%Y-%m-%dT%H%M")
