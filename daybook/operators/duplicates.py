"""Telling a provider's revision from a file loaded twice, over the raw table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["ticker", "trade_date"]


def duplicate_keys(loads: DataFrame) -> DataFrame:
    """(ticker, trade_date, loads, distinct_bars) of keys loaded more than once."""
    return (
        loads.groupBy(*KEY)
        .agg(F.count("*").alias("loads"), F.countDistinct("bar_hash").alias("distinct_bars"))
        .filter(F.col("loads") > 1)
    )


def duplicate_key_files(loads: DataFrame) -> DataFrame:
    """One row per duplicated key and file it occurs in.

    Repeats collapse before the join, so a key loaded very often does not carry
    its copies through the shuffle. A null key matches nothing, as in SQL.
    """
    places = loads.select(*KEY, "source_file").distinct()
    return places.join(duplicate_keys(loads), KEY).select(
        "source_file", *KEY, "loads", "distinct_bars"
    )


def duplicate_files(loads: DataFrame) -> DataFrame:
    """Per file: duplicated keys, keys that changed, surplus rows, and their days."""
    return files_of_keys(duplicate_key_files(loads))


def files_of_keys(key_files: DataFrame) -> DataFrame:
    """:func:`duplicate_files` from what :func:`duplicate_key_files` gives."""
    return (
        key_files
        .groupBy("source_file")
        .agg(
            F.count("*").alias("dup_keys"),
            F.count_if(F.col("distinct_bars") > 1).alias("changed_keys"),
            F.sum(F.col("loads") - 1).alias("extra_rows"),
            F.min("trade_date").alias("first_day"),
            F.max("trade_date").alias("last_day"),
        )
    )


def classify_duplicates(loads: DataFrame) -> DataFrame:
    """One row with eleven measures, split by whether anything in a file changed."""
    return classify_files(duplicate_files(loads))


def classify_files(files: DataFrame) -> DataFrame:
    """:func:`classify_duplicates` from what :func:`duplicate_files` gives."""
    revised = F.col("changed_keys") > 0
    reloaded = F.col("changed_keys") == 0

    def total(column: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(column)).otherwise(0)), F.lit(0))

    return files.agg(
        F.count_if(reloaded).alias("reloaded_files"),
        F.count_if(revised).alias("revised_files"),
        total("dup_keys", reloaded).alias("reloaded_keys"),
        total("dup_keys", revised).alias("revised_keys"),
        total("extra_rows", reloaded).alias("reloaded_rows"),
        total("extra_rows", revised).alias("revised_rows"),
        total("changed_keys", revised).alias("changed_bars"),
        F.min(F.when(revised, F.col("first_day"))).alias("first_revised"),
        F.max(F.when(revised, F.col("last_day"))).alias("last_revised"),
        F.min(F.when(reloaded, F.col("first_day"))).alias("first_reloaded"),
        F.max(F.when(reloaded, F.col("last_day"))).alias("last_reloaded"),
    )


def verdict(summary: DataFrame) -> DataFrame:
    """STOP when a file was reloaded unchanged, WARN when one was only revised."""
    return summary.select(
        F.when(F.col("reloaded_files") > 0, F.lit("STOP"))
        .when(F.col("revised_files") > 0, F.lit("WARN"))
        .otherwise(F.lit("OK"))
        .alias("verdict"),
        "reloaded_files",
        "revised_files",
        "changed_bars",
        (F.col("revised_keys") - F.col("changed_bars")).alias("passengers"),
        "reloaded_rows",
        "revised_rows",
    )
