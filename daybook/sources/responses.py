"""Provider responses that were landed as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.bars import epoch_ms_to_date
from daybook.schemas import API_FIELDS, COUNTS, USABLE_STATES
from daybook.sources.ledger import path_exists


def envelope_bars(docs: DataFrame, column: str = "value") -> DataFrame:
    """(ticker, position, bar) of every usable response document.

    A response without results contributes no rows; its ticker then shows up as
    failed when the outcome is compared with the request list. Bars stay VARIANT:
    their numbers arrive as integers or fractions and are cast one by one later.
    """
    body = F.parse_json(column)
    parts = docs.select(
        F.variant_get(body, "$.ticker", "string").alias("ticker"),
        F.variant_get(body, "$.status", "string").alias("status"),
        F.variant_get(body, "$.results", "array<variant>").alias("results"),
    )
    return parts.filter(F.col("status").isin(*USABLE_STATES)).select(
        "ticker", F.posexplode("results").alias("position", "bar")
    )


def envelope_states(docs: DataFrame, column: str = "value") -> DataFrame:
    """(ticker, status) of every response document."""
    body = F.parse_json(column)
    return docs.select(
        F.variant_get(body, "$.ticker", "string").alias("ticker"),
        F.variant_get(body, "$.status", "string").alias("status"),
    )


def read_responses(spark: SparkSession, root: str) -> DataFrame:
    """(run, ticker, position, bar) of files ``run=<id>/<TICKER>.json``.

    Each file holds one JSON array, which the provider limits to 50,000 bars, so
    a whole file fits in one record.
    """
    files = (
        spark.read.schema("value string, run string")
        .option("pathGlobFilter", "*.json")
        .text(root, wholetext=True)
        .select("run", "value", F.col("_metadata.file_name").alias("file_name"))
    )
    return files.select(
        "run",
        F.regexp_extract("file_name", r"^(.*)\.json$", 1).alias("ticker"),
        F.posexplode(F.parse_json("value").cast("array<variant>")).alias("position", "bar"),
    )


def land_responses(docs: DataFrame, root: str, run: str) -> str:
    """Keep response documents as received, one per line, under ``run=<id>``.

    Line breaks become blanks: in JSON they can only stand between tokens. A second
    run of the same name gets a folder of its own. Returns the folder.
    """
    folder, number = f"{root}/run={run}", 1
    while path_exists(docs.sparkSession, folder):
        number += 1
        folder = f"{root}/run={run}-{number}"
    docs.select(F.translate("value", "\r\n", "  ").alias("value")).write.text(folder)
    return folder


def read_landed_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that :func:`land_responses` kept in a folder, as ``value``."""
    return spark.read.option("pathGlobFilter", "*.txt").text(folder)


def bars_to_rows(bars: DataFrame, ingested_at: str) -> DataFrame:
    """Landed rows from (ticker, position, bar): long names, a trade date, a stamp.

    A field the provider left out becomes null. ``position`` is carried along to
    order copies of one bar inside a response.
    """
    bar = F.col("bar")
    numbers = [
        F.variant_get(bar, f"$.{short}", "bigint" if name in COUNTS else "double").alias(name)
        for short, name in API_FIELDS.items()
    ]
    return bars.select(
        "ticker",
        epoch_ms_to_date(F.variant_get(bar, "$.t", "bigint")).alias("trade_date"),
        *numbers,
        F.lit(ingested_at).alias("ingested_at_utc"),
        "position",
    )
