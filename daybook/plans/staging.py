"""The staging table: the one place where types are decided."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.bars import bar_fingerprint, price_key, utc_ntz
from daybook.operators.revisions import keep_loads
from daybook.schemas import BAR_NUMBERS, LINEAGE, STG_PRICES


def typed_bars(raw: DataFrame) -> DataFrame:
    """Every field cast by hand from VARIANT; a malformed value fails the job."""

    def field(name: str, kind: str):
        return F.variant_get("payload", f"$.{name}", kind)

    return raw.select(
        field("ticker", "string").alias("ticker"),
        field("trade_date", "date").alias("trade_date"),
        *[field(n, "double").alias(n) for n in BAR_NUMBERS if n != "transaction_count"],
        field("transactions", "bigint").alias("transaction_count"),
        utc_ntz(field("ingested_at_utc", "timestamp")).alias("ingested_at_utc"),
        *LINEAGE,
    )


def keyed_bars(typed: DataFrame) -> DataFrame:
    """Adds the grain as one column and a fingerprint of the seven numbers."""
    return typed.select(
        price_key(F.col("ticker"), F.col("trade_date")).alias("price_key"),
        bar_fingerprint([F.col(n) for n in BAR_NUMBERS]).alias("bar_hash"),
        "*",
    )


def stg_prices(raw: DataFrame) -> DataFrame:
    """Typed bars with revised files reduced to their newest loads."""
    return keep_loads(keyed_bars(typed_bars(raw))).select(*STG_PRICES)
