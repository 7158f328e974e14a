"""Column contracts of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the provider's bar and the names we land them under.
API_FIELDS = {
    "o": "open",
    "h": "high",
    "l": "low",
    "c": "close",
    "v": "volume",
    "vw": "vwap",
    "n": "transactions",
}

# Landed fields that are counts; every other number is a double.
COUNTS = ("transactions",)

# Response states that carry usable bars.
USABLE_STATES = ("OK", "DELAYED")

# The landed row, in file order.
LANDED_FIELDS = (
    "ticker",
    "trade_date",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "vwap",
    "transactions",
    "ingested_at_utc",
)

# The seven numbers that make up a bar.
BAR_NUMBERS = ("open", "high", "low", "close", "volume", "vwap", "transaction_count")

LINEAGE = ("source_file", "file_row_number", "loaded_at")

RAW = T.StructType(
    [
        T.StructField("payload", T.VariantType(), False),
        T.StructField("source_file", T.StringType(), False),
        T.StructField("file_row_number", T.LongType(), False),
        T.StructField("loaded_at", T.TimestampNTZType(), False),
    ]
)

# Columns of the staging table, the fact table and the dimension.
STG_PRICES = (
    "price_key",
    "bar_hash",
    "ticker",
    "trade_date",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "vwap",
    "transaction_count",
    "ingested_at_utc",
    "source_file",
    "file_row_number",
    "loaded_at",
)

FCT_DAILY_PRICES = (
    "price_key",
    "ticker",
    "trade_date",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "vwap",
    "transaction_count",
    "prior_close",
    "daily_return_pct",
    "moving_avg_20d",
    "high_52w",
    "low_52w",
    "dollar_volume",
    "loaded_at",
)

DIM_TICKERS = (
    "ticker",
    "company_name",
    "sector",
    "first_trade_date",
    "last_trade_date",
    "trading_days",
    "price_rows",
)

# Declared widths of the reference list.
REFERENCE_WIDTHS = {"ticker": 10, "company_name": 120, "sector": 60}

TICKER_REFERENCE = T.StructType(
    [T.StructField(name, T.StringType()) for name in REFERENCE_WIDTHS]
)

# The eleven GICS sectors.
SECTORS = (
    "Communication Services",
    "Consumer Discretionary",
    "Consumer Staples",
    "Energy",
    "Financials",
    "Health Care",
    "Industrials",
    "Information Technology",
    "Materials",
    "Real Estate",
    "Utilities",
)

LOAD_LEDGER = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("tag", T.StringType()),
    ]
)

PUBLISH_LEDGER = T.StructType(
    [
        T.StructField("object_key", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("local_bytes", T.LongType()),
        T.StructField("local_modified_at", T.TimestampType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField("local_tag", T.StringType()),
        T.StructField("stage_tag", T.StringType()),
    ]
)

# The kept measure of the raw table: what each take-up of loads added.
MEASURE_LEDGER = T.StructType(
    [
        T.StructField("take_up", T.StringType()),
        T.StructField("load_ids", T.ArrayType(T.StringType())),
        T.StructField("rows", T.LongType()),
        T.StructField("new_keys", T.LongType()),
        T.StructField("new_tickers", T.LongType()),
        T.StructField("first_day", T.DateType()),
        T.StructField("last_day", T.DateType()),
    ]
)

KEPT_BARS = "ticker string, source_file string, bar_hash long, n long, take_up string, date date"
KEPT_TICKERS = "ticker string, take_up string"
KEPT_REPEATS = (
    "ticker string, trade_date date, source_file string, loads long, distinct_bars long, take int, take_up string"
)

# The rolling fact table: its months with the lineage that orders a series, the rows of every
# ticker and month, and what each change wrote.
ROLLING_FACT = (
    "price_key string, ticker string, trade_date date, open double, high double, low double, close double, "
    "volume double, vwap double, transaction_count long, prior_close double, daily_return_pct double, "
    "moving_avg_20d double, high_52w double, low_52w double, dollar_volume double, loaded_at timestamp_ntz, "
    "source_file string, file_row_number long, take string, month int"
)
ROLLING_COUNTS = "ticker string, rows long, take string, month int"
ROLLING_LEDGER = T.StructType(
    [
        T.StructField("take", T.StringType()),
        T.StructField("number", T.IntegerType()),
        T.StructField("months", T.ArrayType(T.IntegerType())),
        T.StructField("held", T.ArrayType(T.IntegerType())),
        T.StructField("load_ids", T.ArrayType(T.StringType())),
    ]
)
