"""Daily bars and everything the pipeline derives from them, out of the given tables.

The given tables hold trades, not bars: a line item is a trade of its part's
brand on its ship date. Prices are cut to 64ths, so sums and means are exact and
two engines agree to the last bit.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.bars import utc_literal, utc_ntz
from daybook.plans.staging import keyed_bars
from daybook.schemas import STG_PRICES
from daybook.scratch import scratch_path, settle
from daybook.sources.day_files import json_line

AS_OF = datetime.date(2001, 11, 9)
FIRST_LOAD = datetime.datetime(2001, 12, 1)
REVISION_LOAD = datetime.datetime(2001, 12, 2)
REPEAT_LOAD = datetime.datetime(2001, 12, 3)
REVISION_STEP = 0.0009765625

TRADE_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def trades(spark: SparkSession, sf: str) -> DataFrame:
    items, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 64) / 64
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("ticker"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        price.alias("price"),
        *TRADE_ORDER,
    )


def daily_bars(spark: SparkSession, sf: str) -> DataFrame:
    """One bar per brand and day. First and last trade are picked by aggregation,
    so a brand or day with very many trades is reduced before the shuffle."""
    order = F.struct(*TRADE_ORDER)
    quantity = F.col("l_quantity")
    return (
        trades(spark, sf)
        .groupBy("ticker", "trade_date")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum(quantity).alias("volume"),
            (F.sum(F.col("price") * quantity) / F.sum(quantity)).alias("vwap"),
            F.count("*").alias("transaction_count"),
        )
    )


def ingest_stamp(trade_date: Column) -> Column:
    """The provider answers at 11:00 UTC on the day after the session."""
    return F.concat(F.date_add(trade_date, 1).cast("string"), F.lit("T11:00:00+00:00"))


def landed(bars: DataFrame) -> DataFrame:
    """Bars as landed rows."""
    return bars.withColumnRenamed("transaction_count", "transactions").withColumn(
        "ingested_at_utc", ingest_stamp(F.col("trade_date"))
    )


def day_file(trade_date: Column) -> Column:
    return F.concat(F.lit("raw/prices/date="), trade_date.cast("string"), F.lit("/prices.jsonl"))


def in_day_files(bars: DataFrame) -> DataFrame:
    """Adds a bar's line in its day's file, where brands stand in name order."""
    order = Window.partitionBy("trade_date").orderBy("ticker")
    return bars.withColumn("file_row_number", F.row_number().over(order).cast("bigint"))


def raw_rows(bars: DataFrame, loaded_at: Column) -> DataFrame:
    """Bars with their lines as rows of the raw table."""
    return landed(bars).select(
        F.parse_json(json_line()).alias("payload"),
        day_file(F.col("trade_date")).alias("source_file"),
        "file_row_number",
        loaded_at.alias("loaded_at"),
    )


def raw_single(bars: DataFrame) -> DataFrame:
    """Every bar loaded once."""
    return raw_rows(in_day_files(bars), utc_literal(FIRST_LOAD))


def raw_loads(bars: DataFrame) -> DataFrame:
    """Every bar once, plus a revision of the files of the 8th and an unchanged
    repeat of the files of 15 January. Copies come out of one pass."""
    day, month = F.dayofmonth("trade_date"), F.month("trade_date")
    copies = F.concat(
        F.array(utc_literal(FIRST_LOAD)),
        F.when(day == 8, F.array(utc_literal(REVISION_LOAD))).otherwise(F.array()),
        F.when((day == 15) & (month == 1), F.array(utc_literal(REPEAT_LOAD))).otherwise(F.array()),
    )
    revised = (F.col("loaded_at") == utc_literal(REVISION_LOAD)) & (F.char_length("ticker") == 7)
    loads = in_day_files(bars).withColumn("loaded_at", F.explode(copies)).withColumn(
        "vwap", F.when(revised, F.col("vwap") + REVISION_STEP).otherwise(F.col("vwap"))
    )
    return raw_rows(loads, F.col("loaded_at"))


def staged_rows(bars: DataFrame) -> DataFrame:
    """Staging rows of the single load."""
    rows = in_day_files(bars).select(
        "*",
        utc_ntz(ingest_stamp(F.col("trade_date"))).alias("ingested_at_utc"),
        day_file(F.col("trade_date")).alias("source_file"),
        utc_literal(FIRST_LOAD).alias("loaded_at"),
    )
    return keyed_bars(rows).select(*STG_PRICES)


def staged_once(spark: SparkSession, sf: str) -> DataFrame:
    """The same, as a table."""
    return settle(staged_rows(daily_bars(spark, sf)), "staged")


def raw_table(spark: SparkSession, sf: str) -> DataFrame:
    """The three loads, as a table."""
    return settle(raw_loads(daily_bars(spark, sf)), "raw")


def reference(spark: SparkSession, sf: str) -> DataFrame:
    """The brands without Brand#25 and with Brand#99, which never trades."""
    listed = table(spark, sf, "part").select(F.col("p_brand").alias("ticker")).distinct()
    listed = listed.filter(F.col("ticker") != "Brand#25").unionByName(
        spark.createDataFrame([("Brand#99",)], "ticker string")
    )
    number = F.substring_index("ticker", "#", -1).cast("int")
    return listed.select(
        "ticker",
        F.concat(F.lit("Maker "), number.cast("string"), F.lit(", Inc.")).alias("company_name"),
        F.element_at(F.array(*[F.lit(s) for s in SECTORS_USED]), number % 8 + 1).alias("sector"),
    )


SECTORS_USED = (
    "Communication Services",
    "Consumer Discretionary",
    "Consumer Staples",
    "Energy",
    "Financials",
    "Health Care",
    "Industrials",
    "Information Technology",
)


def written_days(bars: DataFrame, unit: str = "month") -> str:
    """Bars as JSON lines on disk, one partition for each month or day."""
    root = scratch_path(bars.sparkSession, "days")
    (
        landed(bars)
        .select(
            F.date_trunc(unit, F.col("trade_date")).cast("date").alias("date"),
            "trade_date",
            "ticker",
            json_line().alias("value"),
        )
        .repartitionByRange("date", "trade_date", "ticker")
        .sortWithinPartitions("date", "trade_date", "ticker")
        .select("value", "date")
        .write.partitionBy("date")
        .text(root)
    )
    return root


def faulty(staged: DataFrame) -> DataFrame:
    """Staging rows with one kind of fault per day of the month, for brands 10-19,
    and two further copies of the bars of the 17th."""
    day = F.dayofmonth("trade_date")
    hit = F.col("ticker").startswith("Brand#1") & (F.char_length("ticker") == 8)

    def on(number: int, value: Column, column: str) -> Column:
        return F.when(hit & (day == number), value).otherwise(F.col(column))

    nothing = F.lit(None).cast("double")
    rows = (
        staged.withColumn("high", on(3, F.col("low") - 1, "high"))
        .withColumn("volume", on(5, -F.col("volume"), "volume"))
        .withColumn("low", F.when(hit & day.isin(7, 11), -F.col("low")).otherwise(F.col("low")))
        .withColumn("close", on(9, nothing, "close"))
        .withColumn("open", on(11, nothing, "open"))
    )
    copies = F.when(hit & (day == 17), F.sequence(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).withColumn(
        "file_row_number", F.col("file_row_number") + 100 * F.col("copy")
    ).drop("copy")


def plain(df: DataFrame) -> DataFrame:
    """Days and instants as ISO text, which every engine prints alike."""
    texts = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, texts) else F.col(f.name)
            for f in df.schema
        ]
    )
