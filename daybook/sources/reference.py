"""Hand-kept lists: the ticker reference and the universe of symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schemas import REFERENCE_WIDTHS, TICKER_REFERENCE
from daybook.sources.lines import WHITE


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """The ticker reference from CSV, with declared types and quoted commas.

    A malformed record fails the read, and so does a value wider than declared.
    """
    rows = (
        spark.read.schema(TICKER_REFERENCE)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )
    return check_widths(rows)


def check_widths(rows: DataFrame) -> DataFrame:
    """Fails on a text longer than its declared width."""
    fits = [
        F.when(F.char_length(name) <= width, F.col(name))
        .when(F.col(name).isNull(), F.lit(None))
        .otherwise(F.raise_error(F.lit(f"{name} is longer than {width} characters")).cast("string"))
        .alias(name)
        for name, width in REFERENCE_WIDTHS.items()
    ]
    return rows.select(*fits)


def _symbols(lines: DataFrame, text: Column) -> DataFrame:
    bare = F.regexp_replace(text, f"^{WHITE}+|{WHITE}+$", "")
    cleaned = lines.select(F.upper(bare).alias("ticker"))
    return cleaned.filter(F.col("ticker") != "")


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """Symbols of a text file, one per line; ``#`` starts a comment."""
    return universe_of_lines(spark.read.text(path))


def universe_of_lines(lines: DataFrame) -> DataFrame:
    """The same from a DataFrame with a ``value`` column."""
    return _symbols(lines, F.substring_index("value", "#", 1))


def universe_override(requests: DataFrame, column: str = "value") -> DataFrame:
    """Symbols of comma lists, which replace the universe file."""
    split = requests.select(F.explode(F.split(column, ",")).alias("symbol"))
    return _symbols(split, F.col("symbol"))


def missing_from(universe: DataFrame, received: DataFrame) -> DataFrame:
    """Requested symbols nothing came back for, each once."""
    return universe.select("ticker").subtract(received.select("ticker"))


