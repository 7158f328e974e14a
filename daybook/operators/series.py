"""Session windows over each ticker's series.

A ticker of ordinary length is windowed in one task; its length is counted first.
A longer one is cut into slices of a fixed number of sessions, each windowed on
its own together with the rows before it that its frames reach back to.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daybook.scratch import null_safe_filter, null_safe_on, settle

# Sessions in the moving average and in a trading year.
AVERAGE_SESSIONS = 20
YEAR_SESSIONS = 252

# Rows one task may hold for one ticker, about 100 MB of bars.
ROWS_PER_SLICE = 1_000_000

# Names of the measures, in mart order.
MEASURES = ("prior_close", "moving_avg_20d", "high_52w", "low_52w")

# Total order of a series. The lineage columns decide between copies of a day.
SERIES_ORDER = ("trade_date", "loaded_at", "source_file", "file_row_number")


def _ascending(columns: tuple[str, ...]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def with_measures(bars: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds the neighbour measures to every series, in one shuffle on ``keys``."""
    series = Window.partitionBy(*keys).orderBy(*order)
    recent = series.rowsBetween(1 - AVERAGE_SESSIONS, 0)
    complete = F.count("close").over(recent) == AVERAGE_SESSIONS
    near = bars.withColumns(
        {
            "prior_close": F.lag("close").over(series),
            "moving_avg_20d": F.when(complete, F.avg("close").over(recent)),
        }
    )
    return with_year_range(near, keys, series).select(*bars.columns, *MEASURES)


def with_year_range(bars: DataFrame, keys: list[str], series: WindowSpec) -> DataFrame:
    """Adds the highest high and lowest low of a full trading year.

    A frame of 252 rows would be re-read for every row. Here a series is cut into
    blocks of 252 rows: any 252 rows in a row are the end of one block and the
    start of the next, so the extreme is that of a running extreme to the end of
    the block, read 251 rows back, and one from the start of the block. Each
    running value costs one step per row. How many values the year holds is the
    difference of two running counts. All windows share the hash partitioning of
    the first and only sort within it.
    """
    so_far = series.rowsBetween(Window.unboundedPreceding, 0)
    placed = bars.withColumns(
        {
            "place": F.row_number().over(series),
            "highs": F.count("high").over(so_far),
            "lows": F.count("low").over(so_far),
        }
    ).withColumn("block", F.floor((F.col("place") - 1) / YEAR_SESSIONS))

    block = Window.partitionBy(*keys, "block")
    up_to_end = block.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, 0)
    from_start = block.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumns(
        {"high_to_end": F.max("high").over(up_to_end), "low_to_end": F.min("low").over(up_to_end)}
    ).withColumns(
        {"high_so_far": F.max("high").over(from_start), "low_so_far": F.min("low").over(from_start)}
    )

    # Blocks are in series order, so this asks for the order the rows are already in.
    rows = Window.partitionBy(*keys).orderBy("block", "place")

    def back(column: str, steps: int) -> Column:
        return F.lag(column, steps).over(rows)

    def full_year(count: str) -> Column:
        return F.col(count) - F.coalesce(back(count, YEAR_SESSIONS), F.lit(0)) == YEAR_SESSIONS

    reach = YEAR_SESSIONS - 1
    highest = F.greatest(back("high_to_end", reach), F.col("high_so_far"))
    lowest = F.least(back("low_to_end", reach), F.col("low_so_far"))
    return running.withColumns(
        {
            "high_52w": F.when(full_year("highs"), highest),
            "low_52w": F.when(full_year("lows"), lowest),
        }
    )


def session_measures(bars: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``bars`` with prior close, moving average and yearly range per ticker.

    ``bars`` is read twice and should be a table. Needs the series order columns.
    """
    lengths = bars.groupBy("ticker").agg(F.count("*").alias("rows"))
    long_tickers = lengths.filter(F.col("rows") > rows_per_slice)
    if long_tickers.isEmpty():
        return with_measures(bars, ["ticker"], _ascending(SERIES_ORDER))
    long_tickers = settle(long_tickers, "long-tickers")
    rows = long_tickers.agg(F.sum("rows")).first()[0]
    names = long_tickers.select("ticker")
    short = null_safe_filter(bars, names, ["ticker"], "left_anti")
    long = null_safe_filter(bars, names, ["ticker"], "left_semi")
    return with_measures(short, ["ticker"], _ascending(SERIES_ORDER)).unionByName(
        sliced_measures(long, rows, rows_per_slice)
    )


def sliced_measures(bars: DataFrame, rows: int, rows_per_slice: int) -> DataFrame:
    """The same measures for ``rows`` bars of series too long for one task.

    Slices have a fixed number of rows, and only the last rows of a slice are
    copied into the next, as far as the longest frame reaches back.
    """
    if rows_per_slice < YEAR_SESSIONS:
        raise ValueError(f"a slice must hold at least {YEAR_SESSIONS} rows")
    placed = positioned(bars, max(2, math.ceil(rows / rows_per_slice)))
    reach = YEAR_SESSIONS - 1
    home = F.floor(F.col("position") / rows_per_slice)
    feeds_next = F.col("position") % rows_per_slice >= rows_per_slice - reach
    targets = F.when(feeds_next, F.array("home", F.col("home") + 1)).otherwise(F.array("home"))
    copies = placed.withColumn("home", home).withColumn("slice", F.explode(targets))
    measured = with_measures(copies, ["ticker", "slice"], [F.col("position").asc()])
    return measured.filter(F.col("home") == F.col("slice")).drop("home", "slice", "position")


def positioned(bars: DataFrame, parts: int) -> DataFrame:
    """Adds ``position``, 0-based in each ticker's series order.

    No series is gathered for that: a range partitioning over the whole sort key
    cuts anywhere, even between the copies of one day, and the rows counted per
    partition and ticker (a table of that size) turn the place inside a partition
    into a position. The ranges are written down, as a second run of the sampling
    behind them could cut elsewhere.
    """
    key = _ascending(("ticker", *SERIES_ORDER))
    ranged = settle(
        bars.repartitionByRange(parts, *key)
        .sortWithinPartitions(*key)
        .withColumn("rid", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("rid", 33)),
        "ranged-series",
    )
    before = (
        Window.partitionBy("ticker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = settle(
        ranged.groupBy("ticker", "part")
        .agg(F.min("rid").alias("first_rid"), F.count("*").alias("n"))
        .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n"),
        "series-offsets",
    )
    joined = ranged.alias("rows").join(
        offsets.alias("offsets"), null_safe_on("rows", "offsets", ["ticker", "part"])
    )
    position = F.col("offsets.offset") + F.col("rows.rid") - F.col("offsets.first_rid")
    return joined.select("rows.*", position.alias("position")).drop("rid", "part")
