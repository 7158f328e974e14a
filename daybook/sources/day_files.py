"""Day partitions: ``date=YYYY-MM-DD`` directories of JSON lines, one per ticker."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schemas import COUNTS, LANDED_FIELDS
from daybook.sources.commits import Snapshot, commit_days, drop_version, new_version, newest_snapshot
from daybook.sources.lines import scan_lines

TEXTS = ("ticker", "trade_date", "ingested_at_utc")

# A day is one file until it outgrows this many rows, then several.
ROWS_PER_FILE = 1_000_000

# Fixed value: what Spark names the folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

# Whole doubles below this are written as JSON integers, like any serializer does.
EXACT_INTEGER = 1e15


def json_number(value: Column) -> Column:
    """A number as JSON text: ``229`` when whole, ``229.15`` otherwise, or ``null``."""
    whole = (value == F.floor(value)) & (F.abs(value) < EXACT_INTEGER)
    text = F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
    return F.coalesce(text, F.lit("null"))


def json_text(value: Column) -> Column:
    """A string as escaped JSON text, or ``null``."""
    listed = F.to_json(F.array(value.cast("string")))
    return F.substr(listed, F.lit(2), F.char_length(listed) - 2)


def json_line(fields: tuple[str, ...] = LANDED_FIELDS) -> Column:
    """One landed row as a JSON object, every field present and in file order."""
    parts = []
    for i, name in enumerate(fields):
        value = json_text(F.col(name)) if name in TEXTS else json_number(F.col(name))
        parts += [F.lit(f'{", " if i else ""}"{name}": '), value]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def parse_landed(lines: DataFrame, *others: Column) -> DataFrame:
    """Landed rows from day-file text, typed for comparison with received bars."""
    body = F.col("payload")
    kinds = {name: "string" for name in TEXTS} | {name: "bigint" for name in COUNTS}
    kinds["trade_date"] = "date"
    return lines.withColumn("payload", F.parse_json("value")).select(
        *[
            F.variant_get(body, f"$.{name}", kinds.get(name, "double")).alias(name)
            for name in LANDED_FIELDS
        ],
        *others,
    )


def read_days(spark: SparkSession, root: str, where: Column | None = None) -> DataFrame:
    """Rows of the day files, of all days or those a condition on ``date`` selects."""
    return parse_landed(scan_lines(spark, root, where))


def read_day_lines(spark: SparkSession, root: str, where: Column) -> DataFrame:
    """The same with ``line``, which puts the rows of a day in file order."""
    line = F.struct("path", "block", "rid").alias("line")
    return parse_landed(scan_lines(spark, root, where), line)


def among_days(days: DataFrame, column: str) -> Column | None:
    """A condition on ``date`` that prunes a scan to the days of a small table.

    The days are listed as literals, which prune where a join might not. There are at
    most as many as the calendar has. ``None`` when there are no days.
    """
    days = days.select(F.col(column).cast("date").alias("day")).distinct().collect()
    if not days:
        return None
    return F.col("date").isin([r.day for r in days if r.day is not None])


def write_days(
    rows: DataFrame,
    root: str,
    rows_per_file: int = ROWS_PER_FILE,
    base: Snapshot | None = None,
    read: Iterable[str] = (),
) -> Snapshot:
    """Replace the days that ``rows`` covers all at once, leaving all others alone.

    Rows are ranged by (date, ticker), which keeps a day's lines sorted, and a
    day that holds very many rows is cut over several tasks and files. They are added
    under a new version, and one commit record makes them count together; a run that
    dies before has changed nothing. ``base`` is the snapshot the rows were made from and
    ``read`` the days it was read for; ``DaysChanged`` is raised where another run has
    committed one of these days since.
    """
    spark = rows.sparkSession
    base, version = base or newest_snapshot(spark, root), new_version()
    day = F.coalesce(F.col("trade_date").cast("string"), F.lit(NO_DAY))
    days = [r.day for r in rows.select(day.alias("day")).distinct().collect()]
    if not days:
        return base
    lines = rows.select(F.col("trade_date").alias("date"), "ticker", json_line().alias("value"))
    try:
        (
            lines.repartitionByRange("date", "ticker")
            .sortWithinPartitions("date", "ticker")
            .select("value", "date")
            .write.mode("append")
            .option("mapreduce.output.basename", f"part-{version}")
            .option("maxRecordsPerFile", rows_per_file)
            .partitionBy("date")
            .text(root)
        )
        return commit_days(spark, root, base, version, days, read)
    except Exception:
        if newest_snapshot(spark, root).days.get(days[0]) != version:
            drop_version(spark, root, version, days)
        raise
