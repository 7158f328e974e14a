"""Merging newly received bars into the day partitions already on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.bars import same_bar

KEY = ["trade_date", "ticker"]
STAMP = "ingested_at_utc"
LINE = "line"


def collapse(rows: DataFrame, fields: list[str], order: str) -> DataFrame:
    """One row per key: its last copy by ``order`` and whether copies disagreed.

    The fields themselves decide between copies of equal order, so that a retried
    task picks the same one.
    """
    bar = F.struct(*[c for c in fields if c != STAMP])
    return rows.groupBy(*KEY).agg(
        F.max_by(F.struct(*fields), F.struct(order, *fields)).alias("now"),
        (F.min(bar) != F.max(bar)).alias("varied"),
    )


def last_lines(rows: DataFrame, fields: list[str]) -> DataFrame:
    """One row per key on disk: its last line, and whether there were several."""
    last = F.max_by(F.struct(*fields), LINE)
    return rows.groupBy(*KEY).agg(last.alias("was"), (F.count("*") > 1).alias("repeated"))


def merge_days(old: DataFrame, new: DataFrame, order: str = "position") -> DataFrame:
    """Full outer merge on (trade_date, ticker) with a ``changed`` flag.

    A bar only on disk stays. A bar received again unchanged keeps the row on
    disk with its original stamp, so an unchanged day stays byte for byte the
    same. Everything else takes the received row. Fields are compared over the
    union of both sides' columns, apart from the stamp. Where ``old`` has a column
    ``line``, the last of several lines for one key counts, and its day is changed.
    """
    types = {f.name: f.dataType for side in (new, old) for f in side.schema}
    fields = [c for c in dict.fromkeys((*old.columns, *new.columns)) if c not in (*KEY, order, LINE)]
    compared = [c for c in fields if c != STAMP]

    def widened(rows: DataFrame) -> DataFrame:
        absent = [c for c in fields if c not in rows.columns]
        return rows.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in absent])

    present = widened(old)
    if LINE in old.columns:
        present = last_lines(present, fields)
    else:
        present = present.select(*KEY, F.struct(*fields).alias("was"), F.lit(False).alias("repeated"))
    received = collapse(widened(new), fields, order)
    joined = present.join(received, KEY, "full_outer")
    was, now = F.col("was"), F.col("now")
    unchanged = was.isNotNull() & ~F.col("varied") & same_bar(was, now, compared)
    keep = now.isNull() | unchanged
    changed = ~keep | F.coalesce("repeated", F.lit(False))
    picked = joined.select(*KEY, F.when(keep, was).otherwise(now).alias("row"), changed.alias("changed"))
    return picked.select(*KEY, "row.*", "changed")


def merge_counts(merged: DataFrame, new: DataFrame) -> DataFrame:
    """One row: days the received bars touch and days whose content changes."""
    touched = new.agg(F.countDistinct("trade_date").alias("dates_touched"))
    rewritten = merged.filter("changed").agg(
        F.countDistinct("trade_date").alias("dates_rewritten")
    )
    return touched.unionByName(rewritten, allowMissingColumns=True).agg(
        F.max("dates_touched").alias("dates_touched"),
        F.max("dates_rewritten").alias("dates_rewritten"),
    )
