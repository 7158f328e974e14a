"""JSON-lines scans that keep each line's file and line number."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.scratch import settle
from daybook.sources.commits import newest_snapshot


# What identifies one piece of a file that one task reads.
SPLIT = ["path", "block"]

# White space as Python's ``strip`` knows it.
WHITE = r"(?U)[\s\x1c-\x1f]"


def day_object(path: Column) -> Column:
    """The object a physical file belongs to.

    Whatever a writer called its part files, everything inside one ``date=``
    directory is that day's ``prices.jsonl``. Other paths stand for themselves.
    """
    return F.regexp_replace(path, r"(/date=[^/]+)/[^/]+$", "$1/prices.jsonl")


def day_of_object(source_file: Column) -> Column:
    """The day in an object's path; null for an object outside the day layout."""
    return F.nullif(F.regexp_extract(source_file, r"date=([0-9-]+)/", 1), F.lit("")).cast("date")


def relative_object(path: Column, root: str) -> Column:
    """``day_object`` relative to the directory that was scanned."""
    base = re.escape(root.rstrip("/").rsplit("/", 1)[-1])
    return F.regexp_replace(day_object(path), f"^.*/{base}/", "")


def plain_path(path: Column) -> Column:
    """A file's path as listings write it, without the escapes of ``_metadata``."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def scan_lines(
    spark: SparkSession, root: str, where: Column | None = None, paths: list[str] | None = None
) -> DataFrame:
    """Non-blank lines of the files under ``root`` with where each was read.

    All files below ``root`` are read, at whatever depth, or only ``paths`` of them. A
    condition ``where`` is for roots that hold ``date`` directories and nothing else:
    these become a partition column, and the condition prunes before the listing is
    scanned. Where the root has commit records, only files of the newest are read.
    """
    # Looked up before the files are listed, so none that it names is missing there.
    snapshot = newest_snapshot(spark, root) if paths is None else None
    reader = spark.read if where is not None else spark.read.option("recursiveFileLookup", True)
    lines = reader.text(root if paths is None else paths)
    lines = lines.filter(F.col("value").rlike(WHITE.replace("[", "[^", 1)))
    if where is not None:
        lines = lines.filter(where)
    kept = [c for c in lines.columns if c != "value"]
    path = plain_path(F.col("_metadata.file_path"))
    if snapshot and snapshot.number:
        lines = lines.filter(snapshot.counts(path))
    return lines.select(
        "value",
        *kept,
        relative_object(path, root).alias("source_file"),
        path.alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("rid"),
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Adds ``file_row_number``, 1-based within ``source_file``.

    The lines are written once, and everything else is read from what was written: the
    first id and the line count of every input split, and from these, in the order of
    path and block, the split's place in its object. So numbers do not depend on how
    another scan would be split, and no text is shuffled or sorted: ids rise by one
    inside a split. A line whose split is not known fails the job.
    """
    return numbered(settle(lines, "lines"))


def numbered(lines: DataFrame) -> DataFrame:
    """:func:`number_lines` for lines that were written with their ids already."""
    splits = lines.groupBy("source_file", *SPLIT).agg(
        F.count("*").alias("n"), F.min("rid").alias("first_rid")
    )
    earlier = (
        Window.partitionBy("source_file")
        .orderBy("path", "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    place = F.coalesce(F.sum("n").over(earlier), F.lit(0)) + 1 - F.col("first_rid")
    splits = settle(splits.select(*SPLIT, place.alias("place")), "splits")
    number = F.when(F.col("place").isNotNull(), F.col("rid") + F.col("place")).otherwise(
        F.raise_error(F.concat(F.lit("no line offset for "), "path")).cast("long")
    )
    return (
        lines.join(splits, SPLIT, "left")
        .withColumn("file_row_number", number)
        .drop("path", "block", "rid", "place")
    )


def as_payload(lines: DataFrame) -> DataFrame:
    """Replaces the text by VARIANT. A malformed line fails the job."""
    return lines.withColumn("payload", F.parse_json("value")).drop("value")


def line_digest(line: Column) -> list[Column]:
    """Aggregates that digest a set of lines, mergeable across tasks.

    The four 32-bit parts of each line's MD5 are summed. Unlike a hash over the
    whole content this needs no task to see an entire file, so one huge object
    is digested by as many tasks as read it.
    """
    md5 = F.md5(line)
    return [
        F.sum(F.conv(F.substring(md5, 8 * lane + 1, 8), 16, 10).cast("long")).alias(f"lane_{lane}")
        for lane in range(4)
    ]


def digest_text(row_count: Column) -> Column:
    """One string from the aggregates of :func:`line_digest` and a line count."""
    return F.concat_ws("-", row_count, *[F.col(f"lane_{lane}") for lane in range(4)])


def object_digests(lines: DataFrame) -> DataFrame:
    """(source_file, row_count, digest) of every object among scanned lines.

    Equal digests mean equal sets of lines. Tasks add up what they read, so an object
    of any size takes one pass and shuffles five numbers a task.
    """
    objects = lines.groupBy("source_file").agg(
        F.count("*").alias("row_count"), *line_digest(F.col("value"))
    )
    return objects.select(
        "source_file", "row_count", digest_text(F.col("row_count")).alias("digest")
    )
