"""File listings: metadata only, file contents are never read for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.commits import newest_snapshot
from daybook.sources.lines import day_of_object, relative_object


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(source_file, path, bytes, modified_at) of every data file under ``root``.

    Where the root has commit records, these are the files of the newest one.
    """
    snapshot = newest_snapshot(spark, root)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(root)
    if snapshot.number:
        files = files.filter(snapshot.counts(F.col("path")))
    return files.select(
        relative_object(F.col("path"), root).alias("source_file"),
        "path",
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def objects_of(files: DataFrame) -> DataFrame:
    """A file listing with the part files of one day counted as one object."""
    return files.groupBy("source_file").agg(
        F.sum("bytes").alias("bytes"), F.max("modified_at").alias("modified_at")
    )


def list_objects(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(source_file, bytes, modified_at) of every object under ``root``."""
    return objects_of(list_files(spark, root, glob))


def paths_of(files: DataFrame, objects: DataFrame) -> list[str]:
    """Paths of the files of the given objects: what a scan of just these reads.

    Like any listing, this is metadata that the driver holds for the scan anyway.
    """
    wanted = files.join(objects.select("source_file"), "source_file", "left_semi")
    return [r.path for r in wanted.select("path").collect()]


def stage_summary(listing: DataFrame) -> DataFrame:
    """One row: how many objects a stage holds and how many bytes."""
    return listing.agg(
        F.count("*").alias("staged_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("staged_bytes"),
    )


def day_partitions(spark: SparkSession, root: str) -> DataFrame:
    """The days present under ``root``, sorted, taken from the directory names."""
    days = list_objects(spark, root).select(
        day_of_object(F.col("source_file")).alias("date"), "source_file", "bytes"
    )
    return days.filter(F.col("date").isNotNull()).orderBy("date")
