"""Which loads of a bar to keep.

A changed file is reloaded whole, so the file is what gets judged. If no bar of
it ever changed, every load stays and the uniqueness check reports the repeat. If
any bar of it changed, its bars keep only their newest load.

The work is done with aggregates and joins rather than windows over the keys: a
key or a file that holds a large share of all rows is pre-aggregated on the map
side and never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.scratch import null_safe_filter, settle

NEWEST = ("loaded_at", "source_file", "file_row_number")


def key_revisions(keyed: DataFrame) -> DataFrame:
    """(price_key, loads, key_was_revised) for every key."""
    bounds = keyed.groupBy("price_key").agg(
        F.count("*").alias("loads"),
        F.min("bar_hash").alias("lowest"),
        F.max("bar_hash").alias("highest"),
    )
    return bounds.select(
        "price_key", "loads", (F.col("lowest") != F.col("highest")).alias("key_was_revised")
    )


def suspected_keys(keyed: DataFrame) -> DataFrame:
    """Hashes of keys that may have been revised: all that were, and hardly another.

    Every row takes part in this one, so it shuffles three numbers per key and
    leaves the text of the key behind. Two keys of equal hash can only add a
    suspect, which the exact comparison then clears.
    """
    bounds = keyed.groupBy(F.xxhash64("price_key").alias("key_hash")).agg(
        F.min("bar_hash").alias("lowest"), F.max("bar_hash").alias("highest")
    )
    return bounds.filter(F.col("lowest") != F.col("highest")).select("key_hash")


def revised_keys(keyed: DataFrame, suspects: DataFrame) -> DataFrame:
    """Keys loaded with more than one set of numbers."""
    hashed = keyed.withColumn("key_hash", F.xxhash64("price_key"))
    examined = hashed.join(suspects, "key_hash", "left_semi")
    return key_revisions(examined).filter("key_was_revised").select("price_key")


def revised_files(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """Files that hold any of the revised keys."""
    return null_safe_filter(keyed, keys, ["price_key"], "left_semi").select("source_file").distinct()


def file_revisions(keyed: DataFrame) -> DataFrame:
    """(source_file, rows, file_was_revised) for every file."""
    suspects = settle(suspected_keys(keyed), "suspected-keys")
    keys = settle(revised_keys(keyed, suspects), "revised-keys")
    files = revised_files(keyed, keys).withColumn("revised", F.lit(True))
    return (
        keyed.groupBy("source_file")
        .agg(F.count("*").alias("rows"))
        .join(files, "source_file", "left")
        .select(
            "source_file", "rows", F.coalesce("revised", F.lit(False)).alias("file_was_revised")
        )
    )


def newest_loads(keyed: DataFrame) -> DataFrame:
    """The newest load of every key, later lineage deciding between equal times."""
    row = F.struct(*keyed.columns)
    return (
        keyed.groupBy("price_key")
        .agg(F.max_by(row, F.struct(*NEWEST)).alias("row"))
        .select("row.*")
    )


def keep_loads(keyed: DataFrame) -> DataFrame:
    """All loads of unrevised files, and newest loads that lie in revised files.

    A key present in two files competes across both, so its newest load may lie in an
    unrevised file, where it is kept anyway. Where nothing was ever revised the rows
    pass through untouched. Otherwise keys, fingerprints and lineage are written once,
    the loads that lose are found among them, and the rows pass through an anti join
    with these few; no full-width table is written.
    """
    suspects = settle(suspected_keys(keyed), "suspected-keys")
    if suspects.isEmpty():
        return keyed
    narrow = settle(keyed.select("price_key", "bar_hash", *NEWEST), "loads")
    keys = settle(revised_keys(narrow, suspects), "revised-keys")
    files = settle(revised_files(narrow, keys), "revised-files")
    judged = settle(narrow.join(files, "source_file", "left_semi"), "judged-loads")
    travelled = settle(judged.select("price_key").distinct(), "travelled-keys")
    candidates = null_safe_filter(narrow, travelled, ["price_key"], "left_semi")
    newest = newest_loads(candidates)
    losers = null_safe_filter(judged, newest, ["price_key", "bar_hash", *NEWEST], "left_anti")
    losers = settle(losers.select("price_key", "bar_hash", *NEWEST).distinct(), "losing-loads")
    return null_safe_filter(keyed, losers, ["price_key", "bar_hash", *NEWEST], "left_anti")
