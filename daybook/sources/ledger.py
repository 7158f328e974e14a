"""Append-only ledgers: what was published and what was loaded, by content."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.bars import utc_literal


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or directory is there, on whatever file system it names."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def read_ledger(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All entries; none if nothing was ever recorded."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def append_ledger(entries: DataFrame, path: str, schema: T.StructType) -> None:
    """Add entries. Called after the data they describe is in place."""
    entries.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("append").parquet(
        path
    )


def latest_entries(ledger: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest entry of each key."""
    others = [c for c in ledger.columns if c not in keys]
    newest = ledger.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("entry"))
    return newest.select(*keys, "entry.*")


def within_history(
    ledger: DataFrame, now: datetime.datetime, history_days: int | None
) -> DataFrame:
    """Entries still remembered. ``None`` remembers all; 64 days forgets like a
    load history that expires, after which an unchanged file loads again."""
    if history_days is None:
        return ledger
    oldest = now - datetime.timedelta(days=history_days)
    return ledger.filter(F.col("loaded_at") >= utc_literal(oldest))
