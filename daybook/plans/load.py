"""Appending staged files to the raw table, each content once."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.bars import bar_fingerprint, utc_literal
from daybook.operators.duplicates import classify_duplicates, verdict
from daybook.operators.measures import table_measure
from daybook.plans.kept import KeptMeasure
from daybook.plans.manifests import append_manifest, load_manifest, run_name
from daybook.plans.staging import typed_bars
from daybook.schemas import BAR_NUMBERS, LOAD_LEDGER, RAW
from daybook.scratch import settle, settled_inside
from daybook.sources.ledger import append_ledger, latest_entries, path_exists, read_ledger, within_history
from daybook.sources.lines import as_payload, numbered, object_digests, scan_lines
from daybook.sources.listing import list_files, objects_of, paths_of, stage_summary
from daybook.sources.tags import Tagger, object_tags, split_by_tag, store_tags

# Fixed value: days a load history is kept where that behaviour is asked for.
EXPIRING_HISTORY_DAYS = 64


def files_to_load(staged: DataFrame, ledger: DataFrame) -> DataFrame:
    """Staged objects whose path and content were not loaded before."""
    return staged.join(ledger.select("source_file", "digest"), ["source_file", "digest"], "left_anti")


def read_raw(spark: SparkSession, raw: str, ledger: str, load_ids: list[str] | None = None) -> DataFrame:
    """The raw table, without rows of a load that never reached the ledger, or some loads of it.

    Loads are folders, so only those that are asked for are read.
    """
    if not path_exists(spark, raw):
        return spark.createDataFrame([], RAW)
    schema = T.StructType([*RAW.fields, T.StructField("load_id", T.StringType())])
    committed = read_ledger(spark, ledger, LOAD_LEDGER).select("load_id").distinct()
    rows = spark.read.schema(schema).parquet(raw)
    rows = rows if load_ids is None else rows.filter(F.col("load_id").isin(load_ids))
    return rows.join(committed, "load_id", "left_semi").select(*RAW.names)


def loads_of(raw: DataFrame) -> DataFrame:
    """(ticker, trade_date, source_file, bar_hash) of every raw row."""
    return typed_bars(raw).select(
        "ticker",
        "trade_date",
        "source_file",
        bar_fingerprint([F.col(n) for n in BAR_NUMBERS]).alias("bar_hash"),
    )


def load_new_files(
    spark: SparkSession,
    stage: str,
    raw: str,
    ledger: str,
    now: datetime.datetime,
    history_days: int | None = None,
    files: DataFrame | None = None,
    tags: Tagger = store_tags,
) -> dict[str, int]:
    """Append the lines of new or changed objects; no such objects is a success.

    Everything under the stage is looked at, at whatever depth it lies. Objects whose path
    and content the ledger knows are left out: by the tag that the store has of the
    content, without opening them, or by a digest of the content where there is no tag or
    another one. Only the files of the others are read again, to be written once and
    numbered from there. Raw rows carry a load id, and the ledger entries that make them
    visible come last, so a failed load adds nothing. A known content under a new tag is
    entered without rows, so it is read for its tag once. ``files`` is the listing, where
    the caller has it already.
    """
    files = settle(list_files(spark, stage), "listed") if files is None else files
    if files.isEmpty():
        return {"files_processed": 0, "rows_loaded": 0}
    known = settle(within_history(read_ledger(spark, ledger, LOAD_LEDGER), now, history_days), "ledger")
    tagged = settle(object_tags(files, tags(spark, stage, files)), "tags")
    same, suspects = split_by_tag(tagged, known, ["source_file", "tag"])
    # A stage without tags is scanned by its root, which needs no list of paths.
    paths = paths_of(files, suspects) if not same.isEmpty() else None
    if paths == []:
        return {"files_processed": 0, "rows_loaded": 0}
    digests = settle(object_digests(scan_lines(spark, stage, paths=paths)), "digests")
    fresh = settle(files_to_load(digests, known), "fresh")
    _enter_tags(digests.join(tagged.filter("tag IS NOT NULL"), "source_file"), known, ledger)
    paths = paths_of(files, fresh)
    if not paths:
        return {"files_processed": 0, "rows_loaded": 0}
    load_id = uuid.uuid4().hex
    loaded_at = utc_literal(now).alias("loaded_at")
    lines = settle(scan_lines(spark, stage, paths=paths), "new-lines")
    as_payload(numbered(lines)).select(
        "payload", "source_file", "file_row_number", loaded_at, F.lit(load_id).alias("load_id")
    ).write.mode("append").partitionBy("load_id").parquet(raw)
    # The digests are those of the lines that were loaded, not of an earlier look.
    entries = object_digests(lines).join(objects_of(files), "source_file").join(tagged, "source_file")
    entries = settle(entries.select("*", F.lit(load_id).alias("load_id"), loaded_at), "entries")
    append_ledger(entries, ledger, LOAD_LEDGER)
    totals = entries.agg(F.count("*").alias("files"), F.sum("row_count").alias("rows")).first()
    return {"files_processed": totals["files"], "rows_loaded": totals["rows"]}


def _enter_tags(seen: DataFrame, known: DataFrame, ledger: str) -> None:
    """Remember new tags of contents that were loaded before, each with its load and no rows."""
    known = known.filter("row_count > 0").select("source_file", "digest", "bytes", "modified_at", "load_id", "loaded_at")
    newest = latest_entries(known, ["source_file", "digest"], "loaded_at")
    entries = seen.drop("row_count").join(newest, ["source_file", "digest"]).withColumn("row_count", F.lit(0))
    entries = settle(entries, "tag-entries")
    if not entries.isEmpty():
        append_ledger(entries, ledger, LOAD_LEDGER)


def load(
    spark: SparkSession,
    stage: str,
    raw: str,
    ledger: str,
    now: datetime.datetime,
    dry_run: bool = False,
    history_days: int | None = None,
    manifests: str | None = None,
    tags: Tagger = store_tags,
) -> dict:
    """A load with its check: rows before, measure after, manifest and verdict.

    The measure and the repeated keys are kept in a folder beside the ledger and added to,
    so of the raw table only the new load's own rows are read. A dry run adds nothing, and
    counts anew if a load has not been added yet. Duplicates are classified only when
    rows and keys differ. The verdict is ``STOP`` when a file came in twice unchanged,
    ``WARN`` on a revision.
    """
    with settled_inside(spark):
        files = settle(list_files(spark, stage), "listed")
        staged = stage_summary(objects_of(files))
        before = _rows_recorded(spark, ledger)
        loaded = {"files_processed": 0, "rows_loaded": 0}
        if not dry_run:
            loaded = load_new_files(spark, stage, raw, ledger, now, history_days, files, tags)
        kept = kept_measure(spark, raw, ledger)
        if not dry_run:
            kept.take_up()
        known = not kept.missing()
        after = kept.measure() if known else table_measure(typed_bars(read_raw(spark, raw, ledger)))
        manifest = load_manifest(before, after, loaded, staged, run_name(now), dry_run)
        record = manifest.first()
        if manifests:
            append_manifest(spark.createDataFrame([record], manifest.schema), f"{manifests}/load")
        result = record.asDict() | {"verdict": "OK"}
        if result["rows_after"] != result["distinct_keys_after"]:
            summary = kept.classified() if known else classify_duplicates(loads_of(read_raw(spark, raw, ledger)))
            result |= verdict(summary).first().asDict()
        return result


def kept_measure(spark: SparkSession, raw: str, ledger: str) -> KeptMeasure:
    """The measure of a raw table that is kept beside its ledger."""
    return KeptMeasure(
        spark, lambda load_ids: loads_of(read_raw(spark, raw, ledger, load_ids)), ledger, f"{ledger}-measure"
    )


def _rows_recorded(spark: SparkSession, ledger: str) -> int:
    """Rows of the raw table before a load, from its ledger instead of a scan."""
    rows = read_ledger(spark, ledger, LOAD_LEDGER).agg(F.sum("row_count").alias("rows"))
    return rows.first()["rows"] or 0
