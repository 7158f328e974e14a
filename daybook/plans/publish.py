"""Copying changed day partitions to the stage the loader reads."""

from __future__ import annotations

import datetime

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.bars import utc_literal
from daybook.plans.manifests import append_manifest, publish_manifest, run_name
from daybook.schemas import PUBLISH_LEDGER
from daybook.scratch import null_safe_filter, settle, settled_inside
from daybook.sources.ledger import append_ledger, path_exists, read_ledger
from daybook.sources.lines import day_of_object, object_digests, scan_lines
from daybook.sources.listing import list_files, objects_of, paths_of
from daybook.sources.tags import Tagger, object_tags, split_by_tag, store_tags

# Fixed value: where published days live under the stage.
PREFIX = "raw/prices"


def object_name(source_file: str) -> Column:
    """An object's key at the stage."""
    return F.concat(F.lit(f"{PREFIX}/"), source_file).alias("object_key")


def digested_objects(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """(object_key, digest) of what lies under a directory, read from its content."""
    digests = object_digests(scan_lines(spark, root, paths=paths))
    return digests.select(object_name("source_file"), "digest")


def published_objects(spark: SparkSession, stage: str, paths: list[str] | None = None) -> DataFrame:
    """(object_key, digest) of what the stage holds now, whoever wrote it."""
    root = f"{stage}/{PREFIX}"
    if paths == [] or not path_exists(spark, root):
        return spark.createDataFrame([], "object_key string, digest string")
    return digested_objects(spark, root, paths)


def tagged_objects(spark: SparkSession, root: str, tags: Tagger) -> tuple[DataFrame, DataFrame]:
    """(listing, (object_key, tag) of each object) of a directory, which may be missing."""
    if not path_exists(spark, root):
        none = spark.createDataFrame([], "source_file string, path string, bytes long, modified_at timestamp")
        return none, spark.createDataFrame([], "object_key string, tag string")
    files = settle(list_files(spark, root), "listed")
    found = object_tags(files, tags(spark, root, files))
    return files, settle(found.select(object_name("source_file"), "tag"), "tags")


def publish_plan(local: DataFrame, published: DataFrame) -> DataFrame:
    """Each local object with what to do: ``skip`` an identical one, else ``upload``."""
    same = published.select("object_key", "digest", F.lit(True).alias("identical"))
    return local.join(same, ["object_key", "digest"], "left").select(
        *local.columns, F.when(F.col("identical"), "skip").otherwise("upload").alias("action")
    )


def publish(
    spark: SparkSession,
    root: str,
    stage: str,
    ledger: str,
    started_at: datetime.datetime,
    dry_run: bool = False,
    manifests: str | None = None,
    tags: Tagger = store_tags,
) -> dict:
    """Replace the stage's copy of every changed day; returns the manifest.

    Content decides. Where both stores have tags of their contents and the ledger has
    them as those of one content, an object is skipped without being opened. The others
    are digested on both sides, each in one pass that adds up line hashes, so a copy that
    was altered at the stage is found whatever its size and time. Objects that cannot be written are left out, named in the manifest with the
    reason, and do not keep the others from being published. The ledger is written
    last. A run that dies in between publishes the same days again.
    """
    with settled_inside(spark):
        files, here = tagged_objects(spark, root, tags)
        stage_root = f"{stage}/{PREFIX}"
        staged, there = tagged_objects(spark, stage_root, tags)
        tagged = settle(_both_tags(here, there), "both-tags")
        known = read_ledger(spark, ledger, PUBLISH_LEDGER)
        same, suspects = split_by_tag(tagged, known, ["object_key", "local_tag", "stage_tag"])
        local = objects_of(files).select(object_name("source_file"), "bytes", "modified_at")
        if same.isEmpty():
            plan = publish_plan(local.join(digested_objects(spark, root), "object_key"), published_objects(spark, stage))
        else:
            plan = _plan_of_suspects(spark, root, stage_root, files, staged, same, suspects, known, local)
        plan = settle(plan, "publish-plan")
        failed: list[tuple[str, str]] = []
        if not dry_run:
            sent = plan.filter(F.col("action") == "upload")
            days = sorted(r.object_key for r in sent.select("object_key").collect())
            failed = _copied(spark, files, root, f"{stage}/{PREFIX}", days)
            done = plan.filter(~F.col("object_key").isin([key for key, _ in failed]))
            if days:
                _, there = tagged_objects(spark, stage_root, tags)
            _record(spark, done.join(_both_tags(here, there), "object_key"), ledger, started_at)
        manifest = publish_manifest(plan, run_name(started_at), dry_run, failed)
        record = settle(manifest, "publish-manifest").first()
        if manifests:
            kept = spark.createDataFrame([record], manifest.schema)
            append_manifest(kept, f"{manifests}/publish")
        return record.asDict(recursive=True)


def _both_tags(here: DataFrame, there: DataFrame) -> DataFrame:
    """(object_key, local_tag, stage_tag) of every local object."""
    there = there.withColumnRenamed("tag", "stage_tag")
    return here.withColumnRenamed("tag", "local_tag").join(there, "object_key", "left")


def _plan_of_suspects(
    spark: SparkSession,
    root: str,
    stage_root: str,
    files: DataFrame,
    staged: DataFrame,
    same: DataFrame,
    suspects: DataFrame,
    known: DataFrame,
    local: DataFrame,
) -> DataFrame:
    """The plan where some objects are known by their tags: only the others are read."""
    tags = ["object_key", "local_tag", "stage_tag"]
    digests = known.groupBy(*tags).agg(F.max("digest").alias("digest"))
    skipped = local.join(same.join(digests, tags).select("object_key", "digest"), "object_key")
    skipped = skipped.withColumn("action", F.lit("skip"))
    wanted = suspects.select(F.substr("object_key", F.lit(len(PREFIX) + 2)).alias("source_file"))
    wanted = settle(wanted, "suspects")
    paths = paths_of(files, wanted)
    if not paths:
        return skipped
    read = local.join(digested_objects(spark, root, paths), "object_key")
    held = published_objects(spark, stage_root.removesuffix(f"/{PREFIX}"), paths_of(staged, wanted))
    return skipped.unionByName(publish_plan(read, held))


def _record(spark: SparkSession, done: DataFrame, ledger: str, at: datetime.datetime) -> None:
    """Remember the objects that are now at the stage as they are here, each once."""
    entries = done.select(
        "object_key",
        "digest",
        F.col("bytes").alias("local_bytes"),
        F.col("modified_at").alias("local_modified_at"),
        utc_literal(at).alias("published_at"),
        "local_tag",
        "stage_tag",
    )
    same = ["object_key", "digest", "local_bytes", "local_modified_at", "local_tag", "stage_tag"]
    entries = null_safe_filter(entries, read_ledger(spark, ledger, PUBLISH_LEDGER).select(*same), same, "left_anti")
    entries = settle(entries, "published")
    if not entries.isEmpty():
        append_ledger(entries, ledger, PUBLISH_LEDGER)


def _copied(
    spark: SparkSession, files: DataFrame, root: str, target: str, keys: list[str]
) -> list[tuple[str, str]]:
    """Copy objects in one job; the keys that could not be copied, with the reason.

    A failed job has changed nothing. It is repeated in halves until the objects that
    cannot be written stand alone, so few failures cost few more jobs.
    """
    if not keys:
        return []
    try:
        _copy_days(spark, files, root, target, keys)
        return []
    except (Py4JError, PySparkException) as error:
        if len(keys) == 1:
            reason = str(error).strip().splitlines()
            return [(keys[0], reason[0][:300] if reason else type(error).__name__)]
        half = len(keys) // 2
        return _copied(spark, files, root, target, keys[:half]) + _copied(spark, files, root, target, keys[half:])


def _copy_days(spark: SparkSession, files: DataFrame, root: str, target: str, keys: list[str]) -> None:
    """Copy the lines of whole days over the partitions they replace.

    Every task writes what it read, in order, so nothing is shuffled. A day that
    several tasks read becomes several part files of the same object.
    """
    sent = spark.createDataFrame([(k,) for k in keys], "object_key string")
    sent = sent.select(F.substr("object_key", F.lit(len(PREFIX) + 2)).alias("source_file"))
    lines = scan_lines(spark, root, paths=paths_of(files, sent))
    lines = lines.withColumn("date", day_of_object(F.col("source_file")))
    (
        lines.sortWithinPartitions("date", "path", "block", "rid")
        .select("value", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .text(target)
    )
