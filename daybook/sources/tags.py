"""Content tags: what a store itself knows of a file's content, without reading it.

Object stores name a content's tag in every listing, and distributed file systems give a
checksum on request. Two files of one path with equal tags hold the same bytes, whatever
their sizes and times say, so a content that was seen under a tag need not be read again.
A store that gives neither, like a local disk, has no tags, and its files are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.lines import digest_text, line_digest

TAGS = "path string, tag string"

# What a Hadoop file system is asked whether it has tags or checksums.
ETAGS = "fs.capability.etags.available"
CHECKSUMS = "fs.capability.paths.checksums"

# (spark, root, files) to (path, tag); files without a tag have no row.
Tagger = Callable[[SparkSession, str, DataFrame], DataFrame]


def store_tags(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """(path, tag) of the listed files under ``root``, as far as the store has tags.

    A tag is the ETag of a file's status, which comes with the listing of its folder, or
    else the store's checksum of its content. Folders are listed one by one in the driver,
    which holds the paths and tags of one listing, as for any scan. A store that knows
    neither is asked once and nothing is listed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    etags, checksums = (system.hasPathCapability(path, name) for name in (ETAGS, CHECKSUMS))
    if not etags and not checksums:
        return spark.createDataFrame([], TAGS)
    folders = files.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()
    found = [x for r in folders.toLocalIterator() for x in _tagged(spark, system, r.folder, etags)]
    return spark.createDataFrame(found, TAGS)


def _tagged(spark: SparkSession, system, folder: str, etags: bool) -> Iterator[tuple[str, str]]:
    for status in system.listStatus(spark._jvm.org.apache.hadoop.fs.Path(folder)):
        if not status.isFile():
            continue
        named = etags and is_instance_of(spark.sparkContext._gateway, status, "org.apache.hadoop.fs.EtagSource")
        tag = status.getEtag() if named else None
        if tag is None:
            checksum = system.getFileChecksum(status.getPath())
            tag = checksum.toString() if checksum is not None else None
        if tag:
            yield status.getPath().toString(), tag


def object_tags(files: DataFrame, tags: DataFrame) -> DataFrame:
    """(source_file, tag) of every listed object; null where a file of it has no tag.

    An object's tag is that of all its files with their names, so a file that comes, goes
    or changes its name changes it.
    """
    name = F.regexp_extract("path", "[^/]*$", 0)
    marked = files.join(tags, "path", "left").select(
        "source_file", F.concat_ws("=", name, "tag").alias("file"), F.col("tag").isNotNull().alias("known")
    )
    whole = marked.groupBy("source_file").agg(
        F.bool_and("known").alias("known"), F.count("*").alias("n"), *line_digest(F.col("file"))
    )
    return whole.select("source_file", F.when(F.col("known"), digest_text(F.col("n"))).alias("tag"))


def split_by_tag(objects: DataFrame, known: DataFrame, same: list[str]) -> tuple[DataFrame, DataFrame]:
    """(objects that ``known`` has with the same tags, the others); null tags are never the same."""
    pairs = known.select(*same).distinct()
    return objects.join(pairs, same, "left_semi"), objects.join(pairs, same, "left_anti")
