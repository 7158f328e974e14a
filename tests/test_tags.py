"""Content tags: idle steps open nothing, and content that changed behind its size is found."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_pipeline import DOCS, chain, document, first_run, loaded, rewritten  # noqa: F401

from daybook.plans import load as load_module
from daybook.plans import publish as publish_module
from daybook.schemas import LOAD_LEDGER, PUBLISH_LEDGER
from daybook.sources import tags as tags_module
from daybook.sources.ledger import read_ledger
from daybook.sources.listing import list_files
from daybook.sources.tags import TAGS, object_tags, split_by_tag, store_tags
from helpers import rows_of


def content_tags(spark, root, files):
    """What a store with ETags would list: a tag of every file's bytes."""
    paths = [r.path for r in files.select("path").collect()]
    rows = [(p, hashlib.md5(Path(p.removeprefix("file:")).read_bytes()).hexdigest()) for p in paths]
    return spark.createDataFrame(rows, TAGS)


@pytest.fixture
def opened(monkeypatch):
    """The files that scans were asked to open, or the whole root."""
    asked = []
    for module in (load_module, publish_module):
        scan = module.scan_lines

        def watched(spark, root, where=None, paths=None, scan=scan):
            asked.append([p.split("date=")[-1][:10] for p in paths] if paths is not None else root)
            return scan(spark, root, where, paths)

        monkeypatch.setattr(module, "scan_lines", watched)
    return asked


@pytest.fixture
def tagged(chain):  # noqa: F811
    """A pipeline on a store with tags after its first run."""
    chain.ingest(*DOCS)
    assert chain.publish(tags=content_tags)["files_uploaded"] == 5
    assert chain.load(tags=content_tags)["files_processed"] == 5
    return chain


def test_idle_steps_open_no_file(tagged, opened):
    published = tagged.publish(tags=content_tags)
    assert (published["files_uploaded"], published["files_skipped_identical"], published["bytes_uploaded"]) == (0, 5, 0)
    result = tagged.load(tags=content_tags)
    assert (result["files_processed"], result["rows_after"]) == (0, 15)
    assert opened == []


def test_content_changed_at_equal_size_and_time_is_found(tagged, opened):
    rewritten(f"{tagged.root}/stage/raw/prices/date=2024-03-05", '"close": 12.25', '"close": 17.25')
    result = tagged.load(tags=content_tags)
    assert (result["files_processed"], result["rows_loaded_this_run"], result["verdict"]) == (1, 3, "WARN")
    assert tagged.publish(tags=content_tags)["files_uploaded"] == 1
    rewritten(f"{tagged.root}/data/days/date=2024-03-06", '"close": 13.25', '"close": 18.25')
    published = tagged.publish(tags=content_tags)
    assert (published["files_uploaded"], published["files_skipped_identical"]) == (1, 4)
    assert {day for days in opened for day in days} == {"2024-03-05", "2024-03-06"}
    opened.clear()
    assert tagged.publish(tags=content_tags)["files_uploaded"] == 0
    assert opened == []


def test_a_new_tag_of_a_known_content_is_read_once(tagged, spark, opened):
    """Rewritten with its lines in another order: the same content under another tag."""
    path = next(Path(tagged.root, "stage/raw/prices/date=2024-03-07").glob("part-*"))
    path.write_text("".join(reversed(path.read_text().splitlines(keepends=True))))
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    before = read_ledger(spark, f"{tagged.root}/loaded", LOAD_LEDGER).count()
    result = tagged.load(tags=content_tags)
    assert (result["files_processed"], result["rows_before"], result["rows_after"]) == (0, 15, 15)
    assert opened == [["2024-03-07"]]
    entered = read_ledger(spark, f"{tagged.root}/loaded", LOAD_LEDGER)
    assert entered.count() == before + 1 and entered.filter("row_count = 0").count() == 1
    opened.clear()
    assert tagged.load(tags=content_tags)["rows_before"] == 15
    assert opened == []
    assert tagged.publish(tags=content_tags)["files_uploaded"] == 0
    opened.clear()
    assert tagged.publish(tags=content_tags)["files_skipped_identical"] == 5
    assert opened == []


def test_a_revision_opens_its_own_file_only(tagged, opened):
    assert tagged.ingest(DOCS[0], document("BB", d6={"vw": 10.5001}), DOCS[2])["dates_rewritten"] == 1
    assert tagged.publish(tags=content_tags)["files_uploaded"] == 1
    result = tagged.load(tags=content_tags)
    assert (result["files_processed"], result["verdict"], result["changed_bars"]) == (1, "WARN", 1)
    assert {day for days in opened for day in days} == {"2024-03-06"}


def test_history_that_expires_loads_again_despite_its_tag(tagged):
    tagged.load(tags=content_tags)
    tagged.clock = tagged.clock.replace(month=6)
    result = tagged.load(tags=content_tags, history_days=64)
    assert (result["files_processed"], result["verdict"]) == (5, "STOP")


def test_tags_come_and_go(loaded, opened):  # noqa: F811
    """A ledger without tags fills up at the first look; without tags everything is read again."""
    assert loaded.load(tags=content_tags)["files_processed"] == 0
    assert loaded.publish(tags=content_tags)["files_uploaded"] == 0
    opened.clear()
    assert loaded.load(tags=content_tags)["files_processed"] == 0
    assert loaded.publish(tags=content_tags)["files_uploaded"] == 0
    assert opened == []
    assert loaded.load()["files_processed"] == 0 and loaded.publish()["files_uploaded"] == 0
    assert opened == [f"{loaded.root}/stage/raw/prices", f"{loaded.root}/data/days", f"{loaded.root}/stage/raw/prices"]


def test_a_failed_load_enters_no_tag_of_new_content(tagged, spark):
    path = next(Path(tagged.root, "stage/raw/prices/date=2024-03-05").glob("part-*"))
    path.write_text("{not json")
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    for _ in range(2):
        with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|parse"):
            tagged.load(tags=content_tags)
    assert tagged.raw().count() == 15


def test_an_object_has_a_tag_if_all_its_files_have(spark):
    files = spark.createDataFrame(
        [("a", "x/a/1"), ("a", "x/a/2"), ("b", "x/b/1"), ("b", "x/b/2"), ("c", "x/c/1")], "source_file string, path string"
    )
    tags = spark.createDataFrame([("x/a/1", "t1"), ("x/a/2", "t2"), ("x/b/1", "t1")], TAGS)
    got = {r.source_file: r.tag for r in object_tags(files, tags).collect()}
    assert got["a"] and got["b"] is got["c"] is None
    swapped = spark.createDataFrame([("x/a/1", "t2"), ("x/a/2", "t1")], TAGS)
    assert {r.source_file: r.tag for r in object_tags(files, swapped).collect()}["a"] != got["a"]
    known = spark.createDataFrame([("a", got["a"]), ("b", None)], "source_file string, tag string")
    same, others = split_by_tag(object_tags(files, tags), known, ["source_file", "tag"])
    assert rows_of(same, "source_file") == [("a",)] and rows_of(others, "source_file") == [("b",), ("c",)]


def test_a_local_disk_has_no_tags(spark, loaded):  # noqa: F811
    root = f"{loaded.root}/stage/raw/prices"
    assert store_tags(spark, root, list_files(spark, root)).collect() == []
    assert read_ledger(spark, f"{loaded.root}/loaded", LOAD_LEDGER).filter("tag IS NOT NULL").count() == 0
    assert read_ledger(spark, f"{loaded.root}/published", PUBLISH_LEDGER).filter("stage_tag IS NOT NULL").count() == 0


class Status:
    def __init__(self, path, etag, file=True):
        self.path, self.etag, self.file = path, etag, file

    def isFile(self):
        return self.file

    def getPath(self):
        return self

    def toString(self):
        return self.path

    def getEtag(self):
        return self.etag


class Store:
    """Statuses with ETags, and checksums for the others."""

    def listStatus(self, folder):
        return [Status("s/1", "e1"), Status("s/2", None), Status("s/3", None), Status("s/sub", "e", False)]

    def getFileChecksum(self, path):
        return Status("md5-of-s/2", None) if path.path == "s/2" else None


def test_etags_before_checksums(spark, monkeypatch):
    monkeypatch.setattr(tags_module, "is_instance_of", lambda gateway, status, kind: status.etag is not None)
    assert list(tags_module._tagged(spark, Store(), "s", True)) == [("s/1", "e1"), ("s/2", "md5-of-s/2")]
    assert list(tags_module._tagged(spark, Store(), "s", False)) == [("s/2", "md5-of-s/2")]
