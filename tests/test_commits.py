"""All days of a run count or none, and of two writers one tries again."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from helpers import day, rows_of
from pyspark.sql import functions as F
from test_sources import landed

from daybook.plans import ingest as ingest_module
from daybook.plans.ingest import upsert_days
from daybook.sources import commits, day_files
from daybook.sources.commits import DaysChanged, Snapshot, newest_snapshot, read_snapshot
from daybook.sources.day_files import among_days, read_days, write_days
from daybook.sources.lines import scan_lines
from daybook.sources.listing import day_partitions, list_files


def bars(spark, *rows):
    """Landed rows from (ticker, day number, close)."""
    stamp = "2024-03-08T12:00:00+00:00"
    return landed(spark, [(day(d), t, 1.0, 9.0, 1.0, close, 5.0, 1.0, 2, stamp, 0) for t, d, close in rows], position=True)


def held(spark, root):
    return rows_of(read_days(spark, root), "ticker", "trade_date", "close")


def test_a_run_killed_between_days_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "days")
    write_days(bars(spark, ("A", 0, 1.0), ("A", 1, 1.0), ("A", 2, 1.0)), root)
    before = held(spark, root)
    files = rows_of(list_files(spark, root), "source_file", "bytes")

    def killed(*args):
        # Files of some days are in place, and nobody is left to tidy up.
        raise KeyboardInterrupt

    monkeypatch.setattr(day_files, "commit_days", killed)
    with pytest.raises(KeyboardInterrupt):
        write_days(bars(spark, ("A", 0, 2.0), ("A", 1, 2.0), ("A", 3, 2.0)), root)
    assert len(list(Path(root).glob("date=*/part-*"))) > 3
    assert held(spark, root) == before
    assert held_where(spark, root, [0, 1, 3]) == [("A", 1.0), ("A", 1.0)]
    assert rows_of(list_files(spark, root), "source_file", "bytes") == files
    assert day_partitions(spark, root).count() == 3
    monkeypatch.undo()
    write_days(bars(spark, ("A", 0, 3.0), ("A", 3, 3.0)), root)
    assert [r[2] for r in held(spark, root)] == [3.0, 1.0, 1.0, 3.0]


def held_where(spark, root, days):
    where = among_days(spark.createDataFrame([(day(d),) for d in days], "day date"), "day")
    return rows_of(read_days(spark, root, where), "ticker", "close")


def test_a_failed_write_deletes_its_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "days")
    write_days(bars(spark, ("A", 0, 1.0)), root)
    names = sorted(p.name for p in Path(root).glob("date=*/part-*"))

    def failing(*args):
        raise OSError("no space left on device")

    monkeypatch.setattr(day_files, "commit_days", failing)
    with pytest.raises(OSError):
        write_days(bars(spark, ("A", 0, 2.0), ("A", 1, 2.0)), root)
    assert sorted(p.name for p in Path(root).glob("date=*/part-*")) == names


def test_of_two_writers_of_one_day_one_is_told(spark, tmp_path):
    root = str(tmp_path / "days")
    write_days(bars(spark, ("A", 0, 1.0), ("A", 1, 1.0)), root)
    base = newest_snapshot(spark, root)
    write_days(bars(spark, ("A", 0, 2.0)), root, base=base)
    with pytest.raises(DaysChanged):
        write_days(bars(spark, ("A", 0, 3.0), ("A", 2, 3.0)), root, base=base)
    with pytest.raises(DaysChanged):
        write_days(bars(spark, ("A", 2, 3.0)), root, base=base, read=[str(day(0))])
    # Days that nobody else wrote go behind the other's record.
    write_days(bars(spark, ("A", 1, 4.0)), root, base=base)
    assert [r[2] for r in held(spark, root)] == [2.0, 4.0]
    assert newest_snapshot(spark, root).number == 3


@pytest.mark.parametrize("linked", [True, False])
def test_a_number_is_taken_once(spark, tmp_path, monkeypatch, linked):
    root = str(tmp_path / "days")
    write_days(bars(spark, ("A", 0, 1.0)), root)
    first = newest_snapshot(spark, root)
    if linked:
        assert not commits._taken_once(spark, root, Snapshot(1, {"2024-01-02": "x"}))
    else:
        target, system = commits._path(spark, commits._record(root, 1))
        draft, _ = commits._path(spark, f"{root}/_commits/_draft")
        system.create(draft, False).close()
        with pytest.raises(Exception, match="already exists|AlreadyExists"):
            commits._rename(spark, system, draft, target)
        target, _ = commits._path(spark, commits._record(root, 2))
        commits._rename(spark, system, draft, target)
        assert system.exists(target)
    assert read_snapshot(spark, root, 1) == first


def test_the_losing_run_merges_anew(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "days")
    upsert_days(spark, root, bars(spark, ("A", 0, 1.0), ("B", 0, 1.0)))
    merge, met = ingest_module.merge_days, []

    def overtaken(old, rows):
        merged = merge(old, rows)
        if not met:
            met.append(True)
            merged.count()
            write_days(bars(spark, ("A", 0, 1.0), ("B", 0, 5.0), ("C", 0, 6.0)), root)
        return merged

    monkeypatch.setattr(ingest_module, "merge_days", overtaken)
    result = upsert_days(spark, root, bars(spark, ("A", 0, 9.0)))
    assert result == {"dates_touched": 1, "dates_rewritten": 1}
    assert held(spark, root) == [("A", day(0), 9.0), ("B", day(0), 5.0), ("C", day(0), 6.0)]


def test_files_without_a_version_are_replaced_too(spark, tmp_path):
    root = str(tmp_path / "days")
    old = bars(spark, ("A", 0, 1.0), ("A", 1, 1.0)).select("trade_date", "ticker", day_files.json_line().alias("value"))
    old.select("value", F.col("trade_date").alias("date")).write.partitionBy("date").text(root)
    assert len(held(spark, root)) == 2
    write_days(bars(spark, ("A", 1, 2.0)), root)
    assert [r[2] for r in held(spark, root)] == [1.0, 2.0]
    write_days(bars(spark, ("A", 1, 3.0)), root)
    assert [r[2] for r in held(spark, root)] == [1.0, 3.0]
    assert not [p for p in Path(root, f"date={day(1)}").glob("part-*") if "-v" not in p.name]
    # Whoever replaces a day's folder by other means is believed.
    spark.createDataFrame([('{"ticker": "A", "trade_date": "2024-01-03", "close": 8}',)], "value string").write.mode(
        "overwrite").text(f"{root}/date={day(1)}")
    assert [r[2] for r in held(spark, root)] == [1.0, 8.0]


def test_random_runs_against_a_dictionary(spark, tmp_path):
    rng, root, want = random.Random(4), str(tmp_path / "days"), {}
    for _ in range(6):
        rows = {(rng.choice("ABC"), rng.randrange(4)): float(rng.randrange(3)) for _ in range(rng.randrange(1, 6))}
        upsert_days(spark, root, bars(spark, *[(t, d, c) for (t, d), c in rows.items()]))
        want |= rows
        assert held(spark, root) == sorted((t, day(d), c) for (t, d), c in want.items())
        # Of every day at most its version and the one before are kept.
        assert all(len({commits._version_of(p.name) for p in folder.glob("part-*")}) <= 2 for folder in Path(root).glob("date=*"))
    assert scan_lines(spark, root).count() == len(want)
