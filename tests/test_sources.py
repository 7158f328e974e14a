"""Readers, line numbers, listings, digests and the merge of day partitions."""

from __future__ import annotations

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators.upsert import merge_days
from daybook.scratch import settle
from daybook.sources import lines as line_source
from daybook.sources.day_files import among_days, json_line, parse_landed, read_day_lines, read_days, write_days
from daybook.sources.listing import day_partitions, list_files, list_objects, paths_of, stage_summary
from daybook.sources.reference import check_widths, missing_from, read_reference, read_universe, universe_override
from daybook.sources.responses import bars_to_rows, envelope_bars, read_responses
from helpers import day, rows_of


def test_universe_file(spark, tmp_path):
    (tmp_path / "universe.txt").write_text("# all of them\n aapl \n\nMSFT\t# big\n#x\n\t\u00a0\x1f\n\u2003brk.b\t\n")
    assert rows_of(read_universe(spark, str(tmp_path / "universe.txt"))) == [("AAPL",), ("BRK.B",), ("MSFT",)]


def test_universe_override(spark):
    df = spark.createDataFrame([(" aapl, ,msft,,",)], "value string")
    assert rows_of(universe_override(df)) == [("AAPL",), ("MSFT",)]


def test_missing_symbols(spark):
    asked = spark.createDataFrame([("A",), ("B",), ("B",)], "ticker string")
    assert rows_of(missing_from(asked, asked.filter("ticker = 'A'"))) == [("B",)]


def test_reference_keeps_quoted_commas_and_checks_widths(spark, tmp_path):
    path = tmp_path / "reference.csv"
    path.write_text('ticker,company_name,sector\nAA,"Aye, Inc.",Energy\nBB,,Energy\n')
    assert rows_of(read_reference(spark, str(path))) == [("AA", "Aye, Inc.", "Energy"), ("BB", None, "Energy")]
    wide = spark.createDataFrame([("ELEVENCHARS", "x", "y")], "ticker string, company_name string, sector string")
    with pytest.raises(Exception, match="longer than 10"):
        check_widths(wide).collect()


def test_malformed_reference_fails(spark, tmp_path):
    path = tmp_path / "reference.csv"
    path.write_text("ticker,company_name,sector\nAA,Aye,Energy,surplus\n")
    with pytest.raises(Exception):
        read_reference(spark, str(path)).collect()


def test_envelopes(spark):
    bar = {"T": "A", "o": 229, "t": 1_704_153_600_000, "n": 3}
    docs = [{"ticker": "A", "status": "OK", "results": [bar, bar]}, {"ticker": "B", "status": "DELAYED", "results": [bar]},
            {"ticker": "C", "status": "ERROR", "results": [bar]}, {"ticker": "D", "status": "OK"},
            {"ticker": "E", "status": "OK", "results": []}, {"ticker": "F"}]
    rows = bars_to_rows(envelope_bars(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")), "now")
    assert rows_of(rows, "ticker", "position", "trade_date", "open", "vwap", "transactions", "ingested_at_utc") == [
        ("A", 0, datetime.date(2024, 1, 2), 229.0, None, 3, "now"),
        ("A", 1, datetime.date(2024, 1, 2), 229.0, None, 3, "now"),
        ("B", 0, datetime.date(2024, 1, 2), 229.0, None, 3, "now")]


def test_landed_response_files(spark, tmp_path):
    for run, ticker, closes in (("2024-01-02T0700", "AA", [1, 2.5]), ("2024-01-02T0700", "B.C", [3]), ("2024-01-03T0700", "AA", [])):
        folder = tmp_path / f"run={run}"
        folder.mkdir(exist_ok=True)
        (folder / f"{ticker}.json").write_text(json.dumps([{"c": c} for c in closes], indent=1))
    bars = read_responses(spark, str(tmp_path))
    got = bars.select("run", "ticker", "position", F.variant_get("bar", "$.c", "double"))
    assert rows_of(got) == [("2024-01-02T0700", "AA", 0, 1.0), ("2024-01-02T0700", "AA", 1, 2.5), ("2024-01-02T0700", "B.C", 0, 3.0)]


def many_lines(root, counts, width=40):
    for name, count in counts.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(f"{name}:{i + 1}:{'x' * width}\n" + ("\n" if i % 50 == 0 else "") for i in range(count)))


def test_line_numbers_across_splits_and_part_files(spark, tmp_path):
    """Files far larger than a split, and a day made of several part files."""
    root = tmp_path / "days"
    many_lines(root, {"date=2024-01-02/prices.jsonl": 3000, "date=2024-01-03/part-0.txt": 700, "date=2024-01-03/part-1.txt": 40,
                      "date=2024-01-04/prices.jsonl": 1})
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
        spark.conf.set("spark.sql.files.openCostInBytes", "1024")
        scanned = line_source.scan_lines(spark, str(root))
        assert scanned.rdd.getNumPartitions() > 8
        numbered = line_source.number_lines(scanned).select("source_file", "file_row_number", "value").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(numbered) == 3741
    for row in numbered:
        name, line, _ = row.value.split(":")
        offset = 700 if name.endswith("part-1.txt") else 0
        assert row.file_row_number == int(line) + offset
        assert row.source_file == name.split("/")[0] + "/prices.jsonl"


def test_scan_prunes_days(spark, tmp_path):
    many_lines(tmp_path / "days", {f"date=2024-01-0{d}/prices.jsonl": 3 for d in range(1, 6)})
    days = spark.createDataFrame([(datetime.date(2024, 1, 3),), (None,)], "d date")
    one = line_source.scan_lines(spark, str(tmp_path / "days"), among_days(days, "d"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert one.count() == 3


def test_digest_depends_on_content_only(spark):
    def digest(*rows):
        df = spark.createDataFrame([("f", r) for r in rows], "source_file string, value string")
        return line_source.object_digests(df.repartition(5)).first().digest

    assert digest("a", "b", "c") == digest("c", "a", "b")
    assert len({digest("a", "b"), digest("a", "c"), digest("a"), digest("a", "a"), digest("a", "b", "b")}) == 5


def test_listing(spark, tmp_path):
    root = tmp_path / "days"
    many_lines(root, {"date=2024-01-03/part-0.txt": 5, "date=2024-01-03/part-1.txt": 4, "date=2024-01-02/prices.jsonl": 2})
    (root / "_SUCCESS").write_text("")
    sizes = {p.name: p.stat().st_size for p in root.rglob("*.*")}
    total = sum(v for k, v in sizes.items() if k != "_SUCCESS")
    assert tuple(stage_summary(list_files(spark, str(root))).first()) == (3, total)
    assert tuple(stage_summary(list_objects(spark, str(root))).first()) == (2, total)
    assert [str(r.date) for r in day_partitions(spark, str(root)).collect()] == ["2024-01-02", "2024-01-03"]
    third = spark.createDataFrame([("date=2024-01-03/prices.jsonl",)], "source_file string")
    assert sorted(p[-11:] for p in paths_of(list_files(spark, str(root)), third)) == ["/part-0.txt", "/part-1.txt"]
    assert "content" not in list_files(spark, str(root))._jdf.queryExecution().optimizedPlan().toString().split("Project")[0]


def test_variant_tables_return_the_json_they_got(spark):
    docs = ['{"c":229,"t":"A","v":1.5}', '{"c":229.15,"t":"B","v":2}', '{"c":"x","extra":{"a":[1,2]},"v":null}', '{"c":12345678901234567,"v":1.0E300}', '[1,"two"]']
    payloads = spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).select(F.parse_json("value").alias("payload"))
    table = settle(payloads, "variants")
    assert sorted(r[0] for r in table.select(F.to_json("payload")).collect()) == sorted(docs)


FIELDS = ("open", "high", "low", "close", "volume", "vwap")


def landed(spark, rows, position=False):
    kind = "trade_date date, ticker string, " + "".join(f"{f} double, " for f in FIELDS) + "transactions bigint, ingested_at_utc string"
    return spark.createDataFrame(rows, kind + (", position int" if position else ""))


def test_written_days_read_back(spark, tmp_path):
    rows = landed(spark, [(day(0), 'A"quote\\', 229.0, 229.15, 1e-7, None, 1e16, 123456789.5, 4, "s"), (day(0), "B", 1.0, 2.0, 3.0, 4.0, 5.0, None, None, "s"),
                          (day(1), "A", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7, "s")])
    root = str(tmp_path / "days")
    write_days(rows, root)
    assert rows_of(read_days(spark, root), *rows.columns) == rows_of(rows)
    write_days(rows.filter(F.col("trade_date") == day(1)).withColumn("open", F.lit(9.0)), root)
    assert rows_of(read_days(spark, root), "trade_date", "open") == [(day(0), 1.0), (day(0), 229.0), (day(1), 9.0)]
    first = [json.loads(r.value) for r in spark.read.text(f"{root}/date={day(0)}").collect()]
    assert [type(first[0][f]).__name__ for f in ("open", "high", "close")] == ["int", "float", "NoneType"]


def test_lines_are_valid_json(spark):
    rows = landed(spark, [(day(0), "A\n\t", 1.5, None, -2.0, 1e300, 1e-300, 0.0, 1, "é")])
    line = rows.select(json_line().alias("value"))
    assert list(json.loads(line.first().value)) == ["ticker", "trade_date", *FIELDS, "transactions", "ingested_at_utc"]
    assert rows_of(parse_landed(line), *rows.columns) == rows_of(rows)


def fold(old, new):
    """The merge one received row at a time."""
    merged = {(r[0], r[1]): (r, False) for r in old}
    for r in new:
        key, row = (r[0], r[1]), r[:-1]
        if key in merged and merged[key][0][:-1] == row[:-1]:
            continue
        merged[key] = (row, True)
    return {k: r for k, (r, _) in merged.items()}, {k[0] for k, (_, c) in merged.items() if c}


@pytest.mark.parametrize("seed", range(4))
def test_merge_of_random_days(spark, seed):
    rnd = random.Random(seed)

    def row(d, t, stamp):
        return (day(d), t, 1.0, 2.0, rnd.choice([None, 0.5]), float(rnd.randrange(2)), 5.0, rnd.choice([None, 1.0]), 3, stamp)

    old = [row(d, t, "old") for d in range(4) for t in "ABCD" if rnd.random() < 0.7]
    new = [(*row(d, t, "new"), i) for d in range(1, 6) for t in "ABCE" for i in range(rnd.choice([0, 1, 1, 2]))]
    merged = merge_days(landed(spark, old), landed(spark, new, True))
    want, _ = fold(old, sorted(new, key=lambda r: r[-1]))
    got = {(r.trade_date, r.ticker): tuple(r[c] for c in ("trade_date", "ticker", *FIELDS, "transactions", "ingested_at_utc")) for r in merged.collect()}
    assert {k: v[:-1] for k, v in got.items()} == {k: v[:-1] for k, v in want.items()}
    before = {(r[0], r[1]): r for r in old}
    for key, r in got.items():
        kept = [n for n in new if (n[0], n[1]) == key]
        all_same = key in before and all(n[:-2] == before[key][:-1] for n in kept)
        assert r[-1] == ("old" if all_same else "new")


def test_merge_compares_fields_either_side_has(spark):
    old = landed(spark, [(day(0), "A", 1.0, 2.0, 0.5, 1.0, 5.0, 1.0, 3, "old"), (day(0), "B", 1.0, 2.0, 0.5, 1.0, 5.0, 1.0, 3, "old")])
    new = landed(spark, [(day(0), "A", 1.0, 2.0, 0.5, 1.0, 5.0, 1.0, 3, "new", 0), (day(0), "B", 1.0, 2.0, 0.5, 1.0, 5.0, 1.0, 3, "new", 0)], True)
    new = new.withColumn("otc", F.when(F.col("ticker") == "A", F.lit(True)))
    assert rows_of(merge_days(old, new), "ticker", "otc", "ingested_at_utc", "changed") == [
        ("A", True, "new", True), ("B", None, "old", False)]


def test_line_numbers_do_not_depend_on_how_a_scan_is_split(spark, tmp_path):
    """The settings change between the first look and the numbering."""
    root = tmp_path / "stage"
    many_lines(root, {"date=2024-01-02/prices.jsonl": 4000, "late.jsonl": 300, "a b+c%/deep/x.jsonl": 50})
    keys = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set(keys[1], "1024")
        spark.conf.set(keys[0], "4")
        scanned = line_source.scan_lines(spark, str(root))
        numbered = line_source.number_lines(scanned)
        spark.conf.set(keys[0], "7")
        rows = numbered.collect()
        text = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert len(rows) == 4350
    assert all(r.file_row_number == int(r.value.split(":")[1]) and r.source_file == r.value.split(":")[0] for r in rows)
    assert "Sort" not in text and not [x for x in text.split("Exchange")[1:] if "value" in x.split("FileScan")[0]]


def test_a_line_without_a_known_split_fails(spark, tmp_path, monkeypatch):
    many_lines(tmp_path / "days", {"x.jsonl": 5})
    monkeypatch.setattr(line_source, "settle", lambda df, label: df.limit(0) if label == "splits" else settle(df, label))
    with pytest.raises(Exception, match="no line offset"):
        line_source.number_lines(line_source.scan_lines(spark, str(tmp_path / "days"))).collect()


def test_repeated_lines_on_disk_collapse_to_the_last(spark, tmp_path):
    rows = landed(spark, [(day(0), "A", 1.0, 2.0, 0.5, 1.0, 5.0, 1.0, 3, "first"), (day(1), "B", 1.0, 2.0, 0.5, 1.0, 5.0, 1.0, 3, "s")])
    root = tmp_path / "days"
    write_days(rows, str(root))
    folder = root / f"date={day(0)}"
    path = next(folder.glob("part-*"))
    path.with_name(f".{path.name}.crc").unlink()
    line = path.read_text()
    path.write_text(line + line.replace("first", "second") + line.replace("first", "last"))
    old = read_day_lines(spark, str(root), F.col("date").isNotNull())
    new = landed(spark, [(day(1), "B", 1.0, 2.0, 0.5, 1.0, 5.0, 1.0, 3, "new", 0)], True)
    assert rows_of(merge_days(old, new), "trade_date", "ticker", "ingested_at_utc", "changed") == [
        (day(0), "A", "last", True), (day(1), "B", "s", False)]
