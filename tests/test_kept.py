"""The kept measure against a recount of the whole raw table."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from test_pipeline import DOCS, TICKERS, chain, document, first_run, loaded  # noqa: F401

from daybook.operators.duplicates import classify_duplicates
from daybook.operators.measures import table_measure
from daybook.plans import kept as kept_module
from daybook.plans import load as load_module
from daybook.plans.kept import KeptMeasure
from daybook.plans.load import kept_measure, load_new_files, loads_of
from daybook.plans.staging import typed_bars


def kept_of(chain):  # noqa: F811
    return kept_measure(chain.spark, f"{chain.root}/raw", f"{chain.root}/loaded")


def check(chain):  # noqa: F811
    """Kept and counted, both measures and both classifications."""
    kept = kept_of(chain)
    assert kept.missing() == []
    counted = table_measure(typed_bars(chain.raw())).first()
    assert kept.measure().first() == counted
    assert kept.classified().first() == classify_duplicates(loads_of(chain.raw())).first()
    return counted


def staged(chain, name, rows):  # noqa: F811
    """One object of (ticker, day of March, close) lines at the stage."""
    folder = Path(chain.root, "stage/raw/prices", name)
    folder.mkdir(parents=True, exist_ok=True)
    for old in folder.glob("*"):
        old.unlink()
    lines = [
        json.dumps({"ticker": t, "trade_date": d and f"2024-03-{d:02d}", "close": c, "volume": 1}) for t, d, c in rows
    ]
    (folder / "part-0.jsonl").write_text("\n".join(lines) + "\n")


def test_empty_raw_table(chain):  # noqa: F811
    assert check(chain).rows_total == 0
    assert kept_of(chain).take_up() == 0


def test_random_loads_and_revisions(chain):  # noqa: F811
    """Objects of a day or of several, new, revised, repeated and with missing keys."""
    rng = random.Random(3)
    for step in range(6):
        for _ in range(rng.randrange(1, 4)):
            day = rng.randrange(1, 7)
            days = [day] if rng.random() < 0.6 else [day, day + 1, day + 9]
            rows = [(t, d, rng.choice([1.5, 2.5])) for t in rng.sample("ABCDE", rng.randrange(1, 5)) for d in days]
            rows += rng.sample(rows, rng.randrange(0, 2))
            rows += [(None, day, 1.0)] * rng.randrange(2) + [("N", None, 1.0)] * rng.randrange(2)
            staged(chain, f"date=2024-03-{day:02d}" if len(days) == 1 else f"mixed/{day}", rows)
        result = chain.load()
        counted = check(chain)
        assert (result["rows_after"], result["distinct_keys_after"]) == (counted.rows_total, counted.distinct_keys)
        assert (result["files_after"], result["tickers_after"]) == (counted.files_total, counted.tickers)
    assert counted.rows_total > counted.distinct_keys > 10


def test_a_load_reads_no_raw_row_but_its_own(loaded, monkeypatch):  # noqa: F811
    read, asked = load_module.read_raw, []

    def watched(spark, raw, ledger, load_ids=None):
        asked.append(load_ids)
        return read(spark, raw, ledger, load_ids)

    monkeypatch.setattr(load_module, "read_raw", watched)
    assert loaded.load()["rows_after"] == 15
    assert asked == [], "an idle load"
    loaded.ingest(DOCS[0], document("BB", d6={"vw": 10.5001}), DOCS[2])
    loaded.publish()
    result = loaded.load()
    assert (result["verdict"], result["changed_bars"], result["rows_after"]) == ("WARN", 1, 18)
    assert len(asked) == 1 and len(asked[0]) == 1
    plan = read(loaded.spark, f"{loaded.root}/raw", f"{loaded.root}/loaded", asked[0])
    scan = [x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x and "payload" in x]
    assert len(scan) == 1 and f"load_id#" in scan[0].split("PartitionFilters")[1] and asked[0][0] in scan[0]
    monkeypatch.undo()
    check(loaded)


@pytest.mark.parametrize("lost", ["bars", "tickers", "repeats", "ledger"])
def test_a_crash_while_taking_up_changes_nothing(loaded, monkeypatch, lost):  # noqa: F811
    """Whatever was not written is written again by the next load, and nothing counts twice."""
    loaded.ingest(DOCS[0], document("BB", d6={"vw": 10.5001}), DOCS[2])
    loaded.publish()
    append = KeptMeasure._append

    def failing(self, name, rows, *by):
        if name == lost:
            raise PySparkException("executor lost")
        append(self, name, rows, *by)

    def unwritten(*args):
        raise PySparkException("executor lost")

    monkeypatch.setattr(KeptMeasure, "_append", failing)
    if lost == "ledger":
        monkeypatch.setattr(kept_module, "append_ledger", unwritten)
    with pytest.raises(PySparkException):
        loaded.load()
    monkeypatch.undo()
    assert len(kept_of(loaded).missing()) == 1
    assert loaded.load(dry_run=True)["rows_after"] == 18, "a dry run counts anew"
    assert len(kept_of(loaded).missing()) == 1
    result = loaded.load()
    assert (result["files_processed"], result["rows_after"], result["distinct_keys_after"]) == (0, 18, 15)
    assert result["verdict"] == "WARN"
    check(loaded)


def test_loads_from_before_are_taken_up_together(chain):  # noqa: F811
    """A raw table that was loaded without a measure, as by the stream, catches up."""
    chain.ingest(*DOCS[:2], tickers=TICKERS[:2]), chain.publish()
    paths = [f"{chain.root}/{p}" for p in ("stage/raw/prices", "raw", "loaded")]
    load_new_files(chain.spark, *paths, chain.tick())
    chain.ingest(*DOCS), chain.publish()
    load_new_files(chain.spark, *paths, chain.tick())
    assert len(kept_of(chain).missing()) == 2
    result = chain.load()
    assert (result["rows_after"], result["distinct_keys_after"]) == (25, 15)
    assert check(chain).tickers == 3
