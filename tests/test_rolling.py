"""The carried fact table against one that is made whole."""

from __future__ import annotations

import datetime
import random
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from test_kept import staged as stage_object
from test_pipeline import DOCS, TICKERS, chain, document, first_run, loaded  # noqa: F401

from daybook.plans import rolling
from daybook.plans.marts import fct_daily_prices
from daybook.plans.rolling import NO_MONTH, RawTable, RollingFact, month_of, reaches, roll_loads
from daybook.plans.staging import stg_prices
from daybook.schemas import FCT_DAILY_PRICES
from helpers import load, rows_of, staged, staged_row

START = datetime.date(2020, 1, 1)


def on(n):
    return None if n is None else START + datetime.timedelta(days=n)


def month(n):
    return NO_MONTH if n is None else on(n).year * 12 + on(n).month - 1


class Bars:
    """A staging table that changes, as {(ticker, day): rows}, and its fact table."""

    def __init__(self, spark, root, seed, **kw):
        self.spark, self.rnd, self.line = spark, random.Random(seed), 0
        self.rows, self.fact = {}, RollingFact(spark, str(root), **kw)

    def put(self, ticker, n, copies=1):
        self.rows[ticker, n] = []
        for _ in range(copies):
            self.line += 1
            close = None if self.rnd.random() < 0.003 else self.rnd.randrange(64, 6400) / 64
            over = {"file_row_number": self.line, "loaded_at": load(self.rnd.randrange(3))}
            self.rows[ticker, n].append(staged_row(ticker, on(n), close, **over))

    def table(self):
        return staged(self.spark, [r for rows in self.rows.values() for r in rows])

    def keys(self, keys):
        return self.spark.createDataFrame([(t, on(n)) for t, n in keys], "ticker string, trade_date date")

    def check(self):
        got = self.fact.read()
        assert tuple(got.columns) == FCT_DAILY_PRICES
        assert rows_of(got) == rows_of(fct_daily_prices(self.table()))


@pytest.fixture
def few(spark):
    keys = {"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "2"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def history(bars):
    """Three years of A, less of others, with holes, copies of days, no ticker and no day."""
    for n in range(1100):
        if bars.rnd.random() < 0.9:
            bars.put("A", n, 2 if bars.rnd.random() < 0.02 else 1)
        if n >= 700:
            bars.put("B", n)
        if n % 9 == 0:
            bars.put("C", n)
        if n < 400:
            bars.put(None, n)
    bars.put("A", None)
    bars.put("C", None, 3)


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 252])
def test_random_changes_equal_a_whole_rebuild(few, tmp_path, rows_per_slice):
    bars = Bars(few, tmp_path, 5, rows_per_slice=rows_per_slice)
    history(bars)
    bars.fact.rebuild(bars.table())
    bars.check()
    for step in range(5):
        keys = set()
        for _ in range(bars.rnd.choice([1, 4])):
            ticker = bars.rnd.choice(["A", "A", "B", "C", None, f"N{step}"])
            n = None if bars.rnd.random() < 0.1 else bars.rnd.randrange(1200)
            keys.add((ticker, n))
            if bars.rnd.random() < 0.4:
                bars.rows.pop((ticker, n), None)
            else:
                bars.put(ticker, n, bars.rnd.choice([1, 1, 2]))
        bars.fact.refresh(bars.keys(keys), bars.table())
        bars.check()


def test_months_that_come_and_go(few, tmp_path):
    """From no table to one, a month that empties, a table that empties, and rows again."""
    bars = Bars(few, tmp_path, 2)
    assert rows_of(bars.fact.read()) == []
    for n in (0, 40, 41):
        bars.put("A", n)
    bars.fact.refresh(bars.keys(bars.rows), bars.table())
    bars.check()
    for gone in ([("A", 40), ("A", 41)], [("A", 0)]):
        for key in gone:
            del bars.rows[key]
        bars.fact.refresh(bars.keys(gone), bars.table())
        bars.check()
    bars.put("A", 41)
    assert bars.fact.refresh(bars.keys([("A", 41)]), bars.table()) == {"read": [], "written": [month(41)]}
    bars.check()
    nothing = bars.fact.refresh(bars.keys([("A", 7)]), bars.table().limit(0))
    assert nothing == {"read": [month(41)], "written": [month(0), month(41)]}, "a key that was never there"
    bars.check()


def test_only_near_months_are_read_and_written(few, tmp_path):
    """Months out of reach may be unreadable, and lie as they did after the change."""
    bars = Bars(few, tmp_path, 4)
    for n in range(1100):
        bars.put("A", n), bars.put("B", n)
    bars.fact.rebuild(bars.table())
    for n, first, last in ((1100, 1100 - 251 - 31, 1100), (500, 500 - 251 - 31, 500 + 251 + 31)):
        bars.put("A", n)
        places = bars.fact._current()
        spared = {m for m in places if m < month(first) or m > month(last)}
        assert len(spared) > 10
        texts = {}
        for m in spared:
            for part in Path(tmp_path, f"rows/take={places[m]}/month={m}").glob("*.parquet"):
                texts[part] = part.read_bytes()
                part.write_bytes(b"unreadable")
                Path(part.parent, f".{part.name}.crc").unlink(missing_ok=True)
        done = bars.fact.refresh(bars.keys([("A", n)]), bars.table())
        assert set(done["read"]).isdisjoint(spared) and set(done["written"]).isdisjoint(spared)
        assert min(done["written"]) == month(n) and len(done["written"]) <= 10
        for part, text in texts.items():
            part.write_bytes(text)
        assert {m: bars.fact._current()[m] for m in spared} == {m: places[m] for m in spared}
        bars.check()


def test_reach_in_months(spark):
    """A month with all 251 rows is the last that is read, and the last that is recomputed."""
    counts = spark.createDataFrame(
        [("A", m, r) for m, r in ((1, 9), (2, 251), (3, 250), (5, 1), (6, 250), (7, 1), (8, 5), (NO_MONTH, 2))] + [(None, 4, 7)],
        "ticker string, month int, rows long",
    )
    keys = spark.createDataFrame([("A", 4), ("A", 5), (None, 9), ("B", NO_MONTH)], "ticker string, month int")
    assert rows_of(reaches(keys, counts)) == [
        (None, 4, 9, 9), ("A", 2, 4, 7), ("B", NO_MONTH, NO_MONTH, NO_MONTH)]


def test_months_sort_like_days(spark):
    days = ["0001-01-01", "1969-12-31", "1970-01-01", "2020-01-31", "2020-02-01", "9999-12-31", None]
    rows = spark.createDataFrame([(d,) for d in days], "d string")
    got = [r.m for r in rows.select(month_of(rows.d.cast("date")).alias("m")).collect()]
    assert got == sorted(set(got)) and len(got) == len(days)


def test_a_change_that_dies_changes_nothing(few, tmp_path, monkeypatch):
    bars = Bars(few, tmp_path, 8)
    for n in range(100):
        bars.put("A", n)
    bars.fact.rebuild(bars.table())
    before = rows_of(bars.fact.read())
    reader = bars.fact.read()

    def unwritten(*args):
        raise PySparkException("executor lost")

    bars.put("A", 50)
    monkeypatch.setattr(rolling, "append_ledger", unwritten)
    with pytest.raises(PySparkException):
        bars.fact.refresh(bars.keys([("A", 50)]), bars.table())
    monkeypatch.undo()
    assert rows_of(bars.fact.read()) == before
    bars.fact.refresh(bars.keys([("A", 50)]), bars.table())
    bars.check()
    assert rows_of(reader) == before, "a reader that started before still has its months"
    takes = {p.name for p in Path(tmp_path, "rows").glob("take=*")}
    assert len(takes) == 2, "what the dead change wrote is swept"
    bars.fact.rebuild(bars.table())
    bars.fact.rebuild(bars.table())
    assert len(list(Path(tmp_path, "rows").glob("take=*"))) == 2
    bars.check()


def whole(chain):  # noqa: F811
    return rows_of(fct_daily_prices(stg_prices(chain.raw())))


def rolled(chain):  # noqa: F811
    table = RawTable(chain.spark, f"{chain.root}/raw", f"{chain.root}/loaded")
    return table, RollingFact(chain.spark, f"{chain.root}/rolling")


def test_loads_roll_into_the_fact_table(loaded, monkeypatch):  # noqa: F811
    table, fact = rolled(loaded)
    march = 2024 * 12 + 2
    assert roll_loads(table, fact) == {"read": [], "written": [march]}
    assert rows_of(fact.read()) == whole(loaded)
    assert roll_loads(table, fact) == {"read": [], "written": []}, "nothing new"
    loaded.ingest(DOCS[0], document("BB", d6={"vw": 10.5001}), DOCS[2])
    loaded.publish(), loaded.load()
    made = []
    monkeypatch.setattr(RollingFact, "rebuild", lambda *a: made.append(a))
    assert roll_loads(table, fact) == {"read": [march], "written": [march]}
    assert not made, "a revision does not make the table whole"
    assert rows_of(fact.read()) == whole(loaded)


def test_random_loads_roll_like_a_whole_build(chain):  # noqa: F811
    """Objects of one day or several; files share keys, repeat and are revised."""
    rng = random.Random(11)
    table, fact = rolled(chain)
    for step in range(6):
        for _ in range(rng.randrange(1, 3)):
            day = rng.randrange(1, 7)
            days = [day] if rng.random() < 0.5 else [day, day + 1, day + 9]
            rows = [(t, d, rng.choice([1.5, 2.5])) for t in rng.sample("ABCDE", rng.randrange(1, 5)) for d in days]
            rows += rng.sample(rows, rng.randrange(0, 2))
            if step == 4:
                rows += [(None, day, 1.0), ("N", None, 1.0)]
            stage_object(chain, f"date=2024-03-{day:02d}" if len(days) == 1 else f"mixed/{day}", rows)
        chain.load()
        roll_loads(table, fact)
        assert rows_of(fact.read()) == whole(chain), f"step {step}"


def test_changed_bars_read_the_loads_of_their_files_only(loaded, monkeypatch):  # noqa: F811
    table, fact = rolled(loaded)
    roll_loads(table, fact)
    loaded.ingest(DOCS[0], document("BB", d6={"vw": 10.5001}), DOCS[2])
    loaded.publish(), loaded.load()
    files, judged = [], RawTable.rows_of

    def watched(self, names):
        files.append([r.source_file for r in names.collect()])
        return judged(self, names)

    monkeypatch.setattr(RawTable, "rows_of", watched)
    keys, rows = table.changed_bars(fact.missing(table.ledger))
    assert rows_of(keys) == [(t, datetime.date(2024, 3, 6)) for t in TICKERS] == rows_of(rows, "ticker", "trade_date")
    assert files and all(len(names) == 1 and "2024-03-06" in names[0] for names in files)
