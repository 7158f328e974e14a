"""From responses to marts and back again: repeats do nothing, revisions do little."""

from __future__ import annotations

import datetime
import json
import os
import shutil
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from daybook.operators import revisions
from daybook.plans.build import build
from daybook.plans.ingest import ingest, upsert_days
from daybook.plans.load import load, read_raw
from daybook.plans import publish as publish_plan_module
from daybook.plans.publish import publish
from daybook.plans.staging import stg_prices
from daybook.schemas import LOAD_LEDGER, PUBLISH_LEDGER
from daybook.scratch import forget_settled, scratch_folder, settle
from daybook.sources.day_files import read_days
from daybook.sources.ledger import read_ledger
from daybook.sources.warehouse import Warehouse
from daybook.streaming.arrivals import load_arrivals
from helpers import rows_of

AS_OF = datetime.date(2024, 3, 8)
DAYS = [datetime.date(2024, 3, d) for d in (4, 5, 6, 7, 8)]
TICKERS = ["AA", "BB", "CC"]


def ms(day):
    noon = datetime.datetime(day.year, day.month, day.day, 5, tzinfo=datetime.timezone.utc)
    return int(noon.timestamp() * 1000)


def document(ticker, days=DAYS, status="OK", **changes):
    bars = []
    for i, day in enumerate(days):
        bar = {"T": ticker, "o": 10 + i, "h": 12.5 + i, "l": 9 + i, "c": 11.25 + i, "v": 1000, "vw": 10.5, "t": ms(day), "n": 7}
        bar.update(changes.get(f"d{day.day}", {}))
        bars.append(bar)
    body = {"ticker": ticker, "status": status, "queryCount": len(bars)}
    return json.dumps(body | ({"results": bars} if bars else {}))


def answers(spark, *docs):
    return spark.createDataFrame([(d,) for d in docs], "value string")


def universe(spark, *tickers):
    return spark.createDataFrame([(t,) for t in tickers], "ticker string")


class Chain:
    """One pipeline in its own directory."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.clock = datetime.datetime(2024, 3, 8, 12, 0)

    def tick(self):
        self.clock += datetime.timedelta(hours=1)
        return self.clock

    def ingest(self, *docs, tickers=TICKERS, **kw):
        return ingest(
            self.spark, answers(self.spark, *docs), universe(self.spark, *tickers),
            f"{self.root}/data", self.tick(), as_of=AS_OF, **kw,
        )

    def publish(self, **kw):
        return publish(self.spark, f"{self.root}/data/days", f"{self.root}/stage",
                       f"{self.root}/published", self.tick(), manifests=f"{self.root}/runs", **kw)

    def load(self, **kw):
        return load(self.spark, f"{self.root}/stage/raw/prices", f"{self.root}/raw",
                    f"{self.root}/loaded", self.tick(), manifests=f"{self.root}/runs", **kw)

    def raw(self):
        return read_raw(self.spark, f"{self.root}/raw", f"{self.root}/loaded")


@pytest.fixture
def chain(spark, tmp_path):
    """Tables of a few rows: compiling code for them would take most of the time."""
    few = {"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "2"}
    before = {key: spark.conf.get(key) for key in few}
    for key, value in few.items():
        spark.conf.set(key, value)
    yield Chain(spark, tmp_path)
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    """A pipeline after its first ingest, publish and load."""
    first = Chain(spark, tmp_path_factory.mktemp("first"))
    first.ingest(*DOCS), first.publish(), first.load()
    return first


@pytest.fixture
def loaded(first_run, chain):
    """A copy of it, to go on from."""
    shutil.copytree(first_run.root, chain.root, dirs_exist_ok=True)
    chain.clock = first_run.clock
    return chain


DOCS = [document(t) for t in TICKERS]


def test_second_run_changes_nothing(chain):
    first = chain.ingest(*DOCS)
    assert (first["bars_received"], first["dates_rewritten"], first["tickers_failed"]) == (15, 5, 0)
    assert first["lag_days_vs_run"] == 0
    assert chain.publish()["files_uploaded"] == 5
    loaded = chain.load()
    assert (loaded["files_processed"], loaded["rows_loaded_this_run"], loaded["verdict"]) == (5, 15, "OK")
    before = rows_of(stg_prices(chain.raw()))

    again = chain.ingest(*DOCS)
    assert (again["trade_dates_touched"], again["dates_rewritten"]) == (5, 0)
    published = chain.publish()
    assert (published["files_uploaded"], published["files_skipped_identical"]) == (0, 5)
    loaded = chain.load()
    assert (loaded["files_processed"], loaded["rows_before"], loaded["rows_after"]) == (0, 15, 15)
    assert rows_of(stg_prices(chain.raw())) == before


def test_unchanged_bar_keeps_its_stamp(chain, spark):
    chain.ingest(*DOCS)
    first = rows_of(read_days(spark, f"{chain.root}/data/days"))
    chain.ingest(*DOCS)
    assert rows_of(read_days(spark, f"{chain.root}/data/days")) == first


def test_numbers_keep_their_json_form(chain, spark):
    chain.ingest(*DOCS)
    line = spark.read.text(f"{chain.root}/data/days/date=2024-03-04").first()[0]
    assert line == (
        '{"ticker": "AA", "trade_date": "2024-03-04", "open": 10, "high": 12.5, "low": 9, '
        '"close": 11.25, "volume": 1000, "vwap": 10.5, "transactions": 7, '
        '"ingested_at_utc": "2024-03-08T13:00:00+00:00"}'
    )


def test_revision_travels_as_one_file(loaded):
    revised = document("BB", d6={"vw": 10.5001})
    assert loaded.ingest(DOCS[0], revised, DOCS[2])["dates_rewritten"] == 1
    assert loaded.publish()["files_uploaded"] == 1
    result = loaded.load()
    assert (result["files_processed"], result["rows_loaded_this_run"]) == (1, 3)
    assert (result["verdict"], result["changed_bars"], result["passengers"]) == ("WARN", 1, 2)
    staged = stg_prices(loaded.raw())
    assert staged.count() == 15
    assert staged.select("price_key").distinct().count() == 15
    assert rows_of(staged.filter("price_key = 'BB|2024-03-06'"), "vwap") == [(10.5001,)]


def test_failed_ticker_keeps_its_history(chain, spark):
    chain.ingest(*DOCS)
    run = chain.ingest(DOCS[0], document("BB", days=[]), document("CC", status="ERROR"))
    assert (run["tickers_succeeded"], run["tickers_failed"], run["dates_rewritten"]) == (1, 2, 0)
    assert read_days(spark, f"{chain.root}/data/days").count() == 15
    outcomes = spark.read.json(f"{chain.root}/data/_runs/tickers").filter("run_id = '2024-03-08T1400'")
    assert rows_of(outcomes, "ticker", "bars", "outcome", "reason") == [
        ("AA", 5, "succeeded", None), ("BB", 0, "failed", "no bars in the window"),
        ("CC", 0, "failed", "response status ERROR")]


def test_undatable_bar_fails_its_ticker_only(chain):
    broken = json.loads(DOCS[1])
    del broken["results"][2]["t"]
    run = chain.ingest(DOCS[0], json.dumps(broken), DOCS[2])
    assert (run["tickers_succeeded"], run["tickers_failed"], run["bars_received"]) == (2, 1, 10)


def test_window_leaves_older_bars_alone(chain):
    run = chain.ingest(*DOCS, days_back=2)
    assert (run["trade_dates_touched"], str(run["oldest_trade_date"])) == (3, "2024-03-06")


def test_landed_responses_are_kept_verbatim(chain, spark):
    chain.ingest(*DOCS)
    kept = spark.read.option("recursiveFileLookup", True).text(f"{chain.root}/data/_raw")
    assert sorted(r.value for r in kept.collect()) == sorted(DOCS)


def test_indented_responses_are_one_document_each(chain):
    indented = [json.dumps(json.loads(d), indent=2) for d in DOCS]
    assert chain.ingest(*indented)["bars_received"] == 15


def test_dry_runs_write_nothing(chain, spark):
    chain.ingest(*DOCS)
    plan = chain.publish(dry_run=True)
    assert (plan["files_uploaded"], plan["bytes_uploaded"]) == (5, 0)
    chain.publish()
    assert chain.load(dry_run=True)["rows_after"] == 0
    assert chain.load()["rows_after"] == 15


def test_a_touched_day_with_the_same_content_is_not_published(loaded, spark):
    """Its new time makes it worth a look; the digest clears it, once."""
    day_folder = f"{loaded.root}/data/days/date=2024-03-05"
    lines = spark.createDataFrame(spark.read.text(day_folder).collect(), "value string").coalesce(1)
    lines.write.mode("overwrite").text(day_folder)
    assert loaded.publish()["files_uploaded"] == 0
    ledger = read_ledger(spark, f"{loaded.root}/published", PUBLISH_LEDGER)
    assert ledger.count() == 6
    assert loaded.publish()["files_uploaded"] == 0
    assert read_ledger(spark, f"{loaded.root}/published", PUBLISH_LEDGER).count() == 6


def test_object_changed_at_the_stage_is_published_again(chain, spark):
    chain.ingest(*DOCS), chain.publish()
    spark.createDataFrame([("{}",)], "value string").write.mode("overwrite").text(
        f"{chain.root}/stage/raw/prices/date=2024-03-05")
    assert chain.publish()["files_uploaded"] == 1


def test_expired_history_loads_again_and_stops(loaded, spark):
    loaded.clock += datetime.timedelta(days=65)
    result = loaded.load(history_days=64)
    assert (result["files_processed"], result["verdict"], result["reloaded_rows"]) == (5, "STOP", 15)
    reference = spark.createDataFrame([(t, t, "Energy") for t in TICKERS], "ticker string, company_name string, sector string")
    house = Warehouse(spark, "expired_", views={"raw_prices": loaded.raw()})
    outcome = {r.node: r.status for r in build(house, reference, F.lit(AS_OF)).collect()}
    assert outcome["unique_stg_prices_price_key"] == "error"
    assert outcome["fct_daily_prices"] == outcome["dim_tickers"] == "skip"
    assert not house.exists("fct_daily_prices")


def test_history_without_expiry_never_repeats(loaded):
    loaded.clock += datetime.timedelta(days=400)
    assert loaded.load()["files_processed"] == 0


def test_malformed_line_loads_nothing(chain, spark):
    chain.ingest(*DOCS), chain.publish()
    spark.createDataFrame([("{not json",)], "value string").write.mode("overwrite").text(
        f"{chain.root}/stage/raw/prices/date=2024-03-05")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|parse"):
        chain.load()
    assert chain.raw().count() == 0
    assert read_ledger(spark, f"{chain.root}/loaded", LOAD_LEDGER).count() == 0


def test_rows_without_a_ledger_entry_are_invisible(loaded, spark):
    orphan = spark.read.parquet(f"{loaded.root}/raw").drop("load_id").withColumn("load_id", F.lit("crashed"))
    orphan.write.mode("append").partitionBy("load_id").parquet(f"{loaded.root}/raw")
    assert loaded.raw().count() == 15


def test_line_numbers_follow_the_file(loaded):
    rows = loaded.raw().select("source_file", "file_row_number", F.variant_get("payload", "$.ticker", "string").alias("ticker"))
    assert rows_of(rows.filter("source_file like '%03-04%'")) == [
        ("date=2024-03-04/prices.jsonl", i + 1, t) for i, t in enumerate(TICKERS)]


def test_stream_front_end_loads_what_is_there_once(chain, spark):
    chain.ingest(*DOCS), chain.publish()
    paths = [f"{chain.root}/{p}" for p in ("stage/raw/prices", "raw", "loaded", "stream")]
    for _ in range(2):
        load_arrivals(spark, *paths).awaitTermination()
        assert chain.raw().count() == 15


def test_green_build(loaded, spark):
    reference = spark.createDataFrame([(t, t, "Energy") for t in TICKERS], "ticker string, company_name string, sector string")
    house = Warehouse(spark, "green_", views={"raw_prices": loaded.raw()})
    outcome = build(house, reference, F.lit(AS_OF)).collect()
    assert len(outcome) == 29
    assert {r.status for r in outcome} == {"pass"}
    assert house.table("fct_daily_prices").count() == 15
    assert house.qualified("fct_daily_prices") == "green_marts.fct_daily_prices"
    for path in {r[0] for r in house.table("fct_daily_prices").select(F.input_file_name()).collect()}:
        rows = [(r.ticker, r.trade_date) for r in spark.read.parquet(path).collect()]
        assert rows == sorted(rows)
    again = {r.status for r in build(house, reference, F.lit(AS_OF)).collect()}
    assert again == {"pass"}
    for _ in range(2):
        house.save("ticker_reference", reference)
    assert len(house._versions("ticker_reference")) == 2, "one version stays behind the current one"
    spark.sql("DROP TABLE green_marts.fct_daily_prices")
    assert Warehouse(spark, "green_").table("fct_daily_prices").count() == 15, "a new catalog finds the files"


def test_a_failed_save_leaves_the_table(spark):
    house = Warehouse(spark, "kept_")
    house.save("ticker_reference", spark.createDataFrame([("A",)], "ticker string"))
    with pytest.raises(Exception):
        house.save("ticker_reference", spark.sql("SELECT raise_error('lost') AS ticker"))
    assert rows_of(house.table("ticker_reference")) == [("A",)]


def test_planted_duplicate_skips_the_marts(loaded, spark):
    """One error, thirteen nodes skipped, and a late feed warning beside it."""
    copy = loaded.raw().limit(1).withColumn("source_file", F.lit("planted"))
    reference = spark.createDataFrame([(t, t, "Energy") for t in TICKERS], "ticker string, company_name string, sector string")
    house = Warehouse(spark, "planted_", views={"raw_prices": loaded.raw().unionByName(copy)})
    late = F.lit(datetime.date(2024, 3, 14))
    status = [r.status for r in build(house, reference, late).collect()]
    assert {s: status.count(s) for s in set(status)} == {"pass": 14, "warn": 1, "error": 1, "skip": 13}


def test_upsert_of_nothing(spark, chain):
    empty = answers(spark).selectExpr("value as ticker", "cast(null as date) as trade_date")
    assert upsert_days(spark, f"{chain.root}/x", empty) == {"dates_touched": 0, "dates_rewritten": 0}


def test_objects_at_any_depth_are_loaded(loaded, spark):
    stage = Path(loaded.root) / "stage/raw/prices"
    line = '{"ticker": "%s", "trade_date": "2024-03-04", "close": 1}\n'
    (stage / "late.jsonl").write_text(line % "LATE")
    (stage / "extra/deep").mkdir(parents=True)
    (stage / "extra/deep/x.jsonl").write_text(line % "DEEP" + "\n \t\n" + line % "DEEP2")
    result = loaded.load()
    assert (result["files_processed"], result["rows_loaded_this_run"], result["staged_files"]) == (2, 3, 7)
    names = loaded.raw().select("source_file", "file_row_number").filter("source_file not like 'date=%'")
    assert rows_of(names) == [("extra/deep/x.jsonl", 1), ("extra/deep/x.jsonl", 2), ("late.jsonl", 1)]
    assert loaded.load()["files_processed"] == 0


def rewritten(folder, old, new):
    """Change a file's content, but neither its length nor its time."""
    path = next(Path(folder).glob("part-*"))
    stat, text = path.stat(), path.read_text()
    assert old in text and len(old) == len(new)
    path.write_text(text.replace(old, new))
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    checksum = path.with_name(f".{path.name}.crc")
    checksum.unlink(missing_ok=True)


def test_content_decides_and_not_size_or_time(loaded):
    rewritten(f"{loaded.root}/stage/raw/prices/date=2024-03-05", '"close": 12.25', '"close": 17.25')
    result = loaded.load()
    assert (result["files_processed"], result["rows_loaded_this_run"], result["verdict"]) == (1, 3, "WARN")
    # The altered copy at the stage is replaced, though nothing changed here.
    assert loaded.publish()["files_uploaded"] == 1
    rewritten(f"{loaded.root}/data/days/date=2024-03-06", '"close": 13.25', '"close": 18.25')
    published = loaded.publish()
    assert (published["files_uploaded"], published["files_skipped_identical"]) == (1, 4)


def test_an_object_that_cannot_be_written_does_not_keep_the_others(chain, spark, monkeypatch):
    chain.ingest(*DOCS)
    lost, copy = "raw/prices/date=2024-03-06/prices.jsonl", publish_plan_module._copy_days

    def failing(spark, files, root, target, keys):
        if lost in keys:
            raise PySparkException("no space left on device")
        copy(spark, files, root, target, keys)

    monkeypatch.setattr(publish_plan_module, "_copy_days", failing)
    record = chain.publish()
    assert (record["files_uploaded"], record["files_failed"]) == (4, 1)
    assert record["failures"] == [{"object_key": lost, "reason": "no space left on device"}]
    assert record["finished_at_utc"] and record["newest_partition_uploaded"].endswith("date=2024-03-08/prices.jsonl")
    assert read_ledger(spark, f"{chain.root}/published", PUBLISH_LEDGER).count() == 4
    parts = [p.read_text() for p in Path(chain.root, "runs/publish").glob("part-*")]
    kept = json.loads("".join(parts))
    assert kept["files_failed"] == 1 and kept["failures"]
    monkeypatch.undo()
    assert chain.publish()["files_uploaded"] == 1


def test_nothing_settled_stays_behind(chain, spark):
    reference = spark.createDataFrame([(t, t, "Energy") for t in TICKERS], "ticker string, company_name string, sector string")
    forget_settled(spark)
    folder = Path(scratch_folder(spark))
    chain.ingest(*DOCS), chain.publish(), chain.load()
    build(Warehouse(spark, "clean_", views={"raw_prices": chain.raw()}), reference, F.lit(AS_OF))
    with pytest.raises(ValueError, match="universe is empty"):
        chain.ingest(*DOCS, tickers=[])
    spark.createDataFrame([("{not json",)], "value string").write.mode("overwrite").text(
        f"{chain.root}/stage/raw/prices/date=2024-03-05")
    with pytest.raises(Exception):
        chain.load()
    assert not folder.exists() or not list(folder.iterdir())


def test_a_second_run_in_the_same_minute_has_its_own_folder(chain, spark):
    chain.ingest(*DOCS)
    chain.clock -= datetime.timedelta(hours=1)
    assert chain.ingest(DOCS[0], tickers=["AA"])["bars_received"] == 5
    assert len(list(Path(chain.root, "data/_raw").glob("run=*"))) == 2


def test_old_revisions_write_narrow_tables_only(loaded, spark, monkeypatch):
    loaded.ingest(DOCS[0], document("BB", d6={"vw": 10.5001}), DOCS[2])
    loaded.publish(), loaded.load()
    written = []

    def watched(df, label="table"):
        written.append((label, set(df.columns)))
        return settle(df, label)

    monkeypatch.setattr(revisions, "settle", watched)
    assert stg_prices(loaded.raw()).count() == 15
    assert written and not [label for label, columns in written if columns & {"close", "payload", "volume"}]
