"""Scalar expressions against Python's own."""

from __future__ import annotations

import datetime
import random

from pyspark.sql import functions as F

from daybook.functions import bars, display
from helpers import rows_of

VALUES = [0.0, 1.0, 0.125, 0.375, 2.675, 999.995, 1000.0, 1234.5, -0.001, -1234.565, 999999.9, 1e6, 1.5e9, 2.345e12,
          -4.5e9, 1e16, 12.5, 13.5]


def numbers(spark):
    rnd = random.Random(5)
    more = [round(rnd.uniform(-1e7, 1e7), rnd.randrange(6)) for _ in range(200)]
    more += [rnd.randrange(-(10**6), 10**6) / 64 for _ in range(200)]
    return spark.createDataFrame([(v,) for v in VALUES + more], "v double")


def test_money(spark):
    for row in numbers(spark).select("v", display.money(F.col("v")).alias("t"), display.money(F.col("v"), 0).alias("z")).collect():
        assert row.t == f"${row.v:,.2f}"
        assert row.z == f"${row.v:,.0f}"


def test_compact_money(spark):
    for row in numbers(spark).select("v", display.compact_money(F.col("v")).alias("t")).collect():
        for cutoff, suffix in ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K")):
            if abs(row.v) >= cutoff:
                assert row.t == f"${row.v / cutoff:,.2f}{suffix}"
                break
        else:
            assert row.t == f"${row.v:,.0f}"


def test_signed_percent(spark):
    for row in numbers(spark).select("v", display.signed_percent(F.col("v")).alias("t")).collect():
        assert row.t == f"{row.v:+.2f}%"


def test_absent_numbers(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    texts = df.select(display.money(F.col("v")), display.compact_money(F.col("v"))).collect()
    assert {t for r in texts for t in r} == {"—"}
    assert df.limit(1).select(display.signed_percent(F.col("v"))).first()[0] is None


def test_long_date_and_label(spark):
    df = spark.createDataFrame([(datetime.date(2001, 11, 4), "AA", "Aye"), (datetime.date(2024, 2, 29), "BB", None)], "d date, t string, c string")
    got = df.select(display.long_date(F.col("d")), display.label(F.col("t"), F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("04 Nov 2001", "AA - Aye"), ("29 Feb 2024", "BB - —")]


def test_epoch_dates_are_utc_in_any_session_zone(spark):
    ms = [0, 86_399_999, 86_400_000, -1, 1_756_080_000_000]
    df = spark.createDataFrame([(m,) for m in ms], "ms bigint")
    want = [(m, datetime.datetime.fromtimestamp(m / 1000, datetime.timezone.utc).date()) for m in sorted(ms, key=str)]
    for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert rows_of(df.select("ms", bars.epoch_ms_to_date(F.col("ms")))) == rows_of(spark.createDataFrame(want, "a bigint, b date"))


def test_trading_day_follows_new_york(spark):
    instants = ["2024-07-01 03:59:59", "2024-07-01 04:00:00", "2024-01-01 04:59:59", "2024-01-01 05:00:00",
                "2024-11-03 05:59:59", "2024-11-04 04:59:59"]
    df = spark.createDataFrame([(i,) for i in instants], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = [str(r[0]) for r in df.select(bars.trading_day(F.col("t"))).collect()]
    assert got == ["2024-06-30", "2024-07-01", "2023-12-31", "2024-01-01", "2024-11-03", "2024-11-03"]


def test_iso_weekday(spark):
    days = [(datetime.date(2001, 11, 4) + datetime.timedelta(days=i),) for i in range(7)]
    df = spark.createDataFrame(days, "d date")
    assert [r[0] for r in df.select(bars.iso_weekday(F.col("d"))).collect()] == [d.isoweekday() for d, in days]


def test_percent_change_guards(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 0.0), (2.0, None), (None, 1.0)], "v double, p double")
    assert [r[0] for r in df.select(bars.percent_change(F.col("v"), F.col("p"))).collect()] == [100.0, None, None, None]


def test_lowest_needs_every_price(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, -2.0)], "a double, b double")
    assert [r[0] for r in df.select(bars.lowest_if_complete(F.col("a"), F.col("b"))).collect()] == [1.0, None]


def test_price_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("A", datetime.date(2024, 1, 2)), (None, datetime.date(2024, 1, 2)), ("A", None)], "t string, d date")
    assert [r[0] for r in df.select(bars.price_key(F.col("t"), F.col("d"))).collect()] == ["A|2024-01-02", None, None]


def test_names(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2, 7, 5, 59))], "d date, t timestamp_ntz")
    assert tuple(df.select(bars.object_key("raw/prices", F.col("d")), bars.run_id(F.col("t"))).first()) == (
        "raw/prices/date=2024-01-02/prices.jsonl", "2024-01-02T0705")
