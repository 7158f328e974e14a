"""Typing, keys, fingerprints, and which loads of a bar are kept."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from daybook.functions.bars import bar_fingerprint, same_bar
from daybook.operators import duplicates, revisions
from daybook.plans.load import loads_of
from daybook.plans.staging import keyed_bars, stg_prices, typed_bars
from daybook.schemas import BAR_NUMBERS, STG_PRICES
from helpers import load, raw, rows_of
from workload import inputs


def bar(spark, *rows):
    """Raw rows from (ticker, file, close, load number[, line, vwap])."""
    lines = []
    for i, (ticker, file, close, number, *rest) in enumerate(rows):
        line, vwap = (rest + [i + 1, 5])[:2] if len(rest) < 2 else rest
        number_text = "null" if close is None else close
        vwap_text = "null" if vwap is None else vwap
        text = (f'{{"ticker": "{ticker}", "trade_date": "2024-01-02", "open": 1, "high": 1, "low": 1, '
                f'"close": {number_text}, "volume": 1, "vwap": {vwap_text}, "transactions": 1, '
                f'"ingested_at_utc": "2024-01-03T11:00:00+00:00"}}')
        lines.append((text, file, line, load(number)))
    return raw(spark, lines)


CASES = {
    "single load": ([("A", "x", 1, 1)], [("A", "x", 1)]),
    "identical reload keeps both": ([("A", "x", 1, 1), ("A", "x", 1, 2)], [("A", "x", 1), ("A", "x", 2)]),
    "revision with a passenger": (
        [("A", "x", 1, 1), ("B", "x", 2, 1), ("A", "x", 1.5, 2), ("B", "x", 2, 2)],
        [("A", "x", 2), ("B", "x", 2)],
    ),
    "null moves between columns": (
        [("A", "x", 1, 1, 1, None), ("A", "x", None, 2, 1, 1)],
        [("A", "x", 2)],
    ),
    "two files, the unrevised one newer": (
        [("A", "x", 1, 1), ("B", "x", 2, 1), ("B", "x", 3, 2), ("A", "y", 1, 3)],
        [("A", "y", 3), ("B", "x", 2)],
    ),
    "two files, the revised one newer": (
        [("A", "x", 1, 3), ("B", "x", 2, 1), ("B", "x", 3, 2), ("A", "y", 1, 1)],
        [("A", "x", 3), ("A", "y", 1), ("B", "x", 2)],
    ),
    "an identical reload after a revision is masked": (
        [("A", "x", 1, 1), ("A", "x", 2, 2), ("A", "x", 2, 3)],
        [("A", "x", 3)],
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_kept_loads(spark, case):
    given, kept = CASES[case]
    staged = stg_prices(bar(spark, *given))
    want = [(t, f, load(n)) for t, f, n in kept]
    assert rows_of(staged, "ticker", "source_file", "loaded_at") == sorted(want, key=str)
    assert tuple(staged.columns) == STG_PRICES


def test_equal_load_times_keep_the_later_line(spark):
    staged = stg_prices(bar(spark, ("A", "x", 1, 1, 1, 5), ("A", "x", 2, 1, 2, 5)))
    assert rows_of(staged, "file_row_number", "close") == [(2, 2.0)]


def keep_by_hand(rows):
    """The rule spelled out over tuples (key, file, value, load, line)."""
    values = {}
    for key, _, value, *_ in rows:
        values.setdefault(key, set()).add(value)
    revised = {r[1] for r in rows if len(values[r[0]]) > 1}
    newest = {}
    for r in rows:
        rank = (r[3], r[1], r[4])
        if r[0] not in newest or rank > newest[r[0]][0]:
            newest[r[0]] = (rank, r)
    return sorted(r for r in rows if r[1] not in revised or newest[r[0]][1] == r)


@pytest.mark.parametrize("seed", range(4))
def test_kept_loads_of_random_tables(spark, seed):
    """Few keys and files, so that keys span files and one key holds most rows."""
    rnd = random.Random(seed)
    rows = [
        ("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(30)}", f"f{rnd.randrange(12)}",
         int(rnd.random() < 0.08), rnd.randrange(5), i)
        for i in range(200)
    ]
    keyed = spark.createDataFrame(
        [(k, f, v, load(n), i) for k, f, v, n, i in rows],
        "price_key string, source_file string, bar_hash bigint, loaded_at timestamp_ntz, file_row_number bigint",
    )
    kept = revisions.keep_loads(keyed).select("price_key", "source_file", "bar_hash", "loaded_at", "file_row_number")
    want = [(k, f, v, load(n), i) for k, f, v, n, i in keep_by_hand(rows)]
    assert sorted(map(tuple, kept.collect())) == sorted(want)


def test_null_keys_form_one_group(spark):
    keyed = spark.createDataFrame(
        [(None, "x", 1, load(1), 1), (None, "x", 2, load(2), 2), ("A", "x", 1, load(1), 3)],
        "price_key string, source_file string, bar_hash bigint, loaded_at timestamp_ntz, file_row_number bigint",
    )
    assert rows_of(revisions.keep_loads(keyed), "price_key", "file_row_number") == [(None, 2), ("A", 3)]


def test_malformed_values_raise(spark):
    for text in ('{"ticker": "A", "close": "ten"}', '{"trade_date": "2024-13-01"}', '{"transactions": 1e400}'):
        with pytest.raises(Exception):
            typed_bars(raw(spark, [(text, "x", 1, load(1))])).collect()


def test_integers_and_fractions_become_doubles(spark):
    lines = [(f'{{"close": {v}, "transactions": 3}}', "x", 1, load(1)) for v in ("229", "229.15", "1e-7", "null")]
    typed = typed_bars(raw(spark, lines))
    assert dict(typed.dtypes)["close"] == "double"
    assert sorted(r.close for r in typed.collect() if r.close is not None) == [1e-7, 229.0, 229.15]


def test_offsets_become_utc(spark):
    texts = ["2024-11-03T01:30:00-04:00", "2024-11-03T01:30:00-05:00", "2024-11-03T06:30:00+00:00"]
    lines = [(f'{{"ingested_at_utc": "{t}"}}', "x", i, load(1)) for i, t in enumerate(texts)]
    got = rows_of(typed_bars(raw(spark, lines)), "file_row_number", "ingested_at_utc")
    assert [str(t) for _, t in got] == ["2024-11-03 05:30:00", "2024-11-03 06:30:00", "2024-11-03 06:30:00"]


def test_fingerprint_sees_where_a_null_is(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0)], "a double, b double")
    assert df.select(bar_fingerprint([F.col("a"), F.col("b")])).distinct().count() == 2


def test_same_bar_treats_null_as_equal(spark):
    df = spark.createDataFrame([((1.0, None), (1.0, None)), ((1.0, None), (1.0, 2.0))], "l struct<a:double,b:double>, r struct<a:double,b:double>")
    assert [r[0] for r in df.select(same_bar(F.col("l"), F.col("r"), ["a", "b"])).collect()] == [True, False]


@pytest.mark.parametrize("scale,want", [
    ("sf0.001", (5893, 5774, (42, 39, 76, 119, 76, 119, 54))),
    ("sf0.01", (39755, 38488, (7, 82, 116, 1267, 116, 1267, 465))),
])
def test_known_counts_of_three_loads(spark, scale, want):
    table = inputs.raw_table(spark, f"/root/testdata/{scale}")
    summary = duplicates.classify_duplicates(loads_of(table)).first()
    assert (table.count(), stg_prices(table).count(), tuple(summary)[:7]) == want


def test_verdicts(spark):
    def verdict(*rows):
        return duplicates.verdict(duplicates.classify_duplicates(loads_of(bar(spark, *rows)))).first()

    assert verdict(("A", "x", 1, 1)).verdict == "OK"
    warned = verdict(("A", "x", 1, 1), ("B", "x", 1, 1), ("A", "x", 2, 2), ("B", "x", 1, 2))
    assert (warned.verdict, warned.changed_bars, warned.passengers) == ("WARN", 1, 1)
    stopped = verdict(("A", "x", 1, 1), ("A", "x", 1, 2), ("B", "y", 1, 1), ("B", "y", 2, 2))
    assert (stopped.verdict, stopped.reloaded_rows) == ("STOP", 1)


def test_keyed_bars_lists_every_number(spark):
    one = typed_bars(bar(spark, ("A", "x", 1, 1)))
    base = keyed_bars(one).first().bar_hash
    for name in BAR_NUMBERS:
        assert keyed_bars(one.withColumn(name, F.col(name) + 1)).first().bar_hash != base
    assert keyed_bars(one.withColumn("loaded_at", F.lit(load(9)))).first().bar_hash == base
