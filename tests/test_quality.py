"""Each check on clean rows and on rows with the fault it is for."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from daybook.functions.bars import utc_literal
from daybook.operators import quality
from daybook.operators.quality import Check, run_checks
from daybook.plans.suite import build_checks
from daybook.schemas import SECTORS
from helpers import day, rows_of, staged, staged_row


@pytest.fixture
def clean(spark):
    return staged(spark, [staged_row("A", day(0)), staged_row("A", day(1)), staged_row("B", day(0))])


def with_row(spark, clean, **over):
    return clean.unionByName(staged(spark, [staged_row("Z", day(0), **over)]))


def test_unique(spark, clean):
    assert quality.unique(clean, "price_key").count() == 0
    thrice = clean.unionByName(clean.limit(1)).unionByName(clean.limit(1))
    assert [r.copies for r in quality.unique(thrice, "price_key").collect()] == [3]
    nulls = staged(spark, [staged_row(None, day(0)), staged_row(None, day(0))])
    assert quality.unique(nulls, "price_key").count() == 0


def test_not_null(spark, clean):
    assert quality.not_null(clean, "close").count() == 0
    assert quality.not_null(with_row(spark, clean, close=None), "close").count() == 1


def test_accepted_values(spark):
    rows = spark.createDataFrame([("Health Care",), ("Healthcare",), ("Healthcare",), (None,)], "sector string")
    assert rows_of(quality.accepted_values(rows, "sector", SECTORS)) == [("Healthcare", 2)]
    assert quality.accepted_values(rows.limit(1), "sector", SECTORS).count() == 0


def test_relationships(spark, clean):
    parent = spark.createDataFrame([("A",), ("B",)], "ticker string")
    assert quality.relationships(clean, parent, "ticker").count() == 0
    orphan = with_row(spark, clean).unionByName(staged(spark, [staged_row(None, day(0))]))
    assert rows_of(quality.relationships(orphan, parent, "ticker"), "ticker") == [("Z",)]


FAULTS = [
    (dict(high=8.0), ["high is below low", "high is below open or close"]),
    (dict(high=9.5), ["high is below open or close"]),
    (dict(low=10.5), ["low is above open or close"]),
    (dict(low=0.0), ["a price is zero or negative"]),
    (dict(low=-1.0, open=None), None),
    (dict(volume=-1.0), ["volume is negative"]),
    (dict(high=None), None),
    (dict(volume=None), None),
]


@pytest.mark.parametrize("fault,fired", FAULTS)
def test_bar_consistency(spark, clean, fault, fired):
    assert quality.inconsistent_bars(clean).count() == 0
    broken = quality.inconsistent_bars(with_row(spark, clean, **fault)).collect()
    assert [r.violations for r in broken] == ([fired] if fired else [])


def test_fact_matches(spark, clean):
    assert quality.fact_mismatch(clean, clean).count() == 0
    row = quality.fact_mismatch(clean, clean.limit(2)).first()
    assert (row.staging_rows, row.fact_rows, row.staging_keys, row.fact_keys) == (3, 2, 3, 2)


def test_empty_table(spark, clean):
    assert quality.empty_table(clean).count() == 0
    assert quality.empty_table(clean.limit(0)).count() == 1


SUNDAY = datetime.date(2001, 11, 4)


@pytest.mark.parametrize("as_of,behind,status", [
    ((2001, 11, 4), 0, "pass"), ((2001, 11, 5), 1, "pass"), ((2001, 11, 6), 2, "pass"),
    ((2001, 11, 7), 3, "warn"), ((2001, 11, 9), 5, "error"), ((2001, 11, 11), 5, "error"),
])
def test_weekdays_behind(spark, as_of, behind, status):
    bars = staged(spark, [staged_row("A", SUNDAY)])
    today = F.lit(datetime.date(*as_of))
    assert quality.weekdays_behind(bars, today).count() == behind
    check = [c for c in build_checks(today) if c.name == "prices_are_current"]
    assert run_checks(check, {"stg_prices": bars}.__getitem__).first().status == status


def test_weekdays_look_sixty_days_ahead_and_pass_when_empty(spark):
    bars = staged(spark, [staged_row("A", SUNDAY)])
    later = F.lit(datetime.date(2003, 1, 1))
    assert quality.weekdays_behind(bars, later).count() == 44
    assert quality.weekdays_behind(bars.limit(0), later).count() == 0


@pytest.mark.parametrize("days,status", [(5, "pass"), (7, "warn"), (11, "error")])
def test_source_freshness(spark, clean, days, status):
    as_of = utc_literal(datetime.datetime(2024, 1, 1) + datetime.timedelta(days=days))
    assert quality.source_freshness(clean, as_of).first().status == status
    assert quality.source_freshness(clean.limit(0), as_of).first().status == "error"


def test_suite_has_25_checks(spark):
    checks = build_checks(F.current_date())
    assert len(checks) == len({c.name for c in checks}) == 25
    assert sum(c.severity == "warn" for c in checks) == 5


def test_severity_decides_the_status(spark, clean):
    broken = with_row(spark, clean, close=None)
    rule = F.col("close").isNull()
    checks = [Check("soft", "t", "warn", rule), Check("hard", "t", "error", rule),
              Check("fine", "t", "error", F.col("ticker").isNull())]
    got = rows_of(run_checks(checks, {"t": broken}.__getitem__), "test", "violations", "status")
    assert got == [("fine", 0, "pass"), ("hard", 1, "error"), ("soft", 1, "warn")]


def test_only_one_check_notices_an_empty_staging_table(spark, clean):
    empty = clean.limit(0)
    checks = [c for c in build_checks(F.lit(SUNDAY)) if c.tables == ("stg_prices",)]
    failed = run_checks(checks, {"stg_prices": empty}.__getitem__).filter("status <> 'pass'")
    assert rows_of(failed, "test", "status") == [("warehouse_not_empty", "error")]
