"""What the physical plans must look like at any size."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from daybook.operators import duplicates, revisions
from daybook.operators.measures import table_measure
from daybook.plans import marts, reports
from daybook.scratch import settle
from workload import inputs

QUERIES = entry_point.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark, sf):
    return inputs.staged_once(spark, sf)


@pytest.fixture
def no_broadcast(spark):
    """Tables too big to broadcast, as on a cluster."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_all_window_measures_share_one_shuffle(staged):
    text = plan(marts.fct_daily_prices(staged))
    assert text.count("Exchange ") == 1
    assert "Exchange hashpartitioning(ticker" in text
    assert "RangeFrame" not in text


def test_a_single_measure_reads_only_its_columns(staged):
    text = plan(marts.fct_daily_prices(staged).select("ticker", "trade_date", "prior_close"))
    schema = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert "vwap" not in schema and "open" not in schema and "high" not in schema and "close" in schema


def test_ticker_filter_reaches_the_fact_scan(spark, staged):
    fct, dim = settle(marts.fct_daily_prices(staged)), settle(marts.dim_tickers(inputs.reference(spark, "/root/testdata/sf0.001"), staged))
    text = plan(reports.ticker_history(reports.report_rows(fct, dim), "Brand#12"))
    assert text.count("EqualTo(ticker,Brand#12)") == 2


def test_aggregates_combine_before_they_shuffle(staged):
    for df in (revisions.key_revisions(staged), duplicates.duplicate_keys(staged), revisions.newest_loads(staged)):
        before_shuffle = plan(df).split("Exchange")[-1]
        assert "partial_" in before_shuffle


def test_measures_do_not_multiply_rows(staged):
    assert "Expand" not in plan(table_measure(staged))


def test_trade_date_filter_reaches_the_trades(spark, sf):
    text = plan(QUERIES["trailing_window"](spark, sf))
    assert re.search(r"DataFilters: \[.*l_shipdate", text)


def test_kept_loads_do_not_depend_on_broadcasts(spark, sf, no_broadcast):
    """The same rows come out when every join has to shuffle."""
    table = inputs.raw_table(spark, sf)
    from daybook.plans.staging import stg_prices

    staged = stg_prices(table)
    assert "Broadcast" not in plan(staged)
    assert staged.count() == 5774


def test_hot_series_is_spread_over_tasks(spark, staged):
    """Cut series: no window task gets more than a slice and its lead-in."""
    from daybook.operators.series import sliced_measures

    one = staged.withColumn("ticker", F.lit("hot"))
    measured = sliced_measures(one, one.count(), 300)
    assert "hashpartitioning(ticker" in plan(measured) and "slice" in plan(measured)
    assert measured.count() == staged.count()


def test_newest_rows_sort_only_what_is_newest(staged):
    """The aggregate next to the scan of all rows is a hash aggregate."""
    text = plan(reports.latest_rows(staged))
    below = [part for part in text.split("FileScan")[:-1]]
    assert "SortAggregate" not in below[-1].split("Join")[-1]
    assert "HashAggregate" in text
