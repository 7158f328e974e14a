"""The gated build: a table that fails an error-level check stops what reads it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.bars import trading_day, utc_ntz
from daybook.operators.quality import run_checks
from daybook.plans.marts import dim_tickers, fct_daily_prices
from daybook.plans.staging import stg_prices
from daybook.plans.suite import build_checks
from daybook.scratch import settled_inside
from daybook.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Step:
    """A table and how to make it from its inputs; a source is only checked."""

    name: str
    inputs: tuple[str, ...] = ()
    make: Callable[..., DataFrame] | None = None


def steps(reference: DataFrame) -> list[Step]:
    """Seed, staging, marts, in the order they can be made."""
    return [
        Step("raw_prices"),
        Step("ticker_reference", (), lambda: reference),
        Step("stg_prices", ("raw_prices",), stg_prices),
        Step("dim_tickers", ("ticker_reference", "stg_prices"), dim_tickers),
        Step("fct_daily_prices", ("stg_prices",), fct_daily_prices),
    ]


def build(warehouse: Warehouse, reference: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Make and check every table; returns (node, kind, status, violations).

    Warnings let the build go on. After an error, everything downstream of the
    table is skipped, its checks included, so no mart is made from bad rows.
    """
    with settled_inside(warehouse.spark):
        as_of = trading_day(utc_ntz(F.current_timestamp())) if as_of is None else as_of
        checks = build_checks(as_of)
        blocked: set[str] = set()
        outcome: list[tuple[str, str, str, int | None]] = []
        for step in steps(reference):
            if blocked & set(step.inputs):
                blocked.add(step.name)
                outcome.append((step.name, "model", "skip", None))
            elif step.make is not None:
                made = step.make(*[warehouse.table(name) for name in step.inputs])
                warehouse.save(step.name, made)
                outcome.append((step.name, "model", "pass", None))

            due = [c for c in checks if c.table == step.name]
            skipped = [c for c in due if blocked & set(c.tables)]
            outcome += [(c.name, "test", "skip", None) for c in skipped]
            ready = [c for c in due if c not in skipped]
            if ready:
                # One row per check, so the result is as small as the suite.
                for row in run_checks(ready, warehouse.table).collect():
                    outcome.append((row.test, "test", row.status, row.violations))
                    if row.status == "error":
                        blocked.add(step.name)
        return warehouse.spark.createDataFrame(
            outcome, "node string, kind string, status string, violations bigint"
        )
