"""Data-quality checks: each returns the rows that break a rule."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.bars import contradictions, iso_weekday
from daybook.operators.measures import side_by_side

# Fixed value: how many days past the newest bar are looked at.
HORIZON_DAYS = 60


def unique(df: DataFrame, column: str) -> DataFrame:
    """One row per value that occurs more than once; nulls are not compared."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """One row per value outside the list, with how often it occurs."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count("*").alias("occurrences"))
    )


def relationships(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child rows whose value the parent does not have."""
    known = parent.select(column).distinct()
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def any_contradiction() -> Column:
    """True for a bar that breaks a rule; not true where a rule cannot be told."""
    return reduce(lambda a, b: a | b, contradictions().values())


def inconsistent_bars(stg: DataFrame) -> DataFrame:
    """Impossible bars with the list of rules each of them breaks."""
    fired = [F.when(rule, F.lit(name)) for name, rule in contradictions().items()]
    return stg.filter(any_contradiction()).select(
        "price_key",
        "ticker",
        "trade_date",
        "open",
        "high",
        "low",
        "close",
        "volume",
        F.array_compact(F.array(*fired)).alias("violations"),
    )


def fact_mismatch(stg: DataFrame, fct: DataFrame) -> DataFrame:
    """One row of counts if the fact table lost or gained rows or keys."""

    def counted(df: DataFrame, side: str) -> DataFrame:
        return df.agg(
            F.count("*").alias(f"{side}_rows"),
            F.countDistinct("price_key").alias(f"{side}_keys"),
        )

    counts = side_by_side(counted(stg, "staging"), counted(fct, "fact"))
    return counts.select("staging_rows", "fact_rows", "staging_keys", "fact_keys").filter(
        (F.col("staging_rows") != F.col("fact_rows"))
        | (F.col("staging_keys") != F.col("fact_keys"))
    )


def weekdays_behind(stg: DataFrame, as_of: Column, horizon: int = HORIZON_DAYS) -> DataFrame:
    """One row per weekday after the newest bar, up to ``as_of`` in the market's zone.

    The number of rows is the measure. An empty table yields no rows.
    """
    newest = stg.agg(F.max("trade_date").alias("newest_trade_date")).filter(
        F.col("newest_trade_date").isNotNull()
    )
    days = F.sequence(
        F.date_add("newest_trade_date", 1), F.date_add("newest_trade_date", horizon)
    )
    return (
        newest.select("newest_trade_date", as_of.alias("as_of"), F.explode(days).alias("missed_day"))
        .filter(F.col("missed_day") <= F.col("as_of"))
        .filter(iso_weekday(F.col("missed_day")).between(1, 5))
    )


def empty_table(df: DataFrame) -> DataFrame:
    """One row if the table holds none, which every other rule would pass."""
    return df.agg(F.count("*").alias("row_count")).filter(F.col("row_count") == 0)


def source_freshness(
    raw: DataFrame, as_of: Column, warn_days: int = 6, error_days: int = 10
) -> DataFrame:
    """Age of the newest load and what to make of it."""
    newest = raw.agg(F.max("loaded_at").alias("newest_load"))
    seconds = F.timestamp_diff("SECOND", F.col("newest_load"), as_of)
    day = 24 * 60 * 60
    return newest.select("newest_load", seconds.alias("age_seconds")).withColumn(
        "status",
        F.when(F.col("newest_load").isNull() | (F.col("age_seconds") > error_days * day), "error")
        .when(F.col("age_seconds") > warn_days * day, "warn")
        .otherwise("pass"),
    )


@dataclass(frozen=True, eq=False)
class Check:
    """A named rule on a table and the violation counts at which it warns or errs.

    A rule is either a row condition, counted together with its table's other
    conditions in one pass, or a function from tables to violating rows.
    """

    name: str
    table: str
    severity: str
    condition: Column | None = None
    violations: Callable[[Callable[[str], DataFrame]], DataFrame] | None = None
    needs: tuple[str, ...] = ()
    warn_at: int | None = None
    error_at: int | None = None

    @property
    def tables(self) -> tuple[str, ...]:
        return (self.table, *self.needs)

    def status(self, count: Column) -> Column:
        warn_at = 1 if self.warn_at is None else self.warn_at
        error_at = 1 if self.error_at is None else self.error_at
        warned = F.when(count >= warn_at, "warn").otherwise("pass")
        return F.when(count >= error_at, "error").otherwise(warned) if self.severity == "error" else warned


def run_checks(checks: Iterable[Check], table: Callable[[str], DataFrame]) -> DataFrame:
    """(test, severity, violations, status) of every check."""
    checks = list(checks)
    counted = []
    for name in dict.fromkeys(c.table for c in checks if c.condition is not None):
        together = [c for c in checks if c.table == name and c.condition is not None]
        counted.append(_count_conditions(table(name), together))
    for check in checks:
        if check.violations is not None:
            broken = check.violations(table).agg(F.count("*").alias("violations"))
            counted.append(broken.select(F.lit(check.name).alias("test"), "violations"))
    counts = reduce(DataFrame.unionByName, counted)
    status, severity = F.lit(None).cast("string"), F.lit(None).cast("string")
    for check in checks:
        here = F.col("test") == check.name
        status = F.when(here, check.status(F.col("violations"))).otherwise(status)
        severity = F.when(here, F.lit(check.severity)).otherwise(severity)
    return counts.select("test", severity.alias("severity"), "violations", status.alias("status"))


def _count_conditions(df: DataFrame, checks: list[Check]) -> DataFrame:
    totals = df.agg(*[F.count_if(c.condition).alias(f"n{i}") for i, c in enumerate(checks)])
    entries = [
        F.struct(F.lit(c.name).alias("test"), F.col(f"n{i}").alias("violations"))
        for i, c in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*entries)))
