"""Data-quality checks over bars with faults planted in them."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import quality
from daybook.operators.quality import run_checks
from daybook.plans import marts
from daybook.plans.suite import build_checks
from daybook.schemas import SECTORS
from daybook.scratch import settle
from workload import inputs
from workload.oracle import BARS, CONTRADICTION, FAULTY, LOADS, REFERENCE, dim, fact, text
from workload.registry import query


def faulty(spark, sf):
    return inputs.faulty(inputs.staged_rows(inputs.daily_bars(spark, sf)))


@query(
    "quality_unique",
    f"WITH {FAULTY} SELECT price_key, count(*) AS copies FROM faulty GROUP BY price_key HAVING count(*) > 1",
)
def quality_unique(spark, sf):
    return quality.unique(faulty(spark, sf), "price_key")


@query("quality_not_null", f"WITH {FAULTY} SELECT price_key, ticker, volume FROM faulty WHERE close IS NULL")
def quality_not_null(spark, sf):
    return quality.not_null(faulty(spark, sf), "close").select("price_key", "ticker", "volume")


MISTYPED = f"""{REFERENCE}, mistyped AS (
    SELECT * REPLACE (CASE WHEN sector = 'Health Care' THEN 'Healthcare' ELSE sector END AS sector)
    FROM reference
)"""
LISTED = ", ".join(f"'{s}'" for s in SECTORS)


def mistyped(spark, sf):
    wrong = F.when(F.col("sector") == "Health Care", "Healthcare").otherwise(F.col("sector"))
    return inputs.reference(spark, sf).withColumn("sector", wrong)


@query(
    "quality_accepted",
    f"""WITH {MISTYPED} SELECT sector, count(*) AS occurrences FROM mistyped
        WHERE sector NOT IN ({LISTED}) GROUP BY sector""",
)
def quality_accepted(spark, sf):
    return quality.accepted_values(mistyped(spark, sf), "sector", SECTORS)


@query(
    "quality_relationships",
    text(
        """SELECT ticker, trade_date FROM bars
           WHERE ticker IS NOT NULL AND ticker NOT IN (SELECT ticker FROM reference)""",
        "trade_date", ctes=f"{BARS}, {REFERENCE}",
    ),
)
def quality_relationships(spark, sf):
    """The bars of the one brand that is not on the reference list."""
    bars = inputs.daily_bars(spark, sf).select("ticker", "trade_date")
    return quality.relationships(bars, inputs.reference(spark, sf), "ticker")


def rule(condition: str, name: str) -> str:
    return f"CASE WHEN {condition} THEN '{name}' END"


@query(
    "quality_bar_consistency",
    text(
        f"""SELECT price_key, ticker, trade_date, open, high, low, close, volume,
                   concat_ws('; ', {rule('high < low', 'high is below low')},
                       {rule('high < open OR high < close', 'high is below open or close')},
                       {rule('low > open OR low > close', 'low is above open or close')},
                       CASE WHEN open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL
                                 AND close IS NOT NULL AND least(open, high, low, close) <= 0
                            THEN 'a price is zero or negative' END,
                       {rule('volume < 0', 'volume is negative')}) AS violations
            FROM faulty WHERE {CONTRADICTION}""",
        "trade_date", ctes=FAULTY,
    ),
)
def quality_bar_consistency(spark, sf):
    broken = quality.inconsistent_bars(faulty(spark, sf))
    return broken.withColumn("violations", F.array_join("violations", "; "))


@query(
    "quality_fact_matches",
    f"""WITH {FAULTY} SELECT * FROM (
            SELECT (SELECT count(*) FROM faulty) AS staging_rows,
                   (SELECT count(*) FROM staged) AS fact_rows,
                   (SELECT count(DISTINCT price_key) FROM faulty) AS staging_keys,
                   (SELECT count(DISTINCT price_key) FROM staged) AS fact_keys
        ) WHERE staging_rows <> fact_rows OR staging_keys <> fact_keys""",
)
def quality_fact_matches(spark, sf):
    """A fact table made before copies got into staging."""
    staged = inputs.staged_once(spark, sf)
    return quality.fact_mismatch(inputs.faulty(staged), marts.fct_daily_prices(staged))


@query(
    "freshness_weekdays",
    text(
        """SELECT newest AS newest_trade_date, DATE '2001-11-09' AS as_of, newest + n AS missed_day
           FROM (SELECT max(trade_date) AS newest FROM bars),
                (SELECT CAST(range AS INTEGER) AS n FROM range(1, 61))
           WHERE newest + n <= DATE '2001-11-09' AND isodow(newest + n) BETWEEN 1 AND 5""",
        "newest_trade_date", "as_of", "missed_day", ctes=BARS,
    ),
)
def freshness_weekdays(spark, sf):
    return quality.weekdays_behind(inputs.daily_bars(spark, sf), F.lit(inputs.AS_OF))


@query(
    "quality_not_empty",
    f"""WITH {BARS} SELECT * FROM (
            SELECT 'negative' AS looked_at, count(*) AS row_count FROM bars WHERE volume < 0
            UNION ALL SELECT 'all', count(*) FROM bars
        ) WHERE row_count = 0""",
)
def quality_not_empty(spark, sf):
    """No given bar has a negative volume: that selection is an empty table, the whole is not."""
    bars = inputs.daily_bars(spark, sf)
    negative = quality.empty_table(bars.filter(F.col("volume") < 0))
    return negative.select(F.lit("negative").alias("looked_at"), "row_count").unionByName(
        quality.empty_table(bars).select(F.lit("all").alias("looked_at"), "row_count")
    )


@query(
    "freshness_source",
    text(
        """SELECT newest_load, age_seconds,
                  CASE WHEN age_seconds > 864000 THEN 'error' WHEN age_seconds > 518400 THEN 'warn'
                       ELSE 'pass' END AS status
           FROM (SELECT max(loaded_at) AS newest_load,
                        CAST(epoch(TIMESTAMP '2001-12-10 12:00:00') - epoch(max(loaded_at)) AS BIGINT)
                            AS age_seconds FROM loads)""",
        "newest_load", ctes=LOADS,
    ),
)
def freshness_source(spark, sf):
    as_of = F.lit("2001-12-10 12:00:00").cast("timestamp_ntz")
    return quality.source_freshness(inputs.raw_loads(inputs.daily_bars(spark, sf)), as_of)


def _counts_sql() -> str:
    def row(name, severity, count, error_at=1, warn_at=1):
        bad = f"CASE WHEN n >= {error_at} THEN 'error' WHEN n >= {warn_at} THEN 'warn' ELSE 'pass' END"
        soft = f"CASE WHEN n >= {warn_at} THEN 'warn' ELSE 'pass' END"
        status = bad if severity == "error" else soft
        return (
            f"SELECT '{name}' AS test, '{severity}' AS severity, n AS violations, {status} AS status "
            f"FROM (SELECT CAST(({count}) AS BIGINT) AS n)"
        )

    relation = {
        "raw_prices": "loads",
        "ticker_reference": "mistyped",
        "stg_prices": "faulty",
        "dim_tickers": "dim",
        "fct_daily_prices": "fct",
    }

    def unique(table, column):
        repeated = (
            f"SELECT {column} FROM {relation[table]} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1"
        )
        return row(f"unique_{table}_{column}", "error", f"SELECT count(*) FROM ({repeated})")

    def not_null(table, column, severity="error", sql=None):
        count = sql or f"SELECT count(*) FROM {relation[table]} WHERE {column} IS NULL"
        return row(f"not_null_{table}_{column}", severity, count)

    weekdays = """SELECT count(*) FROM (SELECT max(trade_date) AS newest FROM faulty),
        (SELECT CAST(range AS INTEGER) AS d FROM range(1, 61))
        WHERE newest + d <= DATE '2001-11-09' AND isodow(newest + d) BETWEEN 1 AND 5"""
    return " UNION ALL ".join(
        [
            not_null("raw_prices", "payload", sql="SELECT count(*) FROM loads WHERE file_row_number = 3"),
            unique("ticker_reference", "ticker"),
            not_null("ticker_reference", "ticker"),
            not_null("ticker_reference", "company_name"),
            row(
                "accepted_values_ticker_reference_sector",
                "error",
                f"SELECT count(DISTINCT sector) FROM mistyped WHERE sector NOT IN ({LISTED})",
            ),
            unique("stg_prices", "price_key"),
            *[not_null("stg_prices", c) for c in ("price_key", "ticker", "trade_date", "loaded_at")],
            not_null("stg_prices", "close", "warn"),
            row(
                "prices_internally_consistent",
                "warn",
                f"SELECT count(*) FROM faulty WHERE {CONTRADICTION}",
            ),
            row("prices_are_current", "error", weekdays, 5, 3),
            row(
                "warehouse_not_empty",
                "error",
                "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM faulty",
            ),
            unique("dim_tickers", "ticker"),
            not_null("dim_tickers", "ticker"),
            *[not_null("dim_tickers", c, "warn") for c in ("company_name", "sector", "first_trade_date")],
            unique("fct_daily_prices", "price_key"),
            *[not_null("fct_daily_prices", c) for c in ("price_key", "ticker", "trade_date")],
            row(
                "relationships_fct_daily_prices_ticker",
                "error",
                "SELECT count(*) FROM fct WHERE ticker NOT IN (SELECT ticker FROM dim)",
            ),
            row(
                "fact_matches_staging",
                "error",
                "SELECT CASE WHEN (SELECT count(*) FROM faulty) <> (SELECT count(*) FROM fct) OR "
                "(SELECT count(DISTINCT price_key) FROM faulty) <> (SELECT count(DISTINCT price_key) FROM fct) "
                "THEN 1 ELSE 0 END",
            ),
        ]
    )


@query(
    "quality_report",
    f"""WITH {FAULTY}, loads AS (SELECT * FROM staged), {dim('faulty')}, mistyped AS (
            SELECT * REPLACE (CASE WHEN sector = 'Health Care' THEN 'Healthcare' ELSE sector END AS sector)
            FROM reference
        ), {fact('faulty')} {_counts_sql()}""",
)
def quality_report(spark, sf):
    """All 25 checks over tables built from faulty staging rows."""
    bars = settle(inputs.daily_bars(spark, sf), "bars")
    staged = settle(inputs.faulty(inputs.staged_rows(bars)), "faulty")
    dimension = marts.dim_tickers(inputs.reference(spark, sf), staged)
    tables = {
        "raw_prices": inputs.raw_single(bars).withColumn(
            "payload", F.when(F.col("file_row_number") != 3, F.col("payload"))
        ),
        "ticker_reference": mistyped(spark, sf),
        "stg_prices": staged,
        "dim_tickers": settle(dimension, "dim"),
        "fct_daily_prices": settle(marts.fct_daily_prices(staged), "fct"),
    }
    return run_checks(build_checks(F.lit(inputs.AS_OF)), tables.__getitem__)
