"""The checks that run with every build, and the freshness check that does not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.operators import quality
from daybook.operators.quality import Check
from daybook.schemas import SECTORS

# At how many missed weekdays to warn and to err.
WEEKDAYS_WARN = 3
WEEKDAYS_ERROR = 5


def _unique(table: str, column: str) -> Check:
    return Check(
        f"unique_{table}_{column}",
        table,
        "error",
        violations=lambda t: quality.unique(t(table), column),
    )


def _not_null(table: str, column: str, severity: str = "error") -> Check:
    return Check(f"not_null_{table}_{column}", table, severity, F.col(column).isNull())


def build_checks(as_of: Column) -> list[Check]:
    """All 25 checks. A broken grain is an error, a strange number a warning."""
    return [
        _not_null("raw_prices", "payload"),
        _unique("ticker_reference", "ticker"),
        _not_null("ticker_reference", "ticker"),
        _not_null("ticker_reference", "company_name"),
        Check(
            "accepted_values_ticker_reference_sector",
            "ticker_reference",
            "error",
            violations=lambda t: quality.accepted_values(t("ticker_reference"), "sector", SECTORS),
        ),
        _unique("stg_prices", "price_key"),
        _not_null("stg_prices", "price_key"),
        _not_null("stg_prices", "ticker"),
        _not_null("stg_prices", "trade_date"),
        _not_null("stg_prices", "close", "warn"),
        _not_null("stg_prices", "loaded_at"),
        Check("prices_internally_consistent", "stg_prices", "warn", quality.any_contradiction()),
        Check(
            "prices_are_current",
            "stg_prices",
            "error",
            violations=lambda t: quality.weekdays_behind(t("stg_prices"), as_of),
            warn_at=WEEKDAYS_WARN,
            error_at=WEEKDAYS_ERROR,
        ),
        Check(
            "warehouse_not_empty",
            "stg_prices",
            "error",
            violations=lambda t: quality.empty_table(t("stg_prices")),
        ),
        _unique("dim_tickers", "ticker"),
        _not_null("dim_tickers", "ticker"),
        _not_null("dim_tickers", "company_name", "warn"),
        _not_null("dim_tickers", "sector", "warn"),
        _not_null("dim_tickers", "first_trade_date", "warn"),
        _unique("fct_daily_prices", "price_key"),
        _not_null("fct_daily_prices", "price_key"),
        _not_null("fct_daily_prices", "ticker"),
        _not_null("fct_daily_prices", "trade_date"),
        Check(
            "relationships_fct_daily_prices_ticker",
            "fct_daily_prices",
            "error",
            violations=lambda t: quality.relationships(
                t("fct_daily_prices"), t("dim_tickers"), "ticker"
            ),
            needs=("dim_tickers",),
        ),
        Check(
            "fact_matches_staging",
            "fct_daily_prices",
            "error",
            violations=lambda t: quality.fact_mismatch(t("stg_prices"), t("fct_daily_prices")),
            needs=("stg_prices",),
        ),
    ]
