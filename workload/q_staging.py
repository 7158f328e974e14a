"""Typed staging, revisions and the duplicate classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions import bars as fb
from daybook.operators import duplicates, measures, revisions
from daybook.plans.load import loads_of
from daybook.plans.staging import keyed_bars, stg_prices, typed_bars
from daybook.schemas import STG_PRICES
from workload import inputs
from workload.oracle import BAR, BARS, FLAGGED, LOADS, STAGED, text
from workload.registry import query

STAGED_COLUMNS = ", ".join(c for c in STG_PRICES if c != "bar_hash")
DAYS_AND_INSTANTS = ("trade_date", "ingested_at_utc", "loaded_at")


@query(
    "typed_bars",
    text(f"SELECT {STAGED_COLUMNS} FROM loads", *DAYS_AND_INSTANTS, ctes=LOADS).replace(
        "SELECT price_key, ", "SELECT "
    ),
)
def typed_bars_query(spark, sf):
    return typed_bars(inputs.raw_loads(inputs.daily_bars(spark, sf)))


@query(
    "price_key",
    text(
        """SELECT CASE WHEN transaction_count % 7 = 0 THEN NULL ELSE ticker END AS ticker, trade_date,
                  CASE WHEN transaction_count % 7 = 0 THEN NULL ELSE ticker END
                      || '|' || CAST(trade_date AS VARCHAR) AS price_key
           FROM bars""",
        "trade_date", ctes=BARS,
    ),
)
def price_key(spark, sf):
    ticker = F.when(F.col("transaction_count") % 7 != 0, F.col("ticker"))
    bars = inputs.daily_bars(spark, sf).select(ticker.alias("ticker"), "trade_date")
    return bars.withColumn("price_key", fb.price_key(F.col("ticker"), F.col("trade_date")))


@query(
    "bar_fingerprint",
    f"""WITH {LOADS} SELECT price_key, count(DISTINCT row({BAR})) AS fingerprints
        FROM loads GROUP BY price_key""",
)
def bar_fingerprint(spark, sf):
    """The hash itself is this engine's own, so what it tells apart is compared."""
    rows = keyed_bars(typed_bars(inputs.raw_loads(inputs.daily_bars(spark, sf))))
    return rows.groupBy("price_key").agg(F.countDistinct("bar_hash").alias("fingerprints"))


@query(
    "load_latency",
    f"""WITH {STAGED} SELECT price_key,
            CAST(epoch(loaded_at) - epoch(ingested_at_utc) AS BIGINT) AS latency_seconds FROM staged""",
)
def load_latency(spark, sf):
    rows = keyed_bars(typed_bars(inputs.raw_single(inputs.daily_bars(spark, sf))))
    return rows.select(
        "price_key",
        fb.latency_seconds(F.col("loaded_at"), F.col("ingested_at_utc")).alias("latency_seconds"),
    )


@query(
    "key_revised",
    f"""WITH {FLAGGED}
        SELECT price_key, count(*) AS loads, bool_or(key_was_revised) AS key_was_revised
        FROM flagged GROUP BY price_key""",
)
def key_revised(spark, sf):
    rows = inputs.raw_loads(inputs.daily_bars(spark, sf))
    return revisions.key_revisions(keyed_bars(typed_bars(rows)))


@query(
    "file_revised",
    f"""WITH {FLAGGED}
        SELECT source_file, count(*) AS rows, bool_or(file_was_revised) AS file_was_revised
        FROM scoped GROUP BY source_file""",
)
def file_revised(spark, sf):
    return revisions.file_revisions(keyed_bars(typed_bars(inputs.raw_table(spark, sf))))


@query("stg_prices", text(f"SELECT {STAGED_COLUMNS} FROM stg", *DAYS_AND_INSTANTS, ctes=FLAGGED))
def stg_prices_query(spark, sf):
    return stg_prices(inputs.raw_table(spark, sf)).drop("bar_hash")


@query(
    "raw_sample",
    text(
        """SELECT ticker, trade_date, open, high, low, close, volume, vwap, transaction_count,
                  source_file, file_row_number, loaded_at
           FROM loads ORDER BY ticker, trade_date, loaded_at LIMIT 5""",
        "trade_date", "loaded_at", ctes=LOADS,
    ),
)
def raw_sample(spark, sf):
    rows = typed_bars(inputs.raw_loads(inputs.daily_bars(spark, sf))).drop("ingested_at_utc")
    return rows.orderBy("ticker", "trade_date", "loaded_at").limit(5)


def measure(source: str) -> str:
    return f"""SELECT count(*) AS rows_total, count(DISTINCT source_file) AS files_total,
                      count(DISTINCT price_key) AS distinct_keys, count(DISTINCT ticker) AS tickers,
                      min(trade_date) AS first_day, max(trade_date) AS last_day FROM {source}"""


@query("load_measure", text(measure("loads"), "first_day", "last_day", ctes=LOADS))
def load_measure(spark, sf):
    return measures.table_measure(typed_bars(inputs.raw_table(spark, sf)))


@query("stg_measure", text(measure("stg"), "first_day", "last_day", ctes=FLAGGED))
def stg_measure(spark, sf):
    return measures.table_measure(stg_prices(inputs.raw_table(spark, sf)))


DUPLICATES = f"""{LOADS}, per_key AS (
    SELECT ticker, trade_date, count(*) AS loads, count(DISTINCT row({BAR})) AS distinct_bars
    FROM loads GROUP BY ticker, trade_date HAVING count(*) > 1
), key_files AS (
    SELECT DISTINCT loads.source_file, per_key.* FROM loads JOIN per_key USING (ticker, trade_date)
), per_file AS (
    SELECT source_file, count(*) AS dup_keys, count_if(distinct_bars > 1) AS changed_keys,
           CAST(sum(loads - 1) AS BIGINT) AS extra_rows,
           min(trade_date) AS first_day, max(trade_date) AS last_day
    FROM key_files GROUP BY source_file
), summary AS (
    SELECT count_if(changed_keys = 0) AS reloaded_files, count_if(changed_keys > 0) AS revised_files,
           CAST(coalesce(sum(dup_keys) FILTER (changed_keys = 0), 0) AS BIGINT) AS reloaded_keys,
           CAST(coalesce(sum(dup_keys) FILTER (changed_keys > 0), 0) AS BIGINT) AS revised_keys,
           CAST(coalesce(sum(extra_rows) FILTER (changed_keys = 0), 0) AS BIGINT) AS reloaded_rows,
           CAST(coalesce(sum(extra_rows) FILTER (changed_keys > 0), 0) AS BIGINT) AS revised_rows,
           CAST(coalesce(sum(changed_keys), 0) AS BIGINT) AS changed_bars,
           min(first_day) FILTER (changed_keys > 0) AS first_revised,
           max(last_day) FILTER (changed_keys > 0) AS last_revised,
           min(first_day) FILTER (changed_keys = 0) AS first_reloaded,
           max(last_day) FILTER (changed_keys = 0) AS last_reloaded
    FROM per_file
)"""


def raw_load_rows(spark, sf):
    return loads_of(inputs.raw_table(spark, sf))


@query("dup_keys", text("SELECT * FROM per_key", "trade_date", ctes=DUPLICATES))
def dup_keys(spark, sf):
    return duplicates.duplicate_keys(raw_load_rows(spark, sf))


@query("dup_key_files", text("SELECT * FROM key_files", "trade_date", ctes=DUPLICATES))
def dup_key_files(spark, sf):
    return duplicates.duplicate_key_files(raw_load_rows(spark, sf))


@query("dup_files", text("SELECT * FROM per_file", "first_day", "last_day", ctes=DUPLICATES))
def dup_files(spark, sf):
    return duplicates.duplicate_files(raw_load_rows(spark, sf))


@query(
    "classify_duplicates",
    text(
        "SELECT * FROM summary",
        "first_revised", "last_revised", "first_reloaded", "last_reloaded", ctes=DUPLICATES,
    ),
)
def classify_duplicates(spark, sf):
    return duplicates.classify_duplicates(raw_load_rows(spark, sf))


@query(
    "duplicate_verdict",
    f"""WITH {DUPLICATES} SELECT
            CASE WHEN reloaded_files > 0 THEN 'STOP' WHEN revised_files > 0 THEN 'WARN' ELSE 'OK' END
                AS verdict,
            reloaded_files, revised_files, changed_bars, revised_keys - changed_bars AS passengers,
            reloaded_rows, revised_rows FROM summary""",
)
def duplicate_verdict(spark, sf):
    return duplicates.verdict(duplicates.classify_duplicates(raw_load_rows(spark, sf)))
