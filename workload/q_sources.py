"""Reading responses, lines, lists and listings; merging, publishing, loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions import bars as fb
from daybook.operators.upsert import merge_days
from daybook.plans.ingest import BACKFILL_DAYS, in_window
from daybook.plans.load import files_to_load
from daybook.operators.measures import table_measure
from daybook.plans.manifests import (
    failed_tickers,
    ingest_manifest,
    load_manifest,
    publish_manifest,
    ticker_outcomes,
)
from daybook.plans.publish import publish_plan
from daybook.plans.staging import typed_bars
from daybook.schemas import BAR_NUMBERS
from daybook.scratch import scratch_path, settle
from daybook.sources.day_files import json_line, json_number, json_text
from daybook.sources.lines import as_payload, digest_text, line_digest, number_lines, scan_lines
from daybook.sources.listing import stage_summary
from daybook.sources.reference import (
    missing_from,
    read_reference,
    universe_of_lines,
    universe_override,
)
from daybook.sources.responses import bars_to_rows, envelope_bars
from workload import inputs, oracle
from workload.oracle import BARS, REFERENCE, text
from workload.registry import query


def bar_json():
    """A bar as the provider sends it; thin sessions carry no average price."""
    t = F.unix_millis(F.col("trade_date").cast("timestamp")) + 4 * 60 * 60 * 1000
    thin = F.col("transaction_count") % 2 == 0
    vwap = F.when(thin, F.lit("")).otherwise(F.concat(F.lit(', "vw": '), json_number(F.col("vwap"))))
    fields = {"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}
    parts = [F.concat(F.lit(f', "{k}": '), json_number(F.col(c))) for k, c in fields.items()]
    return F.concat(
        F.lit('{"T": '), json_text(F.col("ticker")), *parts, vwap,
        F.lit(', "t": '), t.cast("string"),
        F.lit(', "n": '), F.col("transaction_count").cast("string"), F.lit("}"),
    )


def responses(bars):
    """One response per ticker and month, at most 31 bars each. April's are errors,
    July's lack results, odd months are delayed."""
    month = F.month("month")
    dated = F.array_sort(F.collect_list(F.struct("trade_date", bar_json().alias("json"))))
    listed = F.transform(dated, lambda b: b["json"])
    by_month = F.trunc("trade_date", "month").alias("month")
    grouped = bars.groupBy("ticker", by_month).agg(listed.alias("bars"))
    state = F.when(month == 4, "ERROR").when(month % 2 == 1, "DELAYED").otherwise("OK")
    results = F.when(month == 7, F.lit("")).otherwise(
        F.concat(F.lit(', "results": ['), F.array_join("bars", ", "), F.lit("]"))
    )
    return grouped.select(
        F.concat(
            F.lit('{"ticker": '), json_text(F.col("ticker")), F.lit(', "adjusted": true, "status": "'),
            state, F.lit('"'), results, F.lit("}"),
        ).alias("value")
    )


USABLE = "SELECT * FROM bars WHERE month(trade_date) NOT IN (4, 7)"


@query(
    "api_envelope_explode",
    text(
        f"""SELECT ticker,
                   CAST(row_number() OVER (PARTITION BY ticker, date_trunc('month', trade_date)
                                           ORDER BY trade_date) - 1 AS INTEGER) AS position,
                   trade_date, close, transaction_count AS transactions
            FROM ({USABLE})""",
        "trade_date", ctes=BARS,
    ),
)
def api_envelope_explode(spark, sf):
    rows = bars_to_rows(envelope_bars(responses(inputs.daily_bars(spark, sf))), "unused")
    return rows.select("ticker", "position", "trade_date", "close", "transactions")


@query(
    "bar_rename",
    text(
        """SELECT ticker, trade_date, open, high, low, close, volume,
                  CASE WHEN transaction_count % 2 = 1 THEN vwap END AS vwap,
                  transaction_count AS transactions, '2001-12-01T00:00:00+00:00' AS ingested_at_utc
           FROM bars""",
        "trade_date", ctes=BARS,
    ),
)
def bar_rename(spark, sf):
    bars = inputs.daily_bars(spark, sf).select(
        "ticker", F.lit(0).alias("position"), F.parse_json(bar_json()).alias("bar")
    )
    return bars_to_rows(bars, "2001-12-01T00:00:00+00:00").drop("position")


@query(
    "epoch_ms_to_date",
    text("SELECT event_id, CAST(ts AS DATE) AS event_date FROM events", "event_date"),
)
def epoch_ms_to_date(spark, sf):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return inputs.table(spark, sf, "events").select(
        "event_id", fb.epoch_ms_to_date(ms).alias("event_date")
    )


@query(
    "raw_variant_scan",
    text(
        """SELECT ticker, trade_date, close = floor(close) AS close_is_integer,
                  volume = floor(volume) AS volume_is_integer, close FROM bars""",
        "trade_date", ctes=BARS,
    ),
)
def raw_variant_scan(spark, sf):
    root = inputs.written_days(inputs.daily_bars(spark, sf))
    payload = F.col("payload")

    def is_integer(name):
        kind = F.schema_of_variant(F.variant_get(payload, f"$.{name}", "variant"))
        return (kind == "BIGINT").alias(f"{name}_is_integer")

    return as_payload(scan_lines(spark, root)).select(
        F.variant_get(payload, "$.ticker", "string").alias("ticker"),
        F.variant_get(payload, "$.trade_date", "date").alias("trade_date"),
        is_integer("close"),
        is_integer("volume"),
        F.variant_get(payload, "$.close", "double").alias("close"),
    )


@query(
    "raw_lineage",
    text(
        """SELECT 'date=' || CAST(trade_date AS VARCHAR) || '/prices.jsonl' AS source_file,
                  row_number() OVER (PARTITION BY trade_date ORDER BY ticker) AS file_row_number,
                  ticker, trade_date FROM bars""",
        "trade_date", ctes=BARS,
    ),
)
def raw_lineage(spark, sf):
    """Every day is an object of its own; the scan packs many into one task."""
    root = inputs.written_days(inputs.daily_bars(spark, sf), "day")
    payload = F.col("payload")
    return as_payload(number_lines(scan_lines(spark, root))).select(
        "source_file",
        "file_row_number",
        F.variant_get(payload, "$.ticker", "string").alias("ticker"),
        F.variant_get(payload, "$.trade_date", "date").alias("trade_date"),
    )


@query(
    "raw_scan_any_layout",
    text(
        """SELECT CASE day(trade_date) % 3 WHEN 0 THEN 'days' WHEN 1 THEN 'deep' ELSE 'loose' END AS place,
                  ticker, trade_date FROM bars""",
        "trade_date", ctes=BARS,
    ),
)
def raw_scan_any_layout(spark, sf):
    """Files in date folders, beside them and below others: one scan reads all."""
    bars = settle(inputs.daily_bars(spark, sf), "bars")
    third = F.dayofmonth("trade_date") % 3
    root = inputs.written_days(bars.filter(third == 0))
    lines = inputs.landed(bars).withColumn("value", json_line())
    lines.filter(third == 1).select("value").write.text(f"{root}/extra/deep")
    lines.filter(third == 2).select("value").write.text(f"{root}/loose")
    place = F.when(F.col("source_file").startswith("date="), "days").otherwise(
        F.when(F.col("source_file").startswith("extra/deep/"), "deep").otherwise(
            F.substring_index("source_file", "/", 1)
        )
    )
    return as_payload(scan_lines(spark, root)).select(
        place.alias("place"),
        F.variant_get("payload", "$.ticker", "string").alias("ticker"),
        F.variant_get("payload", "$.trade_date", "date").alias("trade_date"),
    )


@query(
    "universe_file",
    "SELECT upper(p_brand) AS ticker, count(*) AS listed FROM part GROUP BY upper(p_brand)",
)
def universe_file(spark, sf):
    """A line for every part: its brand between tabs and blanks, a comment, a blank line."""
    part = inputs.table(spark, sf, "part")
    brand = F.replace(F.lower("p_brand"), F.lit("#"), F.lit("@"))
    listed = F.concat(F.lit("\t \u00a0"), brand, F.lit("\t\u2003# "), "p_type")
    lines = part.select(F.explode(F.array(listed, F.concat(F.lit("  #"), "p_type"), F.lit("\t \x1f"))).alias("value"))
    symbols = universe_of_lines(lines).select(F.replace("ticker", F.lit("@"), F.lit("#")).alias("ticker"))
    return symbols.groupBy("ticker").agg(F.count("*").alias("listed"))


@query("seed_reference", f"WITH {REFERENCE} SELECT * FROM reference")
def seed_reference(spark, sf):
    path = scratch_path(spark, "reference")
    inputs.reference(spark, sf).write.option("header", True).csv(path)
    return read_reference(spark, path)


@query(
    "universe_override",
    """SELECT ticker, count(*) AS requests FROM (
           SELECT upper(trim(p_brand)) AS ticker FROM part
           UNION ALL SELECT upper(trim(p_type)) FROM part
       ) WHERE ticker <> '' GROUP BY ticker""",
)
def universe_override_query(spark, sf):
    lists = inputs.table(spark, sf, "part").select(
        F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" , ,"), "p_type").alias("value")
    )
    return universe_override(lists).groupBy("ticker").agg(F.count("*").alias("requests"))


def day_objects(bars):
    """(source_file, digest, bytes) of the bars' day files."""
    lines = inputs.landed(bars).select(
        inputs.day_file(F.col("trade_date")).alias("source_file"), json_line().alias("value")
    )
    totals = lines.groupBy("source_file").agg(
        F.count("*").alias("row_count"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        *line_digest(F.col("value")),
    )
    return totals.select(
        "source_file", digest_text(F.col("row_count")).alias("digest"), "row_count", "bytes"
    )


def revised(bars):
    """The average price of short-named brands moves on the 8th."""
    hit = (F.dayofmonth("trade_date") == 8) & (F.char_length("ticker") == 7)
    return bars.withColumn("vwap", F.col("vwap") + F.when(hit, inputs.REVISION_STEP).otherwise(0.0))


OBJECTS = f"""{BARS}, objects AS (
    SELECT 'raw/prices/date=' || CAST(trade_date AS VARCHAR) || '/prices.jsonl' AS name,
           month(trade_date) = 1 AS is_new,
           bool_or(day(trade_date) = 8 AND length(ticker) = 7) AS is_changed
    FROM bars GROUP BY trade_date
)"""


@query(
    "publish_plan",
    f"""WITH {OBJECTS} SELECT name AS object_key,
           CASE WHEN is_new OR is_changed THEN 'upload' ELSE 'skip' END AS action FROM objects""",
)
def publish_plan_query(spark, sf):
    """January was never published and the 8ths have changed since."""
    bars = settle(inputs.daily_bars(spark, sf), "bars")
    local = day_objects(revised(bars)).withColumnRenamed("source_file", "object_key")
    published = day_objects(bars.filter(F.month("trade_date") != 1))
    plan = publish_plan(local, published.withColumnRenamed("source_file", "object_key"))
    return plan.select("object_key", "action")


@query(
    "files_to_load",
    f"WITH {OBJECTS} SELECT name AS source_file FROM objects WHERE is_new OR is_changed",
)
def files_to_load_query(spark, sf):
    """The ledger knows all but January, and the 8ths by their old content."""
    bars = settle(inputs.daily_bars(spark, sf), "bars")
    ledger = day_objects(bars.filter(F.month("trade_date") != 1))
    return files_to_load(day_objects(revised(bars)), ledger).select("source_file")


LOST = ("raw/prices/date=1995-01-10/prices.jsonl", "raw/prices/date=1996-03-08/prices.jsonl")
PLANNED = f"""{OBJECTS}, planned AS (
    SELECT name, CASE WHEN is_new OR is_changed THEN 'upload' ELSE 'skip' END AS action,
           name IN {LOST} AS lost FROM objects
)"""


@query(
    "publish_manifest",
    f"""WITH {PLANNED} SELECT 'run' AS run_id, 'publish' AS kind, false AS dry_run,
               count_if(action = 'upload' AND NOT lost) AS files_uploaded,
               count_if(action = 'skip') AS files_skipped_identical, count_if(lost) AS files_failed,
               min(name) FILTER (action = 'upload' AND NOT lost) AS oldest_partition_uploaded,
               max(name) FILTER (action = 'upload' AND NOT lost) AS newest_partition_uploaded
        FROM planned""",
)
def publish_manifest_query(spark, sf):
    """Two objects could not be written: a new and a changed one."""
    bars = settle(inputs.daily_bars(spark, sf), "bars")
    local = day_objects(revised(bars)).withColumnRenamed("source_file", "object_key")
    published = day_objects(bars.filter(F.month("trade_date") != 1))
    plan = publish_plan(local, published.withColumnRenamed("source_file", "object_key"))
    made = publish_manifest(plan, "run", False, [(key, "in the way") for key in LOST])
    return made.drop("finished_at_utc", "failures", "bytes_uploaded")


def staged_listing(bars):
    """A listing of the bars' day files, a hundred bytes a line."""
    objects = bars.groupBy(inputs.day_file(F.col("trade_date")).alias("source_file"))
    return objects.agg((F.count("*") * 100).alias("bytes"), F.max(inputs.utc_literal(inputs.FIRST_LOAD)).alias("modified_at"))


@query(
    "stage_summary",
    f"WITH {BARS} SELECT count(DISTINCT trade_date) AS staged_files, count(*) * 100 AS staged_bytes FROM bars",
)
def stage_summary_query(spark, sf):
    return stage_summary(staged_listing(inputs.daily_bars(spark, sf)))


@query(
    "load_manifest",
    text(
        """SELECT 'run' AS run_id, 'load' AS kind, false AS dry_run,
                  (SELECT count(DISTINCT source_file) FROM loads WHERE loaded_at > TIMESTAMP '2001-12-01 00:00:00')
                      AS files_processed,
                  (SELECT count(*) FROM loads WHERE loaded_at > TIMESTAMP '2001-12-01 00:00:00')
                      AS rows_loaded_this_run,
                  (SELECT count(*) FROM bars) AS rows_before,
                  (SELECT count(DISTINCT trade_date) FROM bars) AS staged_files,
                  (SELECT count(*) * 100 FROM bars) AS staged_bytes,
                  count(*) AS rows_after, count(DISTINCT price_key) AS distinct_keys_after,
                  count(DISTINCT source_file) AS files_after, count(DISTINCT ticker) AS tickers_after,
                  min(trade_date) AS first_day, max(trade_date) AS last_day
           FROM loads""",
        "first_day", "last_day", ctes=oracle.LOADS,
    ),
)
def load_manifest_query(spark, sf):
    """The two later loads as one run."""
    bars = settle(inputs.daily_bars(spark, sf), "bars")
    raw = inputs.raw_table(spark, sf)
    later = raw.filter(F.col("loaded_at") > inputs.utc_literal(inputs.FIRST_LOAD))
    done = later.agg(F.countDistinct("source_file").alias("files"), F.count("*").alias("rows")).first()
    loaded = {"files_processed": done["files"], "rows_loaded": done["rows"]}
    after = table_measure(typed_bars(raw))
    staged = stage_summary(staged_listing(bars))
    return load_manifest(bars.count(), after, loaded, staged, "run", False).drop("finished_at_utc")


RECEIVED = f"""{BARS}, {REFERENCE}, received AS (
    SELECT * FROM bars WHERE trade_date BETWEEN DATE '2001-11-09' - 730 AND DATE '2001-11-09'
                         AND ticker <> 'Brand#7'
)"""


def received(spark, sf):
    """Two years back from the run, with one brand's request failing."""
    window = in_window(F.col("trade_date"), F.lit(inputs.AS_OF), BACKFILL_DAYS)
    return inputs.daily_bars(spark, sf).filter(window & (F.col("ticker") != "Brand#7"))


@query(
    "ingest_manifest",
    text(
        """SELECT (SELECT count(*) FROM reference) AS tickers_requested,
                  (SELECT count(*) FROM reference WHERE ticker IN (SELECT ticker FROM received))
                      AS tickers_succeeded,
                  (SELECT count(*) FROM reference WHERE ticker NOT IN (SELECT ticker FROM received))
                      AS tickers_failed,
                  count(*) AS bars_received, count(DISTINCT trade_date) AS trade_dates_touched,
                  min(trade_date) AS oldest_trade_date, max(trade_date) AS newest_trade_date,
                  CAST(DATE '2001-11-09' - max(trade_date) AS INTEGER) AS lag_days_vs_run
           FROM received""",
        "oldest_trade_date", "newest_trade_date", ctes=RECEIVED,
    ),
)
def ingest_manifest_query(spark, sf):
    rows = settle(received(spark, sf), "received")
    return ingest_manifest(rows, inputs.reference(spark, sf), F.lit(inputs.AS_OF))


@query(
    "ingest_outcomes",
    f"""WITH {RECEIVED} SELECT reference.ticker, count(received.ticker) AS bars,
           CASE WHEN count(received.ticker) > 0 THEN 'succeeded' ELSE 'failed' END AS outcome
        FROM reference LEFT JOIN received ON reference.ticker = received.ticker
        GROUP BY reference.ticker""",
)
def ingest_outcomes(spark, sf):
    return ticker_outcomes(received(spark, sf), inputs.reference(spark, sf))


@query(
    "failed_tickers",
    f"""WITH {RECEIVED} SELECT ticker FROM reference
        WHERE ticker NOT IN (SELECT ticker FROM received)""",
)
def failed_tickers_query(spark, sf):
    return failed_tickers(received(spark, sf), inputs.reference(spark, sf))


@query(
    "universe_missing",
    f"""WITH {REFERENCE} SELECT ticker FROM reference
        EXCEPT SELECT p_brand FROM part JOIN lineitem ON l_partkey = p_partkey""",
)
def universe_missing(spark, sf):
    return missing_from(inputs.reference(spark, sf), inputs.trades(spark, sf))


@query(
    "trailing_window",
    text(
        """SELECT ticker, trade_date, close FROM bars
           WHERE trade_date BETWEEN DATE '2001-11-09' - 7 AND DATE '2001-11-09'""",
        "trade_date", ctes=BARS,
    ),
)
def trailing_window(spark, sf):
    """The filter on the trade date reaches the trades before they are joined."""
    window = in_window(F.col("trade_date"), F.lit(inputs.AS_OF), 7)
    return inputs.daily_bars(spark, sf).filter(window).select("ticker", "trade_date", "close")


@query(
    "upsert_merge",
    text(
        """SELECT trade_date, ticker, open, high, low, close, volume,
                  CASE WHEN day(trade_date) = 8 AND length(ticker) = 7 AND ticker <> 'Brand#7'
                       THEN vwap + 0.0009765625 ELSE vwap END AS vwap,
                  transaction_count AS transactions,
                  CASE WHEN month(trade_date) = 1
                         OR (day(trade_date) = 8 AND length(ticker) = 7 AND ticker <> 'Brand#7')
                       THEN '2001-12-01T00:00:00+00:00'
                       ELSE CAST(trade_date + 1 AS VARCHAR) || 'T11:00:00+00:00' END AS ingested_at_utc,
                  (month(trade_date) = 1 OR day(trade_date) = 3
                   OR (day(trade_date) = 8 AND length(ticker) = 7 AND ticker <> 'Brand#7')) AS changed
           FROM bars WHERE NOT (ticker = 'Brand#7' AND month(trade_date) = 1)""",
        "trade_date", ctes=BARS,
    ),
)
def upsert_merge(spark, sf):
    """January is new, the 8ths were revised, the 3rds have repeated lines on disk, and
    Brand#7 was not received at all."""
    bars = settle(inputs.landed(inputs.daily_bars(spark, sf)), "bars")
    # Every bar of the 3rds is on disk twice, the first time with another price.
    copies = F.when(F.dayofmonth("trade_date") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    old = bars.filter(F.month("trade_date") != 1).withColumn("line", F.explode(copies))
    old = old.withColumn("close", F.col("close") + F.when(F.col("line") == 0, 1.0).otherwise(0.0))
    new = (
        revised(bars.filter(F.col("ticker") != "Brand#7"))
        .withColumn("ingested_at_utc", F.lit("2001-12-01T00:00:00+00:00"))
        .withColumn("position", F.lit(0))
    )
    return merge_days(old, new).select(*bars.columns, "changed")


CHANGED_SQL = ", ".join(
    f"CASE day(trade_date) WHEN {2 * i + 1} THEN {name} + 1 WHEN {2 * i + 2} THEN NULL ELSE {name} END AS new_{name}"
    for i, name in enumerate(BAR_NUMBERS)
)
SAME_SQL = " AND ".join(f"{name} IS NOT DISTINCT FROM new_{name}" for name in BAR_NUMBERS)


@query(
    "same_bar",
    text(
        f"""SELECT ticker, trade_date, {SAME_SQL} AS same FROM (SELECT *, {CHANGED_SQL} FROM bars)""",
        "trade_date", ctes=BARS,
    ),
)
def same_bar_query(spark, sf):
    """By the day of the month one of the seven numbers changes, or is lost, or none is."""
    day = F.dayofmonth("trade_date")
    changed = [
        F.when(day == 2 * i + 1, F.col(name) + 1).when(day != 2 * i + 2, F.col(name)).alias(name)
        for i, name in enumerate(BAR_NUMBERS)
    ]
    return inputs.daily_bars(spark, sf).select(
        "ticker", "trade_date", fb.same_bar(F.struct(*BAR_NUMBERS), F.struct(*changed), BAR_NUMBERS).alias("same")
    )


@query(
    "utc_normalise",
    "SELECT event_id, strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS utc FROM events",
)
def utc_normalise(spark, sf):
    """Texts with an offset become UTC wall time."""
    written = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))
    return inputs.table(spark, sf, "events").select("event_id", fb.utc_ntz(written).alias("utc"))


@query(
    "trading_day_of_instant",
    text(
        """SELECT event_id, CAST(ts - CASE
                  WHEN ts >= TIMESTAMP '2024-03-10 07:00:00' AND ts < TIMESTAMP '2024-11-03 06:00:00'
                  THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END AS DATE) AS trading_day FROM events""",
        "trading_day",
    ),
)
def trading_day_of_instant(spark, sf):
    return inputs.table(spark, sf, "events").select(
        "event_id", fb.trading_day(F.col("ts")).alias("trading_day")
    )


@query(
    "variant_extract",
    """SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
              CAST(NULL AS BIGINT) AS absent FROM events""",
)
def variant_extract(spark, sf):
    props = F.parse_json("props")
    return inputs.table(spark, sf, "events").select(
        "event_id",
        F.variant_get(props, "$.k", "bigint").alias("k"),
        F.variant_get(props, "$.absent", "bigint").alias("absent"),
    )
