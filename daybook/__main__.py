"""Command line: ``python -m daybook ingest|publish|load|build|roll|freshness``.

Exit codes say whether a run did its work: 1 when a ticker failed, when an object
could not be published, when a file was loaded twice unchanged, or when a check ended
in an error.
"""

from __future__ import annotations

import argparse
import datetime
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.bars import utc_ntz
from daybook.operators.quality import source_freshness
from daybook.plans.build import build
from daybook.plans.ingest import BACKFILL_DAYS, DAILY_DAYS, ingest
from daybook.plans.load import load, read_raw
from daybook.plans.publish import PREFIX, publish
from daybook.plans.rolling import RawTable, RollingFact, roll_loads
from daybook.scratch import forget_settled
from daybook.session import build_session
from daybook.sources.reference import read_reference, read_universe, universe_override
from daybook.sources.warehouse import Warehouse


# Days back by mode.
WINDOWS = {"daily": DAILY_DAYS, "backfill": BACKFILL_DAYS}


def _positive(text: str) -> int:
    number = int(text)
    if number < 1:
        raise argparse.ArgumentTypeError(f"{text} is not a number of days")
    return number


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="daybook", description=__doc__.split("\n")[0])
    top.add_argument("--home", required=True, help="directory of data, stage, raw table and ledgers")
    steps = top.add_subparsers(dest="step", required=True)

    fetch = steps.add_parser("ingest", help="merge landed responses into day partitions")
    fetch.add_argument("--responses", required=True, help="text with one response per line")
    fetch.add_argument("--universe", help="file of symbols, one per line")
    fetch.add_argument("--tickers", help="comma list of symbols instead of the file")
    fetch.add_argument(
        "--backfill", dest="mode", action="store_const", const="backfill", default="daily",
        help=f"{WINDOWS['backfill']} days back instead of {WINDOWS['daily']}",
    )
    fetch.add_argument("--days", type=_positive, help="days back, whatever the mode")
    fetch.add_argument("--as-of", type=datetime.date.fromisoformat, help="last day of the window")

    for name, does in (("publish", "copy changed days to the stage"), ("load", "append new files to raw")):
        step = steps.add_parser(name, help=does)
        step.add_argument("--dry-run", action="store_true", help="report only")
        if name == "load":
            step.add_argument("--history-days", type=int, help="forget loads older than this")

    make = steps.add_parser("build", help="make and check all tables")
    make.add_argument("--reference", required=True, help="CSV of ticker, company and sector")
    make.add_argument("--as-of", type=datetime.date.fromisoformat, help="day to judge lateness by")

    steps.add_parser("roll", help="carry the rolling fact table forward by the new loads")
    steps.add_parser("freshness", help="age of the newest load")
    return top


def _universe(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.tickers:
        return universe_override(spark.createDataFrame([(args.tickers,)], "value string"))
    if args.universe:
        return read_universe(spark, args.universe)
    raise SystemExit("ingest needs --universe or --tickers")


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one step; prints its record and returns the exit code."""
    home = args.home.rstrip("/")
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None, microsecond=0)
    raw, loaded = f"{home}/raw", f"{home}/ledgers/loaded"
    if args.step == "ingest":
        window = WINDOWS[args.mode] if args.days is None else args.days
        record = ingest(
            spark, spark.read.text(args.responses), _universe(spark, args), f"{home}/data", now,
            days_back=window, mode=args.mode, as_of=args.as_of,
        )
        failed = record["tickers_failed"] > 0
    elif args.step == "publish":
        record = publish(
            spark, f"{home}/data/days", f"{home}/stage", f"{home}/ledgers/published", now,
            dry_run=args.dry_run, manifests=f"{home}/data/_runs",
        )
        failed = record["files_failed"] > 0
    elif args.step == "load":
        record = load(
            spark, f"{home}/stage/{PREFIX}", raw, loaded, now, dry_run=args.dry_run,
            history_days=args.history_days, manifests=f"{home}/data/_runs",
        )
        failed = record["verdict"] == "STOP"
    elif args.step == "build":
        house = Warehouse(spark, root=f"{home}/tables", views={"raw_prices": read_raw(spark, raw, loaded)})
        as_of = None if args.as_of is None else F.lit(args.as_of)
        nodes = build(house, read_reference(spark, args.reference), as_of).collect()
        for node in nodes:
            count = f" ({node.violations})" if node.violations else ""
            print(f"{node.status:5} {node.kind:5} {node.node}{count}")
        counts = [n.status for n in nodes]
        record = {status: counts.count(status) for status in ("pass", "warn", "error", "skip")}
        failed = record["error"] > 0
    elif args.step == "roll":
        months = roll_loads(RawTable(spark, raw, loaded), RollingFact(spark, f"{home}/rolling"))
        record, failed = {f"months_{what}": len(which) for what, which in months.items()}, False
    else:
        age = source_freshness(read_raw(spark, raw, loaded), utc_ntz(F.current_timestamp())).first()
        record, failed = age.asDict(), age.status == "error"
    print(json.dumps(record, default=str))
    return int(failed)


def main() -> None:
    args = parser().parse_args()
    spark = build_session()
    try:
        code = run(spark, args)
    finally:
        forget_settled(spark)
        spark.stop()
    sys.exit(code)


if __name__ == "__main__":
    main()
