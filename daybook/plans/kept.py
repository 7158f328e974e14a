"""A measure of the raw table that is kept and added to, instead of counted anew.

Beside the raw table lie the narrow bars of every load (key, file and fingerprint, by day),
the tickers seen, and the keys that came more than once with the files they came in. When a
load is taken up, only its own rows are read, and only the kept bars of the days it touches:
new keys and tickers are counted by anti joins with these, and its repeated keys are told
apart anew. A line of the measure ledger, written last, makes all of it count, and names the
loads it covers. A load whose take-up died is taken up by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.duplicates import KEY, classify_files, files_of_keys
from daybook.operators.measures import side_by_side
from daybook.schemas import KEPT_BARS, KEPT_REPEATS, KEPT_TICKERS, LOAD_LEDGER, MEASURE_LEDGER
from daybook.scratch import settle
from daybook.sources.day_files import among_days
from daybook.sources.ledger import append_ledger, path_exists, read_ledger


@dataclass
class KeptMeasure:
    """The kept measure of one raw table.

    ``loads`` gives the rows (ticker, trade_date, source_file, bar_hash) of the loads it is
    asked for, ``ledger`` is the load ledger, ``root`` the folder of what is kept. One
    writer at a time takes loads up, like the load that calls it.
    """

    spark: SparkSession
    loads: Callable[[list[str]], DataFrame]
    ledger: str
    root: str

    def missing(self) -> list[str]:
        """Committed loads that are not taken up yet: as a rule the one just made."""
        committed = read_ledger(self.spark, self.ledger, LOAD_LEDGER).filter("row_count > 0")
        taken = self._taken().select(F.explode("load_ids").alias("load_id"))
        rows = committed.select("load_id").distinct().join(taken, "load_id", "left_anti")
        return sorted(r.load_id for r in rows.collect())

    def take_up(self) -> int:
        """Add the committed loads that are missing; how many there were."""
        load_ids = self.missing()
        if not load_ids:
            return 0
        take = self._taken().count()
        name = uuid.uuid4().hex
        rows = self.loads(load_ids).groupBy(*KEY, "source_file", "bar_hash").agg(F.count("*").alias("n"))
        bars = settle(rows, "kept-bars")
        earlier = self._read("bars", KEPT_BARS)
        days = among_days(bars.filter("trade_date IS NOT NULL"), "trade_date")
        whole = bars.filter("ticker IS NOT NULL AND trade_date IS NOT NULL")
        earlier = earlier.filter(days if days is not None else F.lit(False))
        earlier = earlier.select("ticker", F.col("date").alias("trade_date"), "source_file", "bar_hash", "n")
        held = settle(earlier.join(whole.select(*KEY).distinct(), KEY, "left_semi"), "held-bars")

        seen = held.select(*KEY).distinct()
        keys = whole.select(*KEY).distinct().join(seen, KEY, "left_anti")
        tickers = bars.select("ticker").filter("ticker IS NOT NULL").distinct()
        tickers = settle(tickers.join(self._read("tickers", KEPT_TICKERS), "ticker", "left_anti"), "new-tickers")
        every = held.unionByName(whole.select(*held.columns))
        repeated = every.groupBy(*KEY).agg(F.sum("n").alias("loads"), F.countDistinct("bar_hash").alias("distinct_bars"))
        places = every.select(*KEY, "source_file").distinct()
        repeats = places.join(repeated.filter("loads > 1"), KEY).withColumn("take", F.lit(take))

        self._append("bars", bars.withColumnRenamed("trade_date", "date"), name, "date")
        self._append("tickers", tickers, name)
        self._append("repeats", repeats, name)
        totals = side_by_side(
            bars.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                F.min("trade_date").alias("first_day"),
                F.max("trade_date").alias("last_day"),
            ),
            keys.agg(F.count("*").alias("new_keys")),
            tickers.agg(F.count("*").alias("new_tickers")),
        )
        entry = totals.select(
            F.lit(name).alias("take_up"), F.array(*[F.lit(x) for x in load_ids]).alias("load_ids"), "*"
        )
        append_ledger(settle(entry, "measure"), self._path("ledger"), MEASURE_LEDGER)
        return len(load_ids)

    def measure(self) -> DataFrame:
        """What :func:`daybook.operators.measures.table_measure` gives of all loads taken up."""
        files = read_ledger(self.spark, self.ledger, LOAD_LEDGER).filter("row_count > 0")
        taken = self._taken()
        totals = taken.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_total"),
            F.coalesce(F.sum("new_keys"), F.lit(0)).alias("distinct_keys"),
            F.coalesce(F.sum("new_tickers"), F.lit(0)).alias("tickers"),
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
        )
        covered = taken.select(F.explode("load_ids").alias("load_id"))
        files = files.join(covered, "load_id", "left_semi").agg(F.countDistinct("source_file").alias("files_total"))
        return side_by_side(totals, files).select(
            "rows_total", "files_total", "distinct_keys", "tickers", "first_day", "last_day"
        )

    def classified(self) -> DataFrame:
        """What :func:`daybook.operators.duplicates.classify_duplicates` gives of all loads taken up.

        Of a repeated key the newest take-up knows all its files and fingerprints.
        """
        repeats = self._read("repeats", KEPT_REPEATS)
        newest = repeats.groupBy(*KEY).agg(F.max("take").alias("take"))
        current = repeats.join(newest, [*KEY, "take"], "left_semi")
        return classify_files(files_of_keys(current.select("source_file", *KEY, "loads", "distinct_bars")))

    def holders(self, keys: DataFrame) -> DataFrame:
        """Files of the loads taken up that hold any of ``keys``, none of which is null.

        Reads the kept bars of the days of ``keys`` only.
        """
        days = among_days(keys, "trade_date")
        bars = self._read("bars", KEPT_BARS).filter(days if days is not None else F.lit(False))
        bars = bars.select("ticker", F.col("date").alias("trade_date"), "source_file")
        return bars.join(keys.select(*KEY), KEY, "left_semi").select("source_file").distinct()

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _taken(self) -> DataFrame:
        return read_ledger(self.spark, self._path("ledger"), MEASURE_LEDGER)

    def _read(self, name: str, schema) -> DataFrame:
        """Rows of the take-ups that reached the measure ledger."""
        if not path_exists(self.spark, self._path(name)):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self._path(name))
        return rows.join(self._taken().select("take_up"), "take_up", "left_semi")

    def _append(self, name: str, rows: DataFrame, take_up: str, *by: str) -> None:
        marked = rows.withColumn("take_up", F.lit(take_up))
        marked.write.mode("append").partitionBy("take_up", *by).parquet(self._path(name))
