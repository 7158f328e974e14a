"""A fact table that is carried forward, instead of being windowed anew by each build.

A changed session alters the measures of its own ticker only, from that session to as many
sessions behind it as the longest frame reaches back. So the fact table lies in months, with
the lineage that orders a series, and beside it the rows of every ticker and month. From
these few numbers follows which months of a ticker are recomputed and how many months before
them feed the first frames. Only these months are read, and only months with recomputed rows
are written again, with the rows of all other tickers as they were. Months that are not
written again are carried over as they lie.

A line of the rolling ledger, written last, makes all months of a change count at once.
Readers see the change as a whole or not at all. There is one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.operators.duplicates import KEY
from daybook.operators.series import ROWS_PER_SLICE, SERIES_ORDER, YEAR_SESSIONS
from daybook.plans.kept import KeptMeasure
from daybook.plans.load import kept_measure, loads_of, read_raw
from daybook.plans.marts import measured_bars
from daybook.plans.staging import stg_prices
from daybook.schemas import FCT_DAILY_PRICES, LOAD_LEDGER, ROLLING_COUNTS, ROLLING_FACT, ROLLING_LEDGER
from daybook.scratch import null_safe_filter, null_safe_on, settle, settled_inside
from daybook.sources.ledger import append_ledger, path_exists, read_ledger

# Rows before and behind a change that a frame can hold together with it.
REACH = YEAR_SESSIONS - 1

# Rows without a date are the last of their series, so theirs is the last of the months.
NO_MONTH = 2**31 - 1

# What a stored row has beside its measures: all that windows need.
BARS = tuple(
    dict.fromkeys((*FCT_DAILY_PRICES[: FCT_DAILY_PRICES.index("prior_close")], *SERIES_ORDER))
)


def month_of(day: Column) -> Column:
    """Months since year 0, which sort like their days."""
    return F.coalesce(F.year(day) * 12 + F.month(day) - 1, F.lit(NO_MONTH)).cast("int")


def reaches(keys: DataFrame, counts: DataFrame) -> DataFrame:
    """(ticker, read_from, first, until) in months for every ticker of ``keys``.

    ``counts`` holds (ticker, month, rows) of before the change, which is true outside
    [first, last] after it too. From ``first`` to ``until`` rows are recomputed: a month
    behind the last change is, if fewer than :data:`REACH` rows lie between. Months from
    ``read_from`` on hold the rows before ``first`` that frames reach back to.
    """
    spans = keys.groupBy("ticker").agg(F.min("month").alias("first"), F.max("month").alias("last"))
    side = F.when(F.col("month") < F.col("first"), "before").when(F.col("month") > F.col("last"), "behind")
    held = counts.alias("counts").join(spans.alias("spans"), null_safe_on("counts", "spans", ["ticker"]))
    held = held.select("spans.*", "month", "rows", side.alias("side")).filter("side IS NOT NULL")
    away = F.abs(F.col("month").cast("long") - F.col("first"))
    nearer = Window.partitionBy("ticker", "side").orderBy(away).rowsBetween(Window.unboundedPreceding, -1)
    near = held.withColumn("between", F.coalesce(F.sum("rows").over(nearer), F.lit(0))).filter(F.col("between") < REACH)
    ends = near.groupBy("ticker").agg(
        F.min(F.when(F.col("side") == "before", F.col("month"))).alias("read_from"),
        F.max(F.when(F.col("side") == "behind", F.col("month"))).alias("until"),
    )
    return spans.alias("spans").join(ends.alias("ends"), null_safe_on("spans", "ends", ["ticker"]), "left").select(
        "spans.ticker", F.coalesce("read_from", "first").alias("read_from"), "first", F.coalesce("until", "last").alias("until")
    )


@dataclass
class RollingFact:
    """The fact table of one staging table, in months under ``root``."""

    spark: SparkSession
    root: str
    rows_per_slice: int = ROWS_PER_SLICE

    def read(self) -> DataFrame:
        """The fact table as of the last change that was completed."""
        return self._read("rows", ROLLING_FACT, self._current()).select(*FCT_DAILY_PRICES)

    def missing(self, ledger: str) -> list[str]:
        """Committed loads that the fact table does not cover yet."""
        committed = read_ledger(self.spark, ledger, LOAD_LEDGER).filter("row_count > 0")
        covered = self._lines().select(F.explode("load_ids").alias("load_id"))
        rows = committed.select("load_id").distinct().join(covered, "load_id", "left_anti")
        return sorted(r.load_id for r in rows.collect())

    def rebuild(self, stg: DataFrame, load_ids: Iterable[str] = ()) -> dict[str, list[int]]:
        """Make the whole table from a staging table."""
        with settled_inside(self.spark):
            rows = self._measured(settle(stg.select(*BARS), "series"))
            return self._commit([], self._current(), rows, load_ids)

    def refresh(self, keys: DataFrame, stg: DataFrame, load_ids: Iterable[str] = ()) -> dict[str, list[int]]:
        """Put the rows that ``stg`` holds of ``keys`` in place of those held so far.

        ``keys`` are (ticker, trade_date), either of which may be null, of all rows that
        were added, changed or taken away; a key without rows in ``stg`` is taken away.
        Other rows of ``stg`` are not looked at, so it may be the staging table or a part
        of it. Equals :meth:`rebuild` of the whole staging table. Returns the months read
        and written.
        """
        with settled_inside(self.spark):
            changed = keys.select(*KEY).distinct().withColumn("month", month_of(F.col("trade_date")))
            changed = settle(changed, "changed-keys")
            current = self._current()
            counts = self._read("counts", ROLLING_COUNTS, current)
            ranges = settle(reaches(changed, counts), "reaches")
            held = _of_tickers(counts, ranges, "read_from", "inner")
            months = held.select("month", (F.col("month") >= F.col("first")).alias("home"))
            months = months.unionByName(changed.select("month", F.lit(None).cast("boolean").alias("home")))
            # As many rows as the calendar has months, three times at most.
            found = months.distinct().collect()
            to_read = {r.month for r in found if r.home is not None}
            to_write = {r.month for r in found if r.home is not False}

            earlier = self._read("rows", ROLLING_FACT, current, to_read).select(*BARS, "month")
            earlier = _of_tickers(earlier, ranges, "read_from", "left_semi").drop("month")
            earlier = null_safe_filter(earlier, changed, list(KEY), "left_anti")
            added = null_safe_filter(stg.select(*BARS), changed, list(KEY), "left_semi")
            series = settle(earlier.unionByName(added), "series")
            fresh = _of_tickers(self._measured(series), ranges, "first", "left_semi")
            carried = self._read("rows", ROLLING_FACT, current, to_write)
            carried = _of_tickers(carried, ranges, "first", "left_anti")
            return self._commit(to_read, to_write, carried.unionByName(fresh), load_ids)

    def sweep(self) -> None:
        """Delete months that neither the last line of the ledger nor the one before names.

        What the last change replaced stays for readers that started before it. What a
        change left that died before its line goes too.
        """
        newest = self._lines().agg(F.max("number").alias("number")).first()["number"]
        if newest is None:
            return
        kept = {f"take={t}/month={m}" for n in (newest, newest - 1) for m, t in self._current(n).items()}
        takes = {name.split("/")[0] for name in kept}
        for kind in ("rows", "counts"):
            for take in self._names(f"{self.root}/{kind}"):
                if take not in takes:
                    self._delete(f"{self.root}/{kind}/{take}")
                    continue
                for month in self._names(f"{self.root}/{kind}/{take}"):
                    if month.startswith("month=") and f"{take}/{month}" not in kept:
                        self._delete(f"{self.root}/{kind}/{take}/{month}")

    def _measured(self, series: DataFrame) -> DataFrame:
        return measured_bars(series, self.rows_per_slice).withColumn("month", month_of(F.col("trade_date")))

    def _commit(
        self, read: Iterable[int], months: Iterable[int], rows: DataFrame, load_ids: Iterable[str]
    ) -> dict[str, list[int]]:
        """Write the rows of ``months``, and of other months that have rows, as one take."""
        take, number = uuid.uuid4().hex, self._lines().count()
        folder = f"{self.root}/rows/take={take}"
        # Written before it is ranged, as the sampling would compute the windows again.
        rows = settle(rows, "rolled")
        order = ("month", "ticker", *SERIES_ORDER)
        ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        ranged.write.partitionBy("month").parquet(folder)
        counts = rows.groupBy("ticker", "month").agg(F.count("*").alias("rows"))
        counts.hint("rebalance", F.col("month")).write.partitionBy("month").parquet(f"{self.root}/counts/take={take}")
        held = sorted(int(name.split("=")[1]) for name in self._names(folder) if name.startswith("month="))
        written = sorted({*months, *held})
        line = [(take, number, written, held, list(load_ids))]
        append_ledger(self.spark.createDataFrame(line, ROLLING_LEDGER), f"{self.root}/ledger", ROLLING_LEDGER)
        self.sweep()
        return {"read": sorted(read), "written": written}

    def _lines(self) -> DataFrame:
        return read_ledger(self.spark, f"{self.root}/ledger", ROLLING_LEDGER)

    def _current(self, number: int | None = None) -> dict[int, str]:
        """The take that holds each month, now or as of a line; as many as the calendar has."""
        lines = self._lines() if number is None else self._lines().filter(F.col("number") <= number)
        months = lines.select("number", "take", "held", F.explode("months").alias("month"))
        state = F.struct("take", F.array_contains("held", F.col("month")).alias("held"))
        newest = months.groupBy("month").agg(F.max_by(state, "number").alias("state"))
        return {r.month: r.state.take for r in newest.filter("state.held").collect()}

    def _read(
        self, kind: str, schema: str, current: dict[int, str], months: set[int] | None = None
    ) -> DataFrame:
        """The current rows of some or all months, from their own folders and no others."""
        due = sorted(current if months is None else months & set(current))
        base = f"{self.root}/{kind}"
        if not due:
            return self.spark.createDataFrame([], schema).drop("take")
        paths = [f"{base}/take={current[m]}/month={m}" for m in due]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).drop("take")

    def _names(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _of_tickers(rows: DataFrame, ranges: DataFrame, start: str, how: str) -> DataFrame:
    """Rows that lie, or with an anti join do not, in the months of their ticker's range.

    An inner join puts the first of these months beside them.
    """
    inside = F.col("rows.month").between(F.col(f"ranges.{start}"), F.col("ranges.until"))
    on = null_safe_on("rows", "ranges", ["ticker"]) & inside
    joined = rows.alias("rows").join(ranges.alias("ranges"), on, how)
    return joined.select("rows.*", "ranges.first") if how == "inner" else joined


@dataclass
class RawTable:
    """A raw table with its load ledger and the measure kept beside it."""

    spark: SparkSession
    raw: str
    ledger: str

    @property
    def kept(self) -> KeptMeasure:
        return kept_measure(self.spark, self.raw, self.ledger)

    def staging(self) -> DataFrame:
        return stg_prices(read_raw(self.spark, self.raw, self.ledger))

    def rows_of(self, files: DataFrame) -> DataFrame:
        """Raw rows of some files, from the loads that brought them."""
        entries = read_ledger(self.spark, self.ledger, LOAD_LEDGER).filter("row_count > 0")
        loads = entries.join(files, "source_file", "left_semi").select("load_id").distinct().collect()
        rows = read_raw(self.spark, self.raw, self.ledger, sorted(r.load_id for r in loads))
        return rows.join(files, "source_file", "left_semi")

    def keys_of(self, files: DataFrame) -> DataFrame:
        return settle(loads_of(self.rows_of(files)).select(*KEY).distinct(), "file-keys")

    def changed_bars(self, load_ids: list[str]) -> tuple[DataFrame, DataFrame] | None:
        """Keys whose staging rows some loads may have changed, and these rows as they are now.

        A load changes its own keys, and by a revision what is kept of the files that hold
        them: all keys of these files. To judge the rows of those keys, the files that hold
        them are judged, which takes all loads of all their keys. As a rule each of these
        steps names the same files. Needs a kept measure that covers the loads. ``None`` if
        a key is null in one of the files, as such rows are judged together over all files.
        """
        own = settle(loads_of(read_raw(self.spark, self.raw, self.ledger, load_ids)).select(*KEY).distinct(), "own-keys")
        if _has_null(own):
            return None
        files = settle(self.kept.holders(own), "files")
        affected = keys = self.keys_of(files)
        if _has_null(keys):
            return None
        judged = settle(self.kept.holders(affected), "judged-files")
        if not judged.join(files, "source_file", "left_anti").isEmpty():
            keys = self.keys_of(judged)
            if _has_null(keys):
                return None
            files = settle(self.kept.holders(keys), "files-of-judged")
        rows = stg_prices(self.rows_of(files))
        return affected, rows.join(affected, list(KEY), "left_semi")


def _has_null(keys: DataFrame) -> bool:
    return not keys.filter("ticker IS NULL OR trade_date IS NULL").isEmpty()


def roll_loads(table: RawTable, fact: RollingFact) -> dict[str, list[int]]:
    """Bring the fact table up to the committed loads; months read and written.

    Reads the raw rows of the files that the new loads concern, and the months around
    their days. The first time, and where a key is null, the table is made whole.
    """
    with settled_inside(table.spark):
        due = fact.missing(table.ledger)
        if not due:
            return {"read": [], "written": []}
        table.kept.take_up()
        first = not path_exists(table.spark, f"{fact.root}/ledger")
        changed = None if first else table.changed_bars(due)
        if changed is None:
            return fact.rebuild(table.staging(), due)
        return fact.refresh(*changed, due)
