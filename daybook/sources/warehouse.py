"""Tables by name, one schema per layer, replaced as a whole."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Which layer a table belongs to. Layer names are used as they are.
LAYERS = {
    "raw_prices": "raw",
    "ticker_reference": "staging",
    "stg_prices": "staging",
    "dim_tickers": "marts",
    "fct_daily_prices": "marts",
}

@dataclass
class Warehouse:
    """Resolves table names to ``schema.table`` in the session's catalog.

    Every save writes a new version directory and then points the table at it, so
    a build that dies half-way leaves the previous table readable. A session whose
    catalog does not know a table yet registers its newest complete version.
    ``prefix`` separates several warehouses in one catalog, ``root`` is where the
    files go, and ``views`` puts a DataFrame in place of a table.
    """

    spark: SparkSession
    prefix: str = ""
    root: str | None = None
    views: dict[str, DataFrame] = field(default_factory=dict)

    def qualified(self, name: str) -> str:
        return f"{self.prefix}{LAYERS[name]}.{name}"

    def folder(self, name: str) -> str:
        root = self.root or self.spark.conf.get("spark.sql.warehouse.dir")
        return f"{root.rstrip('/')}/{self.prefix}{LAYERS[name]}/{name}"

    def table(self, name: str) -> DataFrame:
        if name in self.views:
            return self.views[name]
        self._register_newest(name)
        return self.spark.table(self.qualified(name))

    def exists(self, name: str) -> bool:
        if name in self.views:
            return True
        self._register_newest(name)
        return self.spark.catalog.tableExists(self.qualified(name))

    def save(self, name: str, df: DataFrame) -> None:
        """Replace a table with the rows in the partitions they come in.

        Nothing is shuffled or sorted for the write. The windows behind the fact
        table leave every file in ticker and date order, so a filter on either
        skips row groups; readers who want a total order ask for it.
        """
        earlier = self._versions(name)
        version = datetime.datetime.now(datetime.timezone.utc).strftime("v%Y%m%dT%H%M%S%f")
        df.write.parquet(f"{self.folder(name)}/{version}")
        self._point(name, version)
        # The version before stays for readers that started on it.
        for old in earlier[:-1]:
            path = self._path(f"{self.folder(name)}/{old}")
            self._files(path).delete(path, True)

    def _point(self, name: str, version: str) -> None:
        """Make the catalog's table read a version directory."""
        location = f"{self.folder(name)}/{version}"
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{LAYERS[name]}")
        table = self.qualified(name)
        if self.spark.catalog.tableExists(table):
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            self.spark.catalog.refreshTable(table)
        else:
            schema = self.spark.read.parquet(location).schema
            self.spark.catalog.createTable(table, path=location, source="parquet", schema=schema)

    def _register_newest(self, name: str) -> None:
        if not self.spark.catalog.tableExists(self.qualified(name)):
            versions = self._versions(name)
            if versions:
                self._point(name, versions[-1])

    def _versions(self, name: str) -> list[str]:
        """Complete versions, oldest first."""
        folder = self._path(self.folder(name))
        files = self._files(folder)
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(n for n in names if files.exists(self._path(f"{self.folder(name)}/{n}/_SUCCESS")))

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())
