"""Intermediate tables in the shared folder the cluster names.

A settled table cuts lineage, survives the loss of executors, and gives Catalyst
the real size of what was written: the planner then broadcasts a side only when
that measured size is below ``spark.sql.autoBroadcastJoinThreshold``. No join in
this package carries a broadcast hint.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folder: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def scratch_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/daybook"
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="daybook-")
    return _own_folder[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch folder that no other write uses."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settled_path(spark: SparkSession, label: str) -> str:
    """A scratch path for files that are written by other means and deleted like settled tables."""
    path = scratch_path(spark, label)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def settle(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet and continue from the written files."""
    spark = df.sparkSession
    path = settled_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_settled(spark: SparkSession) -> int:
    """Delete the tables this session settled, once no DataFrame on them is needed."""
    return _forget(spark, _written.pop(spark.sparkContext.applicationId, []))


@contextmanager
def settled_inside(spark: SparkSession) -> Iterator[None]:
    """Delete what is settled inside the block when it ends, also by an error.

    For steps whose result is a value or a written table. What was settled before stays.
    """
    app = spark.sparkContext.applicationId
    before = len(_written.get(app, []))
    try:
        yield
    finally:
        own = _written.get(app, [])[before:]
        del _written.get(app, [])[before:]
        _forget(spark, own)


def _forget(spark: SparkSession, paths: list[str]) -> int:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)


def null_safe_on(left: str, right: str, columns: list[str]) -> Column:
    """Equality on every column of two aliased sides, with null equal to null."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def null_safe_filter(rows: DataFrame, keys: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Semi or anti join that, unlike plain equality, also matches null keys."""
    return rows.alias("rows").join(
        keys.alias("keys"), null_safe_on("rows", "keys", columns), how
    )
