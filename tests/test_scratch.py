"""Settled tables: where they go, what they keep, and when they leave."""

from __future__ import annotations

import os

import pytest

from daybook import scratch


def test_settled_tables_go_to_the_named_folder_and_can_be_forgotten(spark):
    scratch.forget_settled(spark)
    kept = scratch.settle(spark.range(10).selectExpr("id", "id % 3 AS k"), "kept")
    path = kept.inputFiles()[0].removeprefix("file://")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir") + "/daybook/kept-")
    assert kept.count() == 10 and os.path.exists(path)
    empty = scratch.settle(kept.limit(0), "empty")
    assert empty.isEmpty() and empty.columns == ["id", "k"]
    assert scratch.forget_settled(spark) == 2
    assert not os.path.exists(path)


def test_small_settled_sides_are_broadcast_by_their_real_size(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = scratch.settle(spark.range(10_000_000).filter("id < 5").withColumnRenamed("id", "k"))
    assert "BroadcastHashJoin" in big.join(small, "k")._jdf.queryExecution().executedPlan().toString()


class Cluster:
    """Stands in for a session on a cluster that names no folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"
        applicationId = "app"


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_folder(Cluster)


def test_null_safe_filter(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    keys = spark.createDataFrame([(1,), (None,)], "k int")
    semi = scratch.null_safe_filter(rows, keys, ["k"], "left_semi")
    anti = scratch.null_safe_filter(rows, keys, ["k"], "left_anti")
    assert {r.k for r in semi.collect()} == {1, None} and {r.k for r in anti.collect()} == {2}
