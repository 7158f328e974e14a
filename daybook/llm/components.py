"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.scratch import settle


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``edges``; a component is its smallest node.

    Alternates the large-star and small-star steps until no edge changes. Each round
    is written to the shared folder, so lineage stays short and lost executors cost
    one round at most. Self-loops and repeated edges do no harm; null ends are left out.
    """
    high, low = F.greatest(a, b), F.least(a, b)
    edges = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = settle(edges.select(high.alias("a"), low.alias("b")).filter("a > b").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        roots = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(roots, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        edges = settle(small.select("e.a", "e.b").filter("a > b").distinct(), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select("component", "component").distinct())


def _state(edges: DataFrame) -> tuple:
    """What tells two edge tables apart: their number and a sum of hashes."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())
