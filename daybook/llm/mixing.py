"""Mixing sources to target weights by capped water-filling.

Sources share a total by weight. A source that would be repeated more often than
allowed is clamped there, and what it leaves is shared by the others in proportion
to their weights until none is above its cap. Clamping in the order of cap by
weight reaches that state in one pass over the sources.

A document is repeated as often as its source's target holds its source, and the
rest of the target goes to documents in a seeded order: whole ones first, then the
first words of the one that would exceed it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.scratch import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"

# Bins of the seeded order of a source; only rows of one bin are ever sorted.
BINS = 4096


def targets(sized: DataFrame, weights: tuple = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from rows (source, size); one row per source.

    Weights go round the sources in code point order, null last.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), place.cast("int") + 1)
    sources = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    open_words = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    sources = sources.withColumn("level", open_words.cast("double") / open_weight)
    level = F.max("level").over(everything)
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies, part) of every row.

    ``taken`` words are those of ``copies`` whole documents and of the first ``part``
    words. The words a source gives add up to its target, rounded. Size counts words;
    a null text has none. Sources without words have target 0. Rows with equal ids, or
    without one, are ordered by size, then by a hash of the text; reruns agree. An empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        _place(F.col(id_col), seed).alias("place"),
        F.xxhash64(F.col(text_col)).alias("hash"),
    )
    sized = settle(_numbered(sized.withColumn("bin", _bin(F.col("place")))), "sized")
    return _dealt(sized, _sources(sized, weights, epochs)).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "copies", "part"
    )


def mixed_documents(
    docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """The documents of a mixture, with the columns of ``docs``, copies as rows of their own.

    A part of a document keeps its first words, joined by one space; ``n_chars``
    follows where there is such a column. Rows that the mixture does not take go, and
    so do rows without words, of which there is nothing to take. Each source gives as
    many words as in ``mixture``, also where rows share an id, have none, or are repeated:
    of rows with equal ids, sizes and texts any may be the one that is taken. An empty
    table gives an empty result, and columns may have any names.
    """
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    place = _place(F.col("doc_id"), seed)
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"),
        "source",
        size.alias("size"),
        place.alias("place"),
        F.xxhash64("text").alias("hash"),
    ).withColumn("bin", _bin(F.col("place")))
    sized = settle(rows.select("source", "size", "place", "bin"), "sized")
    sources = _sources(sized, weights, epochs)
    of = sources.select(F.col("source").alias("of"), "whole", "edge")
    rows = rows.join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    inner = rows.filter("bin <> edge").withColumn("extra", _extra("size", "bin", "edge"))
    # Only documents of the bins in which rests end are written, to have numbers of their own.
    edge = settle(_numbered(rows.filter("bin = edge")), "edge")
    extras = _edge(edge.drop("doc", "whole", "edge"), sources).select("row", "extra")
    rows = inner.unionByName(edge.join(extras, "row").select(*inner.columns))
    more = F.col("extra")
    full = (more == F.col("size")) & (F.col("size") > 0)
    copies = (F.col("whole") + F.when(full, 1).otherwise(0)).cast("int")
    # A row for each copy, marked -1, and one with the number of words of a part.
    part = F.when(~full & (more > 0), F.array(more.cast("int"))).otherwise(F.array().cast("array<int>"))
    copies = F.when(F.col("size") > 0, copies).otherwise(0)
    rows = rows.select("doc", F.explode(F.concat(F.array_repeat(F.lit(-1), copies), part)).alias("part"))
    whole = F.col("part") < 0
    words = F.filter(F.split("doc.text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.array_join(F.slice(words, 1, F.greatest(F.col("part"), F.lit(0))), " ")
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return rows.select(
        *[
            (F.when(whole, F.col(f"doc.`{c}`")).otherwise(changed[c]) if c in changed else F.col(f"doc.`{c}`")).alias(c)
            for c in docs.columns
        ]
    )


def _place(doc_id: Column, seed: str) -> Column:
    """Where a document stands in the seeded order of its source."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _bin(place: Column) -> Column:
    return F.conv(F.substring(place, 1, 3), 16, 10).cast("int")


def _sources(sized: DataFrame, weights: tuple, epochs: int) -> DataFrame:
    """Targets with whole repetitions, the words beyond them, and the bin these end in."""
    sources = targets(sized, weights, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("whole", whole)
    rest = F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    sources = sources.withColumn("rest", rest)
    bins = sized.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("below", F.coalesce(F.sum("words").over(before), F.lit(0)))
    bins = bins.withColumnRenamed("source", "of")
    ends = bins.join(sources, F.col("of").eqNullSafe(F.col("source")))
    ends = ends.filter("below <= rest").groupBy("source").agg(F.max(F.struct("bin", "below")).alias("end"))
    ends = ends.select(F.col("source").alias("of"), F.col("end.bin").alias("edge"), F.col("end.below").alias("below"))
    joined = sources.join(ends, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    return settle(joined, "sources")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number of their own, once they are written, and the task that wrote them."""
    return rows.withColumn("row", F.monotonically_increasing_id()).withColumn("task", F.spark_partition_id())


def _edge(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of the bin a source's rest ends in, with the words each gives beyond whole copies.

    In the order of place, size, text and number. Groups of equal rows are summed first:
    those before the one in which the rest ends give all words, those behind it none, and
    only that one is looked into, so no group, however large, is sorted.
    """
    of = sources.select(F.col("source").alias("of"), "edge", (F.col("rest") - F.col("below")).alias("left"))
    rows = rows.join(of, F.col("of").eqNullSafe(F.col("source")) & (F.col("bin") == F.col("edge")))
    rows = settle(rows.select("source", "size", "place", "hash", "task", "row", "left"), "ends")
    decided = []
    for level in (["place", "size"], ["hash"], ["task"], ["row"]):
        groups = rows.groupBy("source", *level).agg(F.sum("size").alias("words"))
        before = Window.partitionBy("source").orderBy(*level).rowsBetween(Window.unboundedPreceding, -1)
        groups = groups.withColumn("below", F.coalesce(F.sum("words").over(before), F.lit(0))).alias("groups")
        same = F.col("rows.source").eqNullSafe(F.col("groups.source"))
        for name in level:
            same &= F.col(f"rows.{name}") == F.col(f"groups.{name}")
        rows = rows.alias("rows").join(groups, same).select("rows.*", "words", "below")
        left = F.col("left") - F.col("below")
        extra = F.when(left >= F.col("words"), F.col("size")).when(left <= 0, F.lit(0))
        if level == ["row"]:
            extra = F.coalesce(extra, left)
        rows = settle(rows.withColumns({"extra": extra, "left": left}).drop("words", "below"), "ends")
        decided.append(rows.filter("extra IS NOT NULL"))
        rows = rows.filter("extra IS NULL").drop("extra")
    return reduce(DataFrame.unionByName, decided).select("row", "extra")


def _extra(size: str, bin_: str, edge: str) -> Column:
    """Words beyond whole copies: all of a row before the edge bin, none of one behind it."""
    return F.when(F.col(bin_) < F.col(edge), F.col(size)).otherwise(F.lit(0))


def _dealt(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Every row with its copies, its part and the words taken."""
    of = sources.withColumnRenamed("source", "of")
    rows = sized.join(of, F.col("of").eqNullSafe(F.col("source")))
    inner = rows.filter("bin <> edge").withColumn("extra", _extra("size", "bin", "edge"))
    edge = rows.filter("bin = edge").join(_edge(sized, sources), "row")
    rows = inner.unionByName(edge.select(*inner.columns))
    full = (F.col("extra") == F.col("size")) & (F.col("size") > 0)
    return rows.withColumns(
        {
            "taken": (F.col("whole") * F.col("size") + F.col("extra")).cast("long"),
            "copies": F.when(F.col("size") > 0, F.col("whole") + F.when(full, 1).otherwise(0))
            .otherwise(0)
            .cast("long"),
            "part": F.when(full, F.lit(0)).otherwise(F.col("extra")).cast("long"),
        }
    )
