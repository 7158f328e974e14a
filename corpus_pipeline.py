"""The corpus pipeline: five stages from raw documents to token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the documents of the next one. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.decontamination import decontaminated
from daybook.llm.language_id import keep_recognised, learn_profiles
from daybook.llm.mixing import mixed_documents
from daybook.llm.queries import WORD_TOKENIZER, table
from daybook.llm.simhash import near_duplicates
from daybook.llm.token_files import packed
from daybook.scratch import settle


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language: without letters, or like no learned profile, they go."""
    return keep_recognised(docs, learn_profiles(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of rows that share an id one stays, the first by its text's hash. Rows without an
    id stay, as no group can name them.
    """
    found = settle(near_duplicates(docs), "groups")
    surplus = found.filter("component_id < doc_id").select(F.col("doc_id").alias("surplus")).distinct()
    surplus = settle(surplus, "surplus")
    kept = docs.join(surplus, docs["doc_id"] == surplus["surplus"], "left_anti")
    shared = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    shared = settle(shared.filter("n > 1").select(F.col("doc_id").alias("shared")), "shared")
    if shared.isEmpty():
        return kept
    once = kept.join(shared, kept["doc_id"] == shared["shared"], "left_anti")
    often = kept.join(shared, kept["doc_id"] == shared["shared"], "left_semi")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), F.xxhash64(*docs.columns))
    first = often.select(*docs.columns, F.row_number().over(order).alias("order_among_rows"))
    first = first.filter("order_among_rows = 1")
    return once.select(*docs.columns).unionByName(first.select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at their sources' target weights; a repetition is a row of its own."""
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files of the mixture hold, read back from them."""
    read = packed(docs, WORD_TOKENIZER)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

# SQL expresses neither XXH64 with a majority of bits nor a trained tokenizer; tests hold
# the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
