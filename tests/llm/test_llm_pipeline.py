"""The pipeline stage by stage, and the registered queries as a whole."""

from __future__ import annotations

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_tables import documents, odd_rows, prose
from test_llm_simhash import components, fingerprint
from test_llm_tokens import expected

import __spark_entry__ as entry_point
import corpus_pipeline
from daybook.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def staged(spark, sf, tmp_path_factory):
    """What every stage returns, written and read as the pipeline does."""
    folder, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out["start"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(folder / name))
        docs = out[name] = spark.read.parquet(str(folder / name))
    return out


def test_stages_return_documents(staged):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_dedup", "decontamination", "source_mix", "token_files"]
    for name in names[:-1]:
        assert staged[name].dtypes == staged["start"].dtypes


def test_each_stage_keeps_what_brute_force_keeps(spark, sf, staged):
    rows = {name: df.collect() for name, df in staged.items()}
    assert Counter(r.doc_id for r in rows["language_id"]) == Counter(
        r.doc_id for r in rows["start"] if any(c.isalpha() for c in r.text or "")
    )
    ids = [r.doc_id for r in rows["language_id"]]
    roots = components(ids, [fingerprint(r.text) for r in rows["language_id"]])
    assert sorted(r.doc_id for r in rows["simhash_dedup"]) == sorted(d for d, c in zip(ids, roots, strict=True) if d == c)
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in rows["simhash_dedup"] if not any(b in r.text for b in bench)]
    assert sorted(r.doc_id for r in rows["decontamination"]) == sorted(clean)
    taken = {r.doc_id: r for r in corpus_pipeline.mixed_documents(staged["decontamination"]).collect()}
    assert {r.doc_id for r in rows["source_mix"]} == set(taken)
    mixed = staged["source_mix"].selectExpr("doc_id", "text", "xxhash64(text) h").collect()
    mixed.sort(key=lambda r: (r.doc_id, r.h))
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows["token_files"]) == sorted(expected(mixed))


def test_run_gives_the_last_stage(spark, sf, staged):
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()))
    assert got == sorted(map(tuple, staged["token_files"].collect()))


def test_odd_rows_pass_all_stages(spark, sf):
    docs = documents(spark, odd_rows() + [(50 + k, prose(k)) for k in range(20)], clashes=True)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, sf), name)
        assert docs.columns == columns
    assert corpus_pipeline.token_files(spark, docs, sf).count() == docs.count()


def test_repeated_rows_stay_once(spark, sf):
    rows = [(1, prose(1)), (1, prose(1)), (2, prose(1)), (3, prose(3)), (3, prose(4)), (None, prose(5)), (None, None)]
    docs = documents(spark, rows)
    got = sorted((r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, sf).collect()), key=str)
    assert got == sorted([1, 3, None, None], key=str)


def test_empty_documents(spark, sf):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_registered_queries():
    names = entry_point.queries()
    for number in range(1, 14):
        assert len([n for n in names if n.startswith(f"op{number}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(r[c] for c in columns) for r in df.collect())
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())


def test_checksums_are_those_of_the_contract():
    assert zlib.crc32(np.array([5, 1], "<u4").tobytes()) == zlib.crc32(b"\x05\0\0\0\x01\0\0\0")
