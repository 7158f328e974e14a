"""The registered queries of the operators, and the SQL twins of those SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import toxicity
from daybook.llm.decontamination import judged
from daybook.llm.fingerprints import compare_with_next
from daybook.llm.hard_negatives import hard_negatives
from daybook.llm.language_id import held_out, identify, learn_profiles
from daybook.llm.licenses import scan_licenses
from daybook.llm.mixing import mixture
from daybook.llm.ngram_join import ngram_components
from daybook.llm.periodic_runs import periodic_runs
from daybook.llm.simhash import near_duplicates
from daybook.llm.substring_dedup import repeated_passages
from daybook.llm.token_counts import recount, with_trees
from daybook.llm.token_files import packed

Query = Callable[[SparkSession, str], DataFrame]

# Vocabulary files; every machine has them under the same path.
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without passages of 13 words that documents with smaller ids hold."""
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op1_substring_dedup"] = r"""
WITH tokens AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, pos, list_aggregate(words[pos:pos + 12], 'string_agg', ' ') AS seq
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM tokens WHERE len(words) > 12)
), firsts AS (
    SELECT seq, min(doc_id) AS first_doc FROM windows GROUP BY seq HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos
    FROM windows JOIN firsts USING (seq) WHERE first_doc < doc_id
), lost AS (
    SELECT doc_id, list(pos) AS gone_at, count(*) AS n_removed FROM gone GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(list_aggregate(CASE WHEN gone_at IS NULL THEN words ELSE
           list_transform(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(gone_at, i)), lambda i: words[i])
       END, 'string_agg', ' '), '')) AS kept_sha256
FROM tokens LEFT JOIN lost USING (doc_id)
"""


@query
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of four-word shingles, linked at four differing bits."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed at weights 1, 2, 3, repeating, and three epochs at most."""
    mixed = mixture(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op9_mix_sources"] = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS place
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap
    FROM sources
), levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM weighted
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
    SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM levels
), rests AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM goals
), ordered AS (
    SELECT s.doc_id, s.size, g.source_size, g.target, g.whole,
           round(g.target - g.whole * g.source_size) AS rest,
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM sized s JOIN rests g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + least(greatest(rest - below, 0), size))::BIGINT AS taken
FROM ordered
"""


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("templates")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by profiles learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn_profiles(docs))
    return found.withColumn("held_out", held_out(F.col("doc_id")))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a lexicon learned from labels not held out."""
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return found.withColumn("held_out", held_out(F.col("doc_id")))


@query
def op8_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrase fingerprints of all documents, their edited texts and their neighbours."""
    return compare_with_next(table(spark, sf_dir, "documents"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as ids, written to grammar-compressed files and read back."""
    read = packed(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, and after three edits drawn from each text.

    The edits replace ten characters in the middle by the first twelve, drop the
    first five, and add the source's name at the end.
    """
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    length = F.char_length(text).cast("long")
    change = "struct<start:bigint,removed:bigint,inserted:string>"
    edits = [
        F.struct(F.floor(length / 2), F.lit(10), F.substring(text, 1, 12)),
        F.struct(F.lit(0), F.lit(5), F.lit("")),
        F.struct(length + 100, F.lit(0), F.concat(F.lit(" "), F.coalesce("source", F.lit("")))),
    ]
    rows = docs.select("doc_id", "text", F.array(*[e.cast(change) for e in edits]).alias("edits"))
    counted = recount(with_trees(rows, BYTE_VOCABULARY), BYTE_VOCABULARY)
    return counted.drop("edited", "edited_tree")


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold items of the benchmark, values changed or not."""
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh vector's label is wrong by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), "vec_id % 100 = 0")


ORACLES["op11_hard_negatives"] = r"""
WITH rounded AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
           list_inner_product(a.vector, r.vector)::BIGINT AS score
    FROM rounded a JOIN rounded r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), windows AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
    FROM positives p JOIN scored s
      ON p.anchor_id = s.anchor_id AND NOT s.same
     AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 5
"""


def _periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which words of every tenth document, by a hash of its id, stand in its words' places."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    places = np.arange(n)
    places[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return places


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in all documents, a tenth of which get a periodic tail."""
    found = periodic_runs(table(spark, sf_dir, "documents"), rewrite=_periodic_tail)
    # Runs are in the order of start and period, so the first of equal exponents stays.
    best = F.expr(
        """aggregate(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>), (best, r) ->
               CASE WHEN best IS NULL OR best.length * r.period < r.length * best.period THEN r ELSE best END)"""
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


@query
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by a Jaccard similarity of 0.8 or more of their five-word shingles."""
    return ngram_components(table(spark, sf_dir, "documents"))


ORACLES["op12_ngram_join"] = r"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 5
        THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
    FROM tokens
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * met >= 80 * (x.n + y.n - met)
), reached AS (
    SELECT doc_id, doc_id AS other FROM tokens
    UNION
    SELECT doc_id, b FROM reached JOIN links ON other = a
)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM tokens t LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r ON t.doc_id = r.doc_id
"""
