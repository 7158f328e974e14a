"""Token files and token counts: round trips against the tokenizers themselves."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_tables import documents, odd_rows, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daybook.llm import token_counts, token_files
from daybook.llm.queries import BYTE_VOCABULARY, QUERIES, WORD_TOKENIZER
from daybook.llm.token_counts import Counter, Tree, count_tokens, edit, recount, with_trees
from daybook.llm.token_files import Shard, WordEncoder, compress, packed, read_tokens, write_tokens

TOKENIZER = Tokenizer.from_file(WORD_TOKENIZER)
with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
PLAIN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})

ODD_TEXTS = [
    "", " ", "a", "A.", "a. b", "a.b", "3. 4.", "x,y, z,", "é. É, ", "don't can't. 's 't", "<|endoftext|> a.", "<|EndOfText|> A.",
    "<|startoftext|>x y", "İK ſ", "é é", " 　a", "\U0001f600. ok.", "a  b   c\t\n d ", "...", ". , .", "漢字 漢字。", "I'LL, we'll. they'll,",
]


def word_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_words_encode_like_whole_texts():
    encoder = WordEncoder(WORD_TOKENIZER)
    texts = ODD_TEXTS + [prose(k, 50) for k in range(5)] + ODD_TEXTS
    for own in (texts, [t.upper() for t in texts if "<|" not in t], [t + "." for t in texts]):
        ids, counts = encoder.encode(pa.array(own))
        ends = np.cumsum(counts)
        for text, a, b in zip(own, ends - counts, ends, strict=True):
            assert ids[a:b].tolist() == word_ids(text), text


def test_encoder_forgets_in_time(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 5)
    monkeypatch.setattr(token_files, "ENCODED_AT_ONCE", 3)
    encoder = WordEncoder(WORD_TOKENIZER)
    for k in range(6):
        text = prose(k, 20)
        assert encoder.encode(pa.array([text, None]))[0].tolist() == word_ids(text)


def sequences():
    rng = np.random.default_rng(3)
    yield np.zeros(0, np.uint32)
    yield np.array([1], np.uint32)
    yield np.full(3000, 7, np.uint32)
    yield np.full(3000, 1, np.uint32)
    yield np.tile([5, 6, 5, 7, 1], 900).astype(np.uint32)
    yield (rng.zipf(1.3, 40_000) % 49_000).astype(np.uint32)
    yield np.r_[(rng.zipf(1.2, 30_000) % 300), 70_000].astype(np.uint32)


@pytest.mark.parametrize("ids", sequences())
def test_compression_round_trip(ids):
    data = compress(ids)
    shard = Shard(data)
    assert shard.ids().tolist() == ids.tolist()
    rng = random.Random(1)
    for _ in range(30):
        a, b = sorted(rng.randrange(len(ids) + 1) for _ in range(2))
        assert shard.ids(a, b).tolist() == ids[a:b].tolist()
    assert len(shard.lengths) == len(shard.rules)


def test_rules_stay_inside_documents_and_save_space():
    ids = np.tile([5, 6, 7, 1, 9, 9, 8, 1], 2000).astype(np.uint32)
    shard = Shard(compress(ids))
    assert len(compress(ids)) < 2 * len(ids) / 3 + 100
    ends = set(np.cumsum([4] * 4000).tolist())
    assert ends <= set(shard.ends.tolist())


def test_long_repeats_become_one_rule():
    rng = np.random.default_rng(5)
    passage = rng.integers(5, 30_000, 300)
    copies = [np.r_[rng.integers(5, 30_000, 40), passage, 1] for _ in range(60)]
    same = np.r_[np.full(100_000, 7), 1]
    for ids, longest, symbols in ((np.concatenate(copies), 300, 60 * 42 + 60), (same, 1 << 11, 60)):
        shard = Shard(compress(ids))
        assert np.array_equal(shard.ids(), ids)
        assert shard.lengths.max() >= longest and len(shard.sequence) <= symbols


def expected(rows):
    """(doc_id, start, n_tokens, crc) in file order; the hash of the text breaks ties."""
    out, start = [], 0
    for r in rows:
        ids = [*word_ids(r.text), 1]
        out.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard", [50, 1 << 20])
def test_files_hold_whole_documents_in_order(spark, monkeypatch, shard):
    monkeypatch.setattr(token_files, "SHARD_IDS", shard)
    monkeypatch.setattr(token_files, "FILE_BYTES", 10_000)
    rows = odd_rows() + [(100 - k, t) for k, t in enumerate(ODD_TEXTS)]
    docs = documents(spark, rows, clashes=True)
    got = packed(docs, WORD_TOKENIZER).withColumn("crc", F.crc32("ids")).drop("ids").collect()
    order = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    order.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(order)


def test_query_over_given_documents(spark, sf):
    got = sorted(map(tuple, QUERIES["op6_token_files"](spark, sf).collect()))
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    assert got == expected(docs)


def test_empty_table(spark, tmp_path):
    write_tokens(documents(spark, []), str(tmp_path / "tokens"), WORD_TOKENIZER)
    assert read_tokens(spark, str(tmp_path / "tokens")).collect() == []


def length(text):
    return len(PLAIN.encode_ordinary(text or ""))


@pytest.mark.parametrize("leaf", [8, 64])
def test_random_edits_equal_counting_anew(leaf, monkeypatch):
    monkeypatch.setattr(token_counts, "LEAF_BYTES", leaf)
    counter = Counter(*BYTE_VOCABULARY)
    rng = random.Random(leaf)
    bits = [" ", "  ", "a", "'s", "\n", "é", " ß", "12", "word", " word", "　", "!", "漢", " it's", "\U0001f600", " "]
    for trial in range(150):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(60)))
        text = text if trial % 3 else f"{prose(trial, 40)} {text} {prose(trial + 1, 40)}"
        data = np.frombuffer(text.encode(), np.uint8)
        tree = token_counts._leaves(data, counter)
        assert int(tree.tokens[1]) == length(text)
        for _ in range(6):
            start, removed = rng.randrange(len(text) + 3), rng.randrange(12)
            inserted = "".join(rng.choice(bits) for _ in range(rng.randrange(5)))
            change = {"start": start, "removed": removed, "inserted": inserted}
            data, _ = edit(data, tree, change, counter)
            text = text[: min(start, len(text))] + inserted + text[min(start + removed, len(text)) :]
            assert data.tobytes().decode() == text
            assert (int(tree.tokens[1]), int(tree.size[1])) == (length(text), len(data)), text
            tree = Tree.load(tree.dump())


def test_edits_encode_little_of_a_long_text():
    counter = Counter(*BYTE_VOCABULARY)
    text = prose(1, 50_000)
    data = np.frombuffer(text.encode(), np.uint8)
    tree = token_counts._leaves(data, counter)
    data, encoded = edit(data, tree, {"start": 100_000, "removed": 5, "inserted": "new"}, counter)
    assert encoded < 5 * token_counts.LEAF_BYTES
    assert int(tree.tokens[1]) == length(text[:100_000] + "new" + text[100_005:])


def test_odd_rows_count_like_the_tokenizer(spark):
    docs = documents(spark, odd_rows(), clashes=True)
    got = sorted(((r.doc_id, r.n_tokens) for r in count_tokens(docs, BYTE_VOCABULARY).collect()), key=str)
    assert got == sorted(((r[0], length(r[1])) for r in odd_rows()), key=str)
    kind = f"array<{token_counts.EDIT}>"
    none = docs.withColumn("edits", F.lit(None).cast(kind)).withColumn("tree", F.lit(None).cast("binary"))
    assert all(r.n_tokens == r.n_tokens_edited for r in recount(none, BYTE_VOCABULARY).collect())
    assert with_trees(documents(spark, []).withColumn("edits", F.lit(None).cast(kind)), BYTE_VOCABULARY).count() == 0


def test_count_query_equals_counting_anew(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        middle = len(r.text) // 2
        text = r.text[:middle] + r.text[:12] + r.text[middle + 10 :]
        text = text[5:] + " " + (r.source or "")
        own = got[r.doc_id]
        assert (own.n_tokens, own.n_tokens_edited) == (length(r.text), length(text))
        assert own.edited_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_nothing_settled_stays_behind(spark):
    """The token files of the shared folder go with what was settled."""
    from pathlib import Path

    from daybook.scratch import forget_settled, scratch_folder

    forget_settled(spark)
    before = set(Path(scratch_folder(spark)).glob("*"))
    assert packed(documents(spark, [(1, "one two")]), WORD_TOKENIZER).count() == 1
    forget_settled(spark)
    assert set(Path(scratch_folder(spark)).glob("*")) == before
