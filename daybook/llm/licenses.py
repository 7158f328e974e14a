"""License scan by a positional rare-token index, in DataFrame operations only.

Licence notices are templates, indexed by words and positions. The words of each
template's key phrase are ranked by inverse document frequency over all documents, and
only the rarest are looked up in a file. Hits of one template agree when position in
the file minus position in the template is the same; where all of them agree, the
whole key phrase must stand at its place. As the phrase is mandatory, its rarest words
lose no place where it stands, however many other licence words a file has.

A file can only match where it has all words of some key or base phrase, so the
others never leave the first pass with more than their licence words.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import product
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.scratch import settle

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rarest words of a key phrase that are looked up and must agree on a place.
AGREE = 2

# Base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Usual notices as (label, notice, key phrase that must stand in place).
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "licensed under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by", "this work is licensed under cc by 4 0", "cc by 4 0"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0 universal"),
    ("reserved", "copyright all rights reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    ("apache-2.0", "licensed under the apache license 2 0", "apache license 2 0"),
    ("apache-2.0", "released under the apache 2 0 license", "apache 2 0 license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("isc", "released under the isc license", "isc license"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software", "will the authors be held liable for any damages"),
    ("bsl-1.0", "distributed under the boost software license version 1 0", "boost software license"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("gfdl", "under the terms of the gnu free documentation license", "gnu free documentation license"),
    ("ofl", "licensed under the sil open font license version 1 1", "open font license"),
    ("odbl", "made available under the open database license", "open database license"),
)

# How the conditions of a Creative Commons licence are written.
CONDITIONS = {
    "nc": ("noncommercial", "non commercial"),
    "nd": ("noderivatives", "noderivs", "no derivatives", "no derivs"),
    "sa": ("sharealike", "share alike"),
}
VARIANTS = (("nc",), ("nd",), ("sa",), ("nc", "nd"), ("nc", "sa"))

# Identifiers of the SPDX list, and their labels.
IDENTIFIERS = {
    "mit": "mit",
    "apache 2 0": "apache-2.0",
    "gpl 2 0": "gpl",
    "gpl 3 0": "gpl",
    "lgpl 2 1": "lgpl",
    "lgpl 3 0": "lgpl",
    "agpl 3 0": "agpl",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "mpl 2 0": "mpl-2.0",
    "isc": "isc",
    "epl 1 0": "epl",
    "epl 2 0": "epl",
    "zlib": "zlib",
    "bsl 1 0": "bsl-1.0",
    "unlicense": "unlicense",
    "cc0 1 0": "cc0",
    "cc by 4 0": "cc-by",
    "cc by sa 4 0": "cc-by-sa",
    "cc by nc 4 0": "cc-by-nc",
}

# Phrases that begin with the same so many words, from so many on, let a file in by these.
GATE_WORDS, GATE_SHARED = 3, 4


def _variants() -> list[tuple[str, str, str]]:
    """The notices of Creative Commons licences with conditions, however these are written."""
    found = []
    for conditions in VARIANTS:
        short = " ".join(conditions)
        label = "cc-by-" + "-".join(conditions)
        for written in product(*[CONDITIONS[c] for c in conditions]):
            key = f"creative commons attribution {' '.join(written)}"
            found.append((label, f"licensed under a {key} 4 0 international license", key))
        found.append((label, f"this work is licensed under cc by {short}", f"cc by {short}"))
    return found


def _tagged() -> list[tuple[str, str, str]]:
    """The lines that name a licence by its SPDX identifier."""
    lines = {f"spdx license identifier {name}": label for name, label in IDENTIFIERS.items()}
    return [(label, line, line) for line, label in lines.items()]


# What is looked for: the notices above, all variants, and all identifiers.
KNOWN = (*TEMPLATES, *_variants(), *_tagged())


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple = KNOWN,
    base: dict[str, str] = BASE,
) -> DataFrame:
    """Licence labels of every row.

    Words are runs of ASCII letters and digits, A-Z lowered, and of characters beyond
    ASCII. Returns doc_id, n_words, n_base (places of base phrases), first_word and
    last_word (their smallest and largest start, null without any), base_labels,
    labels (those of matched templates too; both distinct, sorted, comma-joined),
    score (share of the best matched template's words that stand in place; 1 with a
    base phrase, 0 with nothing) and templates (matched ones, by number, with starts).

    Where a matched key phrase is part of a longer one that matched around it, as that of
    CC BY in CC BY-SA, the longer alone gives a label and a share.

    A null or empty text has no words and no labels. Rows that share an id, or have
    none, are scanned each on its own. Notices need not be whole, but the key phrase
    must be. An empty table gives an empty result; other columns are ignored.
    """
    phrases = [tuple(p.split()) for p in base] + [tuple(k.split()) for _, _, k in templates]
    vocabulary = sorted({w for p in phrases for w in p} | {w for _, t, _ in templates for w in t.split()})
    words = F.filter(F.split(_lowered(F.coalesce(text_col, F.lit(""))), SEPARATORS), lambda w: w != "")
    scanned = docs.select(F.col(id_col).alias("doc_id"), words.alias("words"))
    known = F.array(*[F.lit(w) for w in vocabulary])
    scanned = scanned.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.array_intersect("words", known).alias("present"),
    )
    likely = reduce(or_, [_has_all(gate) for gate in _gates(phrases)])
    scanned = scanned.withColumn("words", F.when(likely, F.col("words")))
    scanned = settle(scanned, "scanned")
    likely = scanned.filter("words IS NOT NULL")

    matched = settle(_matches(scanned, likely, templates), "matched")
    places = {p: _places(tuple(p.split())) for p in base}
    arrays = [F.col(f"place_{k}") for k in range(len(base))]
    found = likely.select("row", *[c.alias(f"place_{k}") for k, c in enumerate(places.values())])
    labels = [F.when(F.size(a) > 0, F.lit(label)) for a, label in zip(arrays, base.values(), strict=True)]
    everywhere = F.concat(*arrays)
    found = found.select(
        "row",
        F.size(everywhere).cast("long").alias("n_base"),
        F.array_min(everywhere).cast("long").alias("first_word"),
        F.array_max(everywhere).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("own"),
    )
    nothing = F.array().cast("array<string>")
    parts = _parts_of_longer(matched, templates).withColumn("part", F.lit(True))
    matched = matched.join(parts, ["row", "template", "start"], "left")
    per_row = matched.groupBy("row").agg(
        F.max(F.when(F.col("part").isNull(), F.col("share"))).alias("share"),
        F.collect_set(F.when(F.col("part").isNull(), F.col("label"))).alias("more"),
        F.array_sort(F.collect_set(F.struct("template", F.col("start").alias("first_word")))).alias("templates"),
    )
    result = scanned.select("row", "doc_id", "n_words").join(found, "row", "left").join(per_row, "row", "left")
    own, more = F.coalesce("own", nothing), F.coalesce("more", nothing)
    return result.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        "templates",
    )


def _lowered(text: Column) -> Column:
    """A-Z in lower case, wherever else capitals stand.

    ``lower`` is the faster, and differs in ASCII letters only where a text has one of
    the two capitals outside ASCII whose small forms hold an ASCII letter.
    """
    odd = F.contains(text, F.lit("K")) | F.contains(text, F.lit("İ"))
    return F.when(odd, F.translate(text, CAPITALS, SMALL)).otherwise(F.lower(text))


def _gates(phrases: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """Sets of words one of which a file with any of the phrases has in full.

    A phrase's own words, or the first of them where many phrases begin alike, without
    those that hold all words of another set.
    """
    begins = Counter(p[:GATE_WORDS] for p in dict.fromkeys(phrases))
    heads = [p[:GATE_WORDS] if begins[p[:GATE_WORDS]] >= GATE_SHARED else p for p in phrases]
    sets = {frozenset(p): p for p in heads}
    return [p for own, p in sets.items() if not any(other < own for other in sets)]


def _key_place(notice: list[str], key: list[str]) -> int:
    """Where the key phrase begins in its notice."""
    return next(i for i in range(len(notice)) if notice[i : i + len(key)] == key)


def _parts_of_longer(matched: DataFrame, templates: tuple) -> DataFrame:
    """(row, template, start) of matches whose key phrase is part of a longer one in place.

    Which key phrases hold which others, and where, is known from the templates; a match
    then names the matches that it makes parts, so matches are not compared in pairs.
    """
    split = [(label, notice.split(), key.split()) for label, notice, key in templates]
    held = []
    for long, (label, notice, key) in enumerate(split):
        for short, (other, its_notice, its_key) in enumerate(split):
            if label == other or len(its_key) >= len(key):
                continue
            offsets = [k for k in range(len(key)) if key[k : k + len(its_key)] == its_key]
            move = _key_place(notice, key) - _key_place(its_notice, its_key)
            held += [(long, short, move + k) for k in offsets]
    held = matched.sparkSession.createDataFrame(held, "template int, short int, move int")
    named = matched.join(held, "template").select("row", F.col("short").alias("template"), (F.col("start") + F.col("move")).alias("start"))
    return named.distinct()


def _has_all(phrase: tuple[str, ...]) -> Column:
    """Whether a file has all words of a phrase."""
    return reduce(and_, [F.array_contains("present", w) for w in dict.fromkeys(phrase)])


def _places(phrase: tuple[str, ...]) -> Column:
    """Where the words of a phrase stand one after the other, from 0."""

    def here(i: Column) -> Column:
        return reduce(and_, [F.get("words", i + k) == w for k, w in enumerate(phrase)])

    return F.filter(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0))), here)


def _matches(scanned: DataFrame, likely: DataFrame, templates: tuple) -> DataFrame:
    """(row, template, start, label, share) of every template found at a place."""
    spark = scanned.sparkSession
    postings, key_words = [], []
    for number, (label, notice, key) in enumerate(templates):
        notice, key = notice.split(), key.split()
        at = _key_place(notice, key)
        for i, word in enumerate(notice):
            is_key = at <= i < at + len(key)
            postings.append((number, label, i, word, is_key))
        key_words.append((number, len(key), len(notice)))
    index = spark.createDataFrame(postings, "template int, label string, at int, word string, is_key boolean")
    sizes = spark.createDataFrame(key_words, "template int, n_key int, n_notice int")

    seen = scanned.select(F.explode("present").alias("word")).groupBy("word").agg(F.count("*").alias("files"))
    rarity = seen.select("word", F.log(F.lit(scanned.count() + 1) / (F.col("files") + 1)).alias("idf"))

    order = Window.partitionBy("template").orderBy(F.col("idf").desc_nulls_first(), "at")
    ranked = index.filter("is_key").join(rarity, "word", "left").withColumn("rank", F.row_number().over(order))
    rare = settle(ranked.filter(F.col("rank") <= AGREE).select("template", "at", "word"), "rare")

    vocabulary = sorted({word for _, _, _, word, _ in postings})
    spots = likely.select("row", F.posexplode("words").alias("pos", "word")).filter(F.col("word").isin(vocabulary))
    spots = settle(spots, "spots")

    start = F.col("pos") - F.col("at")
    votes = spots.join(rare, "word").groupBy("row", "template", start.alias("start")).agg(F.count("*").alias("votes"))
    agreed = votes.join(sizes, "template").filter(F.col("votes") >= F.least(F.lit(AGREE), "n_key"))
    agreed = agreed.select("row", "template", "start")
    expected = agreed.join(index, "template").withColumn("pos", F.col("start") + F.col("at"))
    standing = expected.join(spots, ["row", "pos", "word"]).groupBy("row", "template", "start", "label")
    standing = standing.agg(
        F.sum(F.col("is_key").cast("int")).alias("key_words"), F.count("*").alias("in_place")
    )
    verified = standing.join(sizes, "template").filter("key_words = n_key")
    return verified.select("row", "template", "start", "label", (F.col("in_place") / F.col("n_notice")).alias("share"))
