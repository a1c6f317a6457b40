"""License notices by an exact set-similarity join, and license phrases by their places. DataFrame functions only.

A template is the set of a notice's words. A text matches it where a run of words, up to ``STRETCH`` times as long as the
notice, holds at least ``CONTAINMENT`` of those words; line ends, comment marks and other signs between words don't
matter, so a notice may be wrapped or quoted. Texts are joined with templates on shared words under three filters that
lose nothing:

* *prefix*: words are ordered by how many documents hold them, rare ones first. With ``need`` words to share, a match
  shares one of the first ``size - need + 1`` words of the template and of the block;
* *length*: a block has at least ``need`` of the templates' words;
* *position*: after the shared word, both sides still have enough words to reach ``need``.

The join runs twice: on whole documents, which leaves few, and on blocks of those that overlap so far that every run lies
in one. The runs of the remaining blocks are counted in full. Only words that occur in some template enter a block's
set; the others can't be shared.

Phrases are joined as templates too (all their words needed, a document as the block), and the places where their
words stand one after another are then counted in the documents that are left.

Words are lower case (A-Z) runs of letters, digits and anything beyond ASCII. Null and empty texts have no words, no
labels and score 0; an empty table gives no rows. Texts are read whole, however long. Rows that repeat an id and text
repeat their result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from math import ceil
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebridge.llm.tables import split_by_ids, staged

CONTAINMENT = 0.8
#: Words of a run for each word of the notice.
STRETCH = 1.5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Usual notices, by label.
NOTICES = {
    "apache-2.0": "licensed under the apache license version 2.0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4.0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "lgpl": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "proprietary": "all rights reserved",
    "unlicense": "this is free and unencumbered software released into the public domain",
}


def words_of(text: str) -> list[str]:
    """Words of a template, as the columns below see them."""
    return re.findall(WORD, text.lower())


def run_length(notice: str) -> int:
    """Words of a run that may match the notice."""
    return ceil(STRETCH * len(words_of(notice)))


def templates(notices: dict[str, str], phrases: dict[str, str]) -> list[tuple[str, str, list[str], int]]:
    """``kind, name, distinct words, words needed`` of every template."""
    found = [("notice", label, text, CONTAINMENT) for label, text in sorted(notices.items())]
    found += [("phrase", phrase, phrase, 1.0) for phrase in sorted(phrases)]
    rows = [(kind, name, sorted(set(words_of(text))), share) for kind, name, text, share in found]
    return [(kind, name, words, ceil(round(share * len(words), 9))) for kind, name, words, share in rows]


def words_col(text: Column) -> Column:
    folded = F.translate(text, ascii_uppercase, ascii_lowercase)  # lower() would fold other letters, too
    return F.regexp_extract_all(folded, F.lit(f"({WORD})"), F.lit(1))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _template_rows(spark: SparkSession, known: list[tuple[str, str, list[str], int]], rank: dict[str, int]) -> DataFrame:
    """A row for each template: its words as ranks, ascending."""
    rows = [
        F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.array(*[F.lit(r) for r in sorted(rank[w] for w in words)]).alias("ranks"), F.lit(need).alias("need"))
        for kind, name, words, need in known
    ]
    return spark.range(1, numPartitions=1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")


def matching_blocks(blocks: DataFrame, template_rows: DataFrame, *keys: str) -> DataFrame:
    """Join blocks (``keys`` and ``ranks``, ascending) with templates: ``keys, kind, name, containment`` of every match."""
    size, prefix = F.size("t_ranks"), F.size("t_ranks") - F.col("need") + 1
    heads = template_rows.withColumnRenamed("ranks", "t_ranks").select(
        "kind", "name", "t_ranks", "need", F.posexplode(F.slice("t_ranks", F.lit(1), prefix)).alias("t_at", "word")
    )
    shared = blocks.select(*keys, "ranks", F.posexplode("ranks").alias("at", "word")).join(F.broadcast(heads), "word")  # a few rows a template
    left_in_block, left_in_template = F.size("ranks") - F.col("at"), size - F.col("t_at")
    possible = shared.where((F.size("ranks") >= F.col("need")) & (F.least(left_in_block, left_in_template) >= F.col("need")))
    overlap = F.size(F.array_intersect("ranks", "t_ranks"))
    matches = possible.where(overlap >= F.col("need")).select(*keys, "kind", "name", (overlap / size).alias("containment"))
    return matches.distinct()


def places(words: Column, phrase: str) -> Column:
    """Places (from 0) where the phrase's words stand one after another."""
    parts = words_of(phrase)
    n = F.size(words) - (len(parts) - 1)

    def here(i: Column) -> Column:
        found = F.lit(True)
        for k, part in enumerate(parts):
            found = found & (F.get(words, i + k) == part)
        return found

    return F.filter(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), here)


def _most_held(words: Column, blocks: Column, wanted: list[str], run: int, step: int) -> Column:
    """The most distinct words of ``wanted`` that a run of words beginning in one of the blocks holds."""
    listed = _strings(wanted)

    def of_block(block: Column) -> Column:
        first = block * step
        places = F.sequence(first, F.least(first + step, F.size(words)) - 1)
        begins = F.filter(places, lambda i: F.array_contains(listed, F.get(words, i)))
        return F.coalesce(F.array_max(F.transform(begins, lambda i: F.size(F.array_intersect(F.slice(words, i + 1, F.lit(run)), listed)))), F.lit(0))

    return F.coalesce(F.array_max(F.transform(blocks, of_block)), F.lit(0))


def scan_licenses(docs: DataFrame, notices: dict[str, str] = NOTICES, phrases: dict[str, str] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, places, base, notices`` of every row.

    ``places`` holds the start of every phrase, ``base`` the labels of phrases, ``notices`` (label, containment) pairs.
    """
    spark = docs.sparkSession
    known = templates(notices, phrases)
    vocabulary = sorted({w for _, _, words, _ in known for w in words})
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = F.xxhash64("text").alias("text_key")
    tokens = texts.select("doc_id", key, words_col(F.col("text")).alias("words"))
    tokens = staged(tokens.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), F.array_intersect(_strings(vocabulary), "words").alias("known")), "tokens")

    counts = {r["word"]: r["count"] for r in tokens.select(F.explode("known").alias("word")).groupBy("word").count().collect()}  # the vocabulary at most
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    ranks = F.create_map(*[F.lit(x) for w, r in rank.items() for x in (w, r)])
    template_rows = _template_rows(spark, known, rank)

    def as_ranks(column: str) -> Column:
        return F.array_sort(F.transform(column, lambda w: F.element_at(ranks, w)))

    whole = matching_blocks(tokens.select("doc_id", "text_key", as_ranks("known").alias("ranks")), template_rows, "doc_id", "text_key")
    wanted = staged(whole.select("doc_id", "text_key").distinct(), "wanted")
    maybe, _ = split_by_ids(texts.withColumn("text_key", F.xxhash64("text")), wanted, "text_key")
    chosen = maybe.join(wanted, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    chosen = staged(chosen.select("doc_id", "text_key", words_col(F.col("text")).alias("words")), "chosen")

    step = max([run_length(n) for n in notices.values()], default=1)
    starts = F.sequence(F.lit(0), F.floor((F.size("words") - 1) / step).cast("int"))
    cut = F.transform(starts, lambda b: F.array_intersect(_strings(vocabulary), F.slice("words", b * step + 1, F.lit(2 * step))))
    blocks = chosen.where(F.size("words") > 0).select("doc_id", "text_key", F.posexplode(cut).alias("block", "known"))
    near = matching_blocks(blocks.select("doc_id", "text_key", "block", as_ranks("known").alias("ranks")), template_rows.where("kind = 'notice'"), "doc_id", "text_key", "block")
    near = near.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("name", "block")).alias("near"))  # at most the document's blocks, each with a few templates

    listed = F.array(*[F.struct(F.lit(phrases[p]).alias("label"), places(F.col("words"), p).alias("at")) for p in sorted(phrases)])

    def near_blocks(name: str) -> Column:
        return F.transform(F.filter("near", lambda n: n["name"] == name), lambda n: n["block"])

    held = [
        F.struct(
            F.lit(name).alias("name"),
            _most_held(F.col("words"), near_blocks(name), words, run_length(notices[name]), step).alias("held"),
            F.lit(need).alias("need"),
            F.lit(len(words)).alias("size"),
        )
        for kind, name, words, need in known
        if kind == "notice"
    ]
    read = chosen.join(near, ["doc_id", "text_key"], "left").select("doc_id", "text_key", listed.alias("phrases"), F.array(*held).alias("held"))
    enough = F.filter("held", lambda n: n["held"] >= n["need"])
    standing = read.select(
        "doc_id",
        "text_key",
        F.flatten(F.transform("phrases", lambda p: p["at"])).alias("places"),
        F.array_distinct(F.transform(F.filter("phrases", lambda p: F.size(p["at"]) > 0), lambda p: p["label"])).alias("base"),
        F.transform(enough, lambda n: F.struct(n["name"].alias("name"), (n["held"] / n["size"]).alias("containment"))).alias("notices"),
    )
    found = tokens.select("doc_id", "text_key", "n_words").join(standing, ["doc_id", "text_key"], "left")
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce("places", F.array().cast("array<int>")).alias("places"),
        F.coalesce("base", F.array().cast("array<string>")).alias("base"),
        F.coalesce("notices", F.array().cast("array<struct<name:string,containment:double>>")).alias("notices"),
    )
