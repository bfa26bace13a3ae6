"""License scans by an exact set-similarity join of text blocks with license templates.

A block is a line, or a paragraph of several lines; paragraphs are compared with templates of ``LONG`` or more
different words only, as a few common words can meet by chance in a long paragraph. A block is found when it contains ``THRESHOLD`` or more of the
different words of a template. Words of templates are ordered by the number of blocks of all documents that hold them,
rarest first (other words can't match and are left out). With ``need`` words to share, the first
``size - need + 1`` words of a template must hold one of the block (prefix filter), the block must have ``need`` words
(length filter), and behind the first shared word enough must be left on both sides (positional filter). What remains is
verified by its overlap, so no block is missed and none is found in vain.

The templates are the small side: ``TEMPLATE_WORDS`` bounds them, and a larger set is an error. Beside the method stand
the base phrases, found wherever their words follow each other.

Defined cases: null and empty texts have no words, labels or places (first and last are null) and score 0; repeated rows get
one result row each; a null ``doc_id`` is kept; an empty table gives an empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from transitlake.llm.common import hold, table

THRESHOLD = 0.9
TEMPLATE_WORDS = 20_000
LONG = 10

# The base phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Public wordings of license notices, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    (
        "bsd-3",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
)

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
PARAGRAPH = re.compile(rb"\n[ \t\r]*\n")


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall((text or b"").lower())


def blocks_of(text: bytes) -> Iterator[tuple[bool, bytes]]:
    """Lines (true) and paragraphs of several lines (false)."""
    for paragraph in PARAGRAPH.split(text):
        lines = paragraph.split(b"\n")
        for line in lines:
            yield True, line
        if len(lines) > 1:
            yield False, paragraph


def places(words: list[bytes]) -> list[tuple[int, str]]:
    """Starts of base phrases, with their labels."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in PHRASES:
        mark = b" " + phrase.encode() + b" "
        at = line.find(mark)
        while at >= 0:
            found.append((line.count(b" ", 0, at), label))
            at = line.find(mark, at + 1)
    return found


def _vocabulary(templates) -> frozenset[bytes]:
    words = frozenset(w for _, text in templates for w in words_of(text.encode()))
    if len(words) > TEMPLATE_WORDS:
        raise ValueError(f"templates have {len(words)} different words, more than {TEMPLATE_WORDS}")
    return words


def _count_blocks(vocabulary: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column("text").to_pylist():
                for _, block in blocks_of(text or b""):
                    seen.update(vocabulary.intersection(words_of(block)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
            )

    return run


def word_order(docs: DataFrame, templates) -> dict[bytes, int]:
    """Rank of each template word by the blocks of all documents that hold it, rarest first."""
    vocabulary = _vocabulary(templates)
    body = docs.select(F.col("text").cast("binary").alias("text"))
    counted = body.mapInArrow(_count_blocks(vocabulary), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = {bytes(r.word): r.n for r in counted.collect()}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}


_BLOCKS = "doc_id {kind}, text_hash long, n_words long, starts array<long>, base array<string>, blocks array<struct<line:boolean,words:array<int>>>"


def _read_blocks(ranks: dict[bytes, int], least: int):
    """Per row: words, places of base phrases, and the ordered template words of blocks that pass the length filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frozenset(ranks)
        for batch in batches:
            counts, starts, base, blocks = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                counts.append(len(words))
                found = places(words)
                starts.append([at for at, _ in found])
                base.append(sorted({label for _, label in found}))
                own = []
                if len(known.intersection(words)) >= least:
                    for line, block in blocks_of(text):
                        held = known.intersection(words_of(block))
                        if len(held) >= least:
                            own.append({"line": line, "words": sorted(ranks[w] for w in held)})
                blocks.append(own)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(counts, pa.int64()),
                    pa.array(starts, pa.list_(pa.int64())),
                    pa.array(base, pa.list_(pa.string())),
                    pa.array(blocks, pa.list_(pa.struct([("line", pa.bool_()), ("words", pa.list_(pa.int32()))]))),
                ],
                ["doc_id", "text_hash", "n_words", "starts", "base", "blocks"],
            )

    return run


def contained(blocks: DataFrame, spark: SparkSession, templates: list[tuple[str, list[int], int]]) -> DataFrame:
    """(block, template, containment) of every block and template that meet the threshold.

    ``blocks`` (block, line, words: ordered ranks) are the large side; ``templates`` are (label, ordered ranks, need).
    """
    rows = [
        (n, label, ranks, need, i, rank)
        for n, (label, ranks, need) in enumerate(templates)
        for i, rank in enumerate(ranks[: len(ranks) - need + 1])
    ]
    prefixes = spark.createDataFrame(rows, "template int, label string, ranks array<int>, need int, i int, rank int")
    words = blocks.select("block", "line", "words", F.posexplode("words").alias("j", "rank"))
    met = words.join(F.broadcast(prefixes), "rank").where((F.size("ranks") >= LONG) | F.col("line"))
    met = met.groupBy("block", "words", "template", "label", "ranks", "need")
    first = met.agg(F.min("i").alias("i"), F.min("j").alias("j")).where(
        (F.size("words") >= F.col("need"))
        & (1 + F.least(F.size("ranks") - F.col("i") - 1, F.size("words") - F.col("j") - 1) >= F.col("need"))
    )
    shared = F.size(F.array_intersect("words", "ranks"))
    return first.where(shared >= F.col("need")).select(
        "block", "template", "label", (shared / F.size("ranks")).alias("containment")
    )


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): words, places of base phrases, labels, score."""
    spark = docs.sparkSession
    ranks = word_order(docs, templates)
    ordered = []
    for label, text in templates:
        own = sorted({ranks[w] for w in words_of(text.encode())})
        ordered.append((label, own, math.ceil(threshold * len(own) - 1e-9)))
    least = min(need for _, _, need in ordered)
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    read = hold(slim.mapInArrow(_read_blocks(ranks, least), _BLOCKS.format(kind=kind)), "license-blocks")
    # A row is known by its id and text; a null id is a value of its own here.
    key = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text_hash")
    blocks = read.select(key.alias("block"), F.explode("blocks").alias("b")).select("block", "b.line", "b.words").distinct()
    found = (
        contained(blocks, spark, ordered)
        .groupBy("block")
        .agg(F.collect_set("label").alias("more"), F.max("containment").alias("most"))
        .select(F.col("block.id").alias("id"), F.col("block.text_hash").alias("hash"), "more", "most")
    )
    rows = read.withColumn("id", key["id"])
    joined = rows.join(found, (rows.id == found.id) & (rows.text_hash == found.hash), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"),
        F.array_max("starts").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op1_license_join``."""
    return scan(table(spark, sf_dir, "documents"))
