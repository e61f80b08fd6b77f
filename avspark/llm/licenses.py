"""License scan: an exact containment join of text blocks with license templates. DataFrame only.

A template is a set of words; a block is a window of ``2 * step`` words, one every ``step``
words, so that each run of up to ``step`` + 1 words lies whole in some block. A block matches a
template when it holds at least the template's share of its words. Words are ordered by how
often they occur in all documents, rarest first: a block that misses none of the needed
overlap holds one of the template's first m - need + 1 words (prefix filter), at a place in
that order from which enough words are left (positional filter), and enough of the template's
words at all (length filter). Only such blocks are counted out.

Phrases are templates that need all their words; of their blocks, an exact check keeps those
where the words stand in sequence. All that is broadcast is the template table.

Defined results: null text is the empty text (no words); an empty table gives an empty result;
repeated rows and null ids are rows like any other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avspark.llm.common import stored, texts

# Phrases and their labels.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}
# Openings of well-known license texts and their labels.
TEMPLATES = {
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software "
                "and associated documentation files to deal in the software without restriction",
    "apache-2-text": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted "
                "provided that the following conditions are met",
    "gpl-text": "this program is free software you can redistribute it and or modify it under the terms of the "
                "gnu general public license as published by the free software foundation",
}
#: Percent of a template's words that a block must hold.
CONTAINED = 80

#: Between words: ASCII but for digits and letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, _BETWEEN), "")


def scanned(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES,
            contained: int = CONTAINED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score (largest containment among matches; 1 at a phrase; else 0)."""
    spark = docs.sparkSession
    known = [(label, text.split(), True) for label, text in phrases.items()]
    known += [(label, text.split(), False) for label, text in templates.items()]
    vocabulary = sorted({w for _, ws, _ in known for w in ws})
    step = max(len(ws) for _, ws, _ in known)

    # Template words and their places. Words with other than ASCII letters cannot be among
    # them, so lower() changes no more than A-Z.
    is_known = lambda w: (F.octet_length(w) == F.length(w)) & F.lower(w).isin(vocabulary)
    rows = stored(
        texts(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("words"))
        .select("doc_id", "row", F.size("words").cast("long").alias("n_words"),
                F.filter(F.transform("words", lambda w, i: F.struct(i.cast("int").alias("at"), w.alias("word"))),
                         lambda x: is_known(x["word"])).alias("hits")), "license-words")
    hits = rows.select("row", F.explode("hits").alias("hit")).select(
        "row", F.col("hit.at").alias("at"), F.lower("hit.word").alias("word"))

    # Global order: at most as many rows as the templates have words.
    seen = {r["word"]: r["count"] for r in hits.groupBy("word").count().collect()}
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    table, prefixes, offsets, needs = [], [], [], []
    for k, (_label, ws, whole) in enumerate(known):
        tokens = sorted(set(ws), key=order.__getitem__)
        need = len(tokens) if whole else -(-len(tokens) * contained // 100)
        needs.append((k, need, len(tokens)))
        table += [(k, w) for w in tokens]
        prefixes += [(k, w, i) for i, w in enumerate(tokens[: len(tokens) - need + 1])]
        if whole:
            offsets += [(k, w, i, len(ws)) for i, w in enumerate(ws)]
    small = lambda rows, schema: F.broadcast(spark.createDataFrame(rows, schema))

    blocks = F.explode(F.expr(f"array_distinct(array(at div {step}, greatest(at div {step} - 1, 0L)))"))
    first = (hits.where(F.col("word").isin(sorted({w for _, w, _ in prefixes}))).join(small(prefixes, "template int, word string, place int"), "word")
             .select("row", blocks.alias("block"), "template", "place"))
    candidates = stored(
        first.groupBy("row", "block", "template").agg(F.min("place").alias("place"))
        .join(small(needs, "template int, need int, size int"), "template").where("size - place >= need"), "license-candidates")
    of_rows = candidates.select("row").distinct()
    near = hits.join(of_rows, "row", "left_semi").select("row", "at", "word", blocks.alias("block"))
    matched = stored(
        near.join(small(table, "template int, word string"), "word").join(candidates, ["row", "block", "template"])
        .select("row", "block", "template", "word", "need", "size").distinct()
        .groupBy("row", "block", "template", "need", "size").agg(F.count("*").alias("overlap"))
        .where("overlap >= need"), "license-blocks")

    in_sequence = (
        hits.join(matched.select("row").distinct(), "row", "left_semi")
        .join(small(offsets, "template int, word string, offset int, length int"), "word")
        .groupBy("row", "template", (F.col("at") - F.col("offset")).alias("start"), "length").agg(F.count("*").alias("n"))
        .where("n = length").join(matched.select("row", "template").distinct(), ["row", "template"], "left_semi"))
    label = F.element_at(F.array(*[F.lit(x) for x, _, _ in known]), F.col("template") + 1)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = (
        in_sequence.select("row", label.alias("label"), F.col("start").cast("long"), F.lit(1.0).alias("score"))
        .union(matched.where(F.col("template") >= len(phrases))
               .select("row", label, F.lit(None).cast("long"), F.col("overlap") / F.col("size")))
        .groupBy("row").agg(
            F.count("start").alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
            joined(F.when(F.col("start").isNotNull(), F.col("label"))).alias("base_labels"),
            joined("label").alias("labels"), F.max("score").alias("score")))
    found = stored(found, "license-labels")
    return rows.select("doc_id", "row", "n_words").join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score"))
