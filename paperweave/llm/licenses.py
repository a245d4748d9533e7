"""License scans: phrases, and an exact containment join of text blocks with license templates.

A block is a line. It meets a template when it holds at least ``THRESHOLD`` of
the template's distinct words. The join is exact: words are ordered by how many
blocks of the whole corpus hold them, rarest first. A template of m words that
must share o of them shares a word of its first m - o + 1 (prefix filter); the
block must have o template words at all (length filter); and once the first
shared word is known, the words left on both sides must still reach o
(positional filter). What passes is counted exactly.

Only words of templates count, so statistics and the index are bounded by the
templates, which are a parameter; only these are broadcast. Everything else
stays in the rows: no text is shuffled.

Defined results: a null text is empty and has no words, labels '' and score 0.
Repeated rows get the same result each. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperweave.llm.common import LOWER, UPPER, need, quoted, text_of
from paperweave.workspace import stage

THRESHOLD = 0.8
LEAST_WORDS = 4  # shorter templates would meet ordinary lines

# Phrases with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Public notices with their labels.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
)
NOT_WORD = "".join(chr(c) for c in range(1, 128) if not chr(c).isalnum() and c != 10)


def plain(text: Column) -> Column:
    """A-Z in lower case; ASCII that is no letter or digit becomes a space, line ends stay."""
    return F.translate(F.replace(text, F.lit("\x00"), F.lit(" ")), UPPER + NOT_WORD, LOWER + " " * len(NOT_WORD))


def words_of(plain_text: Column) -> Column:
    return F.array_remove(F.split(plain_text, " "), "")


def template_words(text: str) -> list[str]:
    """Distinct words of a template, by the same rule."""
    lowered = "".join(LOWER[UPPER.index(c)] if c in UPPER else c for c in text)
    return list(dict.fromkeys("".join(c if ord(c) > 127 or c.isalnum() else " " for c in lowered).split()))


def phrase_starts(words: Column, phrases: Sequence[str]) -> Column:
    """(at, phrase number) of every place where a phrase's words stand one after another."""
    split = [p.split() for p in phrases]
    firsts = sorted({p[0] for p in split})

    def found(at: Column) -> Column:
        return F.array_compact(F.array(*[
            F.when(_all([F.get(words, at + j) == w for j, w in enumerate(p)]), F.struct(at.alias("at"), F.lit(i).alias("p")))
            for i, p in enumerate(split)]))

    places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(firsts), i)), lambda i: i.isNotNull())
    return F.flatten(F.transform(places, found))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _least(n: int, threshold: float) -> int:
    """Words of ``n`` that a block must share."""
    return math.ceil(threshold * n - 1e-9)


def template_index(blocks: DataFrame, templates: Sequence[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """A row per prefix word of each template, words in the corpus' order, rarest first.

    ``blocks`` has the column ``words``, the distinct template words of a block.
    """
    spark = blocks.sparkSession
    sets = [(i, label, words, _least(len(words), threshold))
            for i, (label, text) in enumerate(templates) if len(words := template_words(text)) >= LEAST_WORDS]
    table = spark.createDataFrame(sets, "template int, label string, words array<string>, needed int")
    counted = blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    ordered = table.select("template", "label", "needed", F.explode("words").alias("word")).join(
        F.broadcast(counted), "word", "left").groupBy("template", "label", "needed").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word"))).alias("ranked"))
    prefix = F.slice("ranked", F.lit(1), F.size("ranked") - F.col("needed") + 1)
    return ordered.select(
        "template", "label", "needed", F.transform("ranked", lambda x: x["word"]).alias("t_words"),
        F.posexplode(F.transform(prefix, lambda x: x["word"])).alias("at", "word"))


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: id, word count, phrase places and labels, template labels and the best containment."""
    need(docs, id_column, text)
    vocabulary = sorted({w for _, t in templates for w in template_words(t)})
    least = min((_least(len(template_words(t)), threshold) for _, t in templates), default=0)
    source = docs.select(quoted(id_column).alias("id"), plain(text_of(quoted(text))).alias("plain"))

    # The template words of each line that has enough of them for any template.
    lines = F.transform(F.split("plain", "\n"), lambda line: F.array_distinct(
        F.filter(words_of(line), lambda w: w.isin(vocabulary))))
    blocks = F.filter(lines, lambda words: F.size(words) >= least)

    # Both have at most a row per template word.
    index = stage(template_index(source.select(F.explode(blocks).alias("words")), templates, threshold), "license-index")
    prefix_words = sorted({r["word"] for r in index.select("word").collect()})

    words = words_of(F.replace("plain", F.lit("\n"), F.lit(" ")))
    labels = F.create_map(*[F.lit(x) for i, label in enumerate(phrases.values()) for x in (i, label)])
    places = source.select("id", words.alias("words"), blocks.alias("blocks")).withColumns({
        "n_words": F.size("words").cast("bigint"),
        "found": phrase_starts(F.col("words"), list(phrases))}).select(
        F.monotonically_increasing_id().alias("row"), "id", "n_words", "blocks",
        F.size("found").cast("bigint").alias("n_base"),
        F.array_min(F.transform("found", lambda x: x["at"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("found", lambda x: x["at"])).cast("bigint").alias("last_word"),
        F.array_distinct(F.transform("found", lambda x: labels[x["p"]])).alias("base"))

    # A row per block that holds a prefix word of some template and that word; rows without one stay as they are.
    probes = places.withColumn("probe", F.explode_outer(F.flatten(F.transform("blocks", lambda b: F.transform(
        F.filter(b, lambda w: w.isin(prefix_words)), lambda w: F.struct(w.alias("word"), b.alias("words"))))))).drop("blocks")
    joined = probes.join(F.broadcast(index), F.col("probe.word") == F.col("word"), "left")
    # Words of the block from this one on, in the template's order: what the pair can still share.
    left_over = F.size("t_words") - F.col("at")
    possible = F.least(F.size("probe.words"), left_over) >= F.col("needed")
    first = ~F.arrays_overlap(F.slice("t_words", F.lit(1), F.col("at")), "probe.words")  # its first shared word
    shared = F.size(F.array_intersect("t_words", "probe.words"))
    met = joined.withColumn("shared", F.when(possible & first, shared)).withColumn(
        "match", F.when(F.col("shared") >= F.col("needed"), F.struct(
            "label", (F.col("shared") / F.size("t_words")).alias("score"))))
    keys = ["row", "id", "n_words", "n_base", "first_word", "last_word", "base"]
    out = met.groupBy(*keys).agg(
        F.collect_set("match.label").alias("more"), F.max("match.score").alias("best"),
        F.count("match").alias("n_blocks"))
    return out.select(
        "id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "more")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.col("n_blocks").cast("bigint").alias("n_template_blocks"))
