"""Licence scan: phrases, and an exact set-similarity join with notice templates.

Texts are cut into words once. A text can hold a notice only if it holds enough of one
template's words; the few that do are stored with what was found so far, and the join
reads those alone.

A block is a line of at most ``BLOCK_WORDS`` words. Its word set is reduced to the words
that occur in any template, in the global order from the rarest to the most frequent
over the blocks. A block meets a template if it holds at least
``ceil(threshold * |T|)`` of the template's words (containment). Candidates come from
an equi-join of block prefix and template prefix words: two sets that share ``a`` words
share one within the first ``|B| - a + 1`` and ``|T| - a + 1`` of them. Length and
position filters cut candidates before the exact overlap is counted. All filters are
exact, so no block that meets the threshold is lost.

A notice that is wrapped over several lines, or stands in a longer line, is found in
runs of words of the whole text: as many as the template has (with repeats) divided by
the threshold, so that the notice with some words between may stand in one. A run starts
at each of the template's words, and its exact containment decides. Words that are
scattered more widely are no notice.

Defined cases: a NULL or empty text has no words, blocks or labels. Repeated rows
(same id and text) are reported once each. A document with equal labels from both
parts lists them once. Empty tables give empty results. Only the id and the text
column are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.text import alnum_words, literal_rows, text_key
from pricelens.session import stage_table

# Phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Notices as licence texts ask for them, and their labels.
TEMPLATES = (
    ("Released under the MIT License.", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "cc-by-nc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2"),
)
THRESHOLD = 0.9
#: Words of the longest line that counts as a block; longer ones are searched by runs alone.
BLOCK_WORDS = 60
KEY = ["_id", "_k1", "_k2"]


def needed(size: int, threshold: float) -> int:
    """Words that a block must share with a template of ``size`` words."""
    return max(1, math.ceil(threshold * size - 1e-9))


def template_words(text: str) -> list[str]:
    import re

    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.lower())


def template_sets(templates=TEMPLATES) -> list[tuple[str, list[str]]]:
    """Label and sorted word set of every template."""
    return [(label, sorted(set(template_words(text)))) for text, label in templates]


def template_length(text: str) -> int:
    return len(template_words(text))


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines of every text with their number and words."""
    k1, k2 = text_key(F.col(text_col))
    lines = docs.select(
        F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"), F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("block", "_line")
    )
    return lines.select(*KEY, "block", alnum_words(F.col("_line")).alias("_bw"))


def matching_blocks(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every (block, template) pair whose containment reaches ``threshold``.

    Columns: ``_id``, the text key, ``block``, ``label``, ``containment``.
    """
    spark = docs.sparkSession
    sets = template_sets(templates)
    vocabulary = sorted({w for _, words in sets for w in words})
    least = min(needed(len(words), threshold) for _, words in sets)
    lines = blocks(docs, id_col, text_col)
    lines = lines.filter(F.size("_bw") <= BLOCK_WORDS)
    used = F.array_intersect(F.array(*map(F.lit, vocabulary)), F.col("_bw"))
    counted = lines.select(used.alias("_b")).filter(F.size("_b") >= least).select(F.explode("_b").alias("w")).groupBy("w").count().collect()  # a row per template word at most
    often = {r.w: r["count"] for r in counted}
    order = sorted(vocabulary, key=lambda w: (often.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    prefixes = []
    for label, words in sets:
        ranked, least_own = sorted(words, key=place.get), needed(len(words), threshold)
        for i, w in enumerate(ranked[: len(words) - least_own + 1]):
            prefixes.append((w, label, ranked, len(words), least_own, i))
    index = literal_rows(spark, prefixes, ["t_word", "label", "t_words", "t_size", "t_least", "t_pos"])

    ranked = lines.select(*KEY, "block", F.array_intersect(F.array(*map(F.lit, order)), F.col("_bw")).alias("_b"))
    ranked = ranked.filter(F.size("_b") >= least)
    prefix = F.slice("_b", F.lit(1), F.size("_b") - least + 1)
    probes = ranked.select(*KEY, "block", "_b", F.posexplode(prefix).alias("_pos", "_word"))
    pairs = probes.join(F.broadcast(index), F.col("_word") == F.col("t_word"))
    size = F.size("_b")
    pairs = pairs.filter((size >= F.col("t_least")) & (F.col("_pos") <= size - F.col("t_least")))
    so_far = F.size(F.array_intersect(F.slice("_b", F.lit(1), F.col("_pos") + 1), F.col("t_words")))
    rest = F.least(F.col("t_size") - 1 - F.col("t_pos"), size - 1 - F.col("_pos"))
    pairs = pairs.filter(so_far + rest >= F.col("t_least"))
    shared = F.size(F.array_intersect("_b", "t_words"))
    found = pairs.withColumn("_shared", shared).filter(F.col("_shared") >= F.col("t_least"))
    return found.groupBy(*KEY, "block", "label").agg(F.max(F.col("_shared") / F.col("t_size")).alias("containment"))


def wrapped_notices(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every (text, template) pair with a run of words whose containment reaches ``threshold``.

    Columns: ``_id``, the text key, ``label``, ``containment`` of the best run.
    """
    k1, k2 = text_key(F.col(text_col))
    texts = docs.select(F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"), alnum_words(F.col(text_col)).alias("_w"))
    kinds = []
    for (text, _), (label, words) in zip(templates, template_sets(templates), strict=True):
        cells = {"label": label, "t_size": len(words), "t_least": needed(len(words), threshold), "t_run": math.ceil(template_length(text) / threshold - 1e-9)}
        kinds.append(F.struct(F.array(*map(F.lit, words)).alias("t_words"), *[F.lit(v).alias(k) for k, v in cells.items()]))
    own = vocabulary_words(F.col("_w"), templates)
    pairs = texts.withColumn("_b", own).select(
        *KEY, "_w", F.explode(F.filter(F.array(*kinds), lambda t: F.size(F.array_intersect(F.col("_b"), t["t_words"])) >= t["t_least"])).alias("t")
    )
    pairs = pairs.select(*KEY, "_w", "t.*")
    starts = F.filter(F.sequence(F.lit(1), F.size("_w")), lambda i: F.array_contains(F.col("t_words"), F.element_at("_w", i)))
    runs = F.transform(starts, lambda i: F.size(F.array_intersect(F.slice("_w", i, F.col("t_run")), F.col("t_words"))))
    found = pairs.select(*KEY, "label", "t_size", "t_least", F.array_max(runs).alias("_shared")).filter(F.col("_shared") >= F.col("t_least"))
    return found.select(*KEY, "label", (F.col("_shared") / F.col("t_size")).alias("containment"))


def vocabulary_words(words: Column, templates=TEMPLATES) -> Column:
    """The words of any template that are among ``words``."""
    vocabulary = sorted({w for _, own in template_sets(templates) for w in own})
    return F.array_intersect(F.array(*map(F.lit, vocabulary)), words)


def may_hold(found: Column, templates=TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """Whether these words of the templates suffice for one of them."""
    tests = [F.size(F.array_intersect(found, F.array(*map(F.lit, own)))) >= needed(len(own), threshold) for _, own in template_sets(templates)]
    return reduce(lambda a, b: a | b, tests)


def phrase_places(words: Column, n: Column, joined: Column, phrase: str) -> Column:
    """Word positions, from 0, at which the phrase's words stand consecutively."""
    parts = phrase.split(" ")
    here = F.filter(
        F.sequence(F.lit(0), n - len(parts)),
        lambda i: F.slice(words, i + 1, len(parts)) == F.array(*map(F.lit, parts)),
    )
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), here).otherwise(F.array().cast("array<int>"))


def license_scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: phrase places and labels, the join's labels and a score.

    ``score`` is 1 with a phrase, else the highest containment reached by a block
    or a run of words, else 0.
    """
    k1, k2 = text_key(F.col(text_col))
    words = docs.select(
        F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"), F.col(text_col).alias("_text"), alnum_words(F.col(text_col)).alias("_w")
    )
    words = words.select(
        *KEY, "_text", "_w", F.size("_w").alias("_n"), F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" ")).alias("_s"),
        vocabulary_words(F.col("_w"), templates).alias("_b"),
    )
    places = words.select(
        *KEY, "_n", F.when(may_hold(F.col("_b"), templates, threshold), F.col("_text")).alias("_text"),
        *[phrase_places(F.col("_w"), F.col("_n"), F.col("_s"), p).alias(f"_p{i}") for i, (p, _) in enumerate(phrases)],
    )
    places = stage_table(places, "license_words")
    every = F.concat(*[f"_p{i}" for i in range(len(phrases))])
    base = places.select(
        *KEY,
        F.col("_n").cast("long").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_compact(F.array(*[F.when(F.size(f"_p{i}") > 0, label) for i, (_, label) in enumerate(phrases)])).alias("base"),
        F.lit(None).cast("string").alias("label"),
        F.when(F.size(every) > 0, 1.0).otherwise(0.0).alias("score"),
    )
    candidates = places.filter(F.col("_text").isNotNull()).select("_id", "_text")
    lines = matching_blocks(candidates, templates, threshold, "_id", "_text").select(*KEY, "label", "containment")
    found = lines.unionAll(wrapped_notices(candidates, templates, threshold, "_id", "_text")).select(
        *KEY, *[F.lit(None).cast("long").alias(c) for c in ("n_words", "n_base", "first_word", "last_word")], F.lit(None).cast("array<string>").alias("base"), "label", F.col("containment").alias("score")
    )
    merged = base.unionAll(found).groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("n_words", "n_base", "first_word", "last_word", "base")],
        F.collect_set("label").alias("_labels"),
        F.max("score").alias("score"),
        F.count("n_words").alias("_copies"),
    )
    return merged.select(
        F.col("_id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.sort_array(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat("base", "_labels"))), ",").alias("labels"),
        "score",
        F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"),
    ).drop("_copy")
