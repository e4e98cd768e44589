"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a line, or as many words in a row as a template has, over line ends, so notices that are wrapped or
carry comment signs are found; of the latter 80 % must also stand where the template has them, give or take
two words, since lines that meet by chance may share common words. A template is found in a block if the block holds at least 80 % of the template's
distinct tokens. Tokens are ordered by their frequency in all blocks, rare ones first. Of a
template with n tokens, of which k must be found, only the first n - k + 1 are indexed: a block that
meets the threshold holds one of them. A pair then has to pass the length filter (the block
has k template tokens) and the positional filter (enough tokens follow the first common one on
either side) before its overlap is counted on the full sets.

The templates are the small side: the index and the frequency table have a row per
template token, so their size is bounded by the templates handed in, and the driver sees
nothing else. Texts aren't shuffled.

Besides, the words of three fixed phrases are looked for anywhere in the text.

Defined results: null and empty texts have no words, no labels and score 0; repeated
rows are scanned each; an empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorlake.llm.common import TOKEN, found, lower_ascii

#: Phrases that every scan counts, with their labels.
PHRASES = {
    ("mit", "license"): "mit",
    ("apache", "license"): "apache",
    ("general", "public", "license"): "gpl",
}
#: Notices by which public licenses ask to be named, by label.
TEMPLATES = {
    "agpl-notice": "licensed under the GNU Affero General Public License",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd-terms": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "gpl-header": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "isc-terms": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "lgpl-notice": "licensed under the GNU Lesser General Public License",
    "mit-notice": "Released under the MIT License",
    "mit-terms": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
THRESHOLD = 0.8
SHIFT = 2


def tokens(text: Column) -> Column:
    return found(lower_ascii(text), TOKEN)


def _one_row(spark, column: Column) -> DataFrame:
    return spark.range(1).select(column)


def template_sets(spark, templates: dict[str, str]) -> DataFrame:
    """(label, token): the distinct tokens of each template."""
    rows = _one_row(spark, F.explode(F.array(*[F.struct(F.lit(k).alias("label"), F.lit(v).alias("notice")) for k, v in templates.items()])).alias("t"))
    return rows.select("t.label", F.explode(F.array_distinct(tokens(F.col("t.notice")))).alias("token"))


def _vocabulary(sets: DataFrame) -> list[str]:
    return [r.token for r in sets.select("token").distinct().orderBy("token").collect()]


def frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each template token occurs in all texts."""
    own = words.select(F.explode(F.filter("words", lambda w: w.isin(vocabulary))).alias("token"))
    return {r.token: r.n for r in own.groupBy("token").agg(F.count("*").alias("n")).collect()}


def index(spark, templates: dict[str, str], counts: dict[str, int], threshold: float) -> list[dict]:
    """For every template: its tokens, rare ones first, how many must be found, and its prefix."""
    sets: dict[str, list[str]] = {}
    notices = [F.struct(F.lit(k).alias("label"), tokens(F.lit(v)).alias("words")) for k, v in templates.items()]
    texts = {r.t.label: list(r.t.words) for r in _one_row(spark, F.explode(F.array(*notices)).alias("t")).collect()}
    for r in template_sets(spark, templates).orderBy("label", "token").collect():
        sets.setdefault(r.label, []).append(r.token)
    entries = []
    for label, own in sorted(sets.items()):
        own.sort(key=lambda t: (counts.get(t, 0), t))
        need = max(1, math.ceil(threshold * len(own) - 1e-9))
        entries.append({"label": label, "tokens": own, "need": need, "prefix": own[: len(own) - need + 1], "words": texts[label], "placed": math.ceil(threshold * len(texts[label]) - 1e-9)})
    return entries


def _places(words: Column, phrase: tuple[str, ...]) -> Column:
    """Where the words of a phrase stand in a row."""
    same = lambda i: F.lit(True) if not phrase else _all(F.get(words, i + k) == F.lit(w) for k, w in enumerate(phrase))
    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), lambda i: F.coalesce(same(i), F.lit(False)))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every document with n_words, its phrases, labels, and score (the largest containment met, 1 for a phrase)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("words", tokens(F.col("text")))
    entries = index(spark, templates, frequencies(rows, _vocabulary(template_sets(spark, templates))), threshold)
    rank = {t: i for i, t in enumerate(dict.fromkeys(t for e in sorted(entries, key=lambda e: e["label"]) for t in e["tokens"]))}
    prefixes = sorted({t for e in entries for t in e["prefix"]}, key=rank.get)
    marked = rows.select("doc_id", "text", "words", F.exists("words", lambda w: w.isin(prefixes)).alias("near"), F.array_contains("words", "license").alias("named"))
    starts = F.array(*[F.when(F.col("named"), _places(F.col("words"), p)).otherwise(F.array().cast("array<int>")) for p in PHRASES])
    lines = F.when(F.col("near"), F.split("text", "\n")).otherwise(F.array().cast("array<string>"))
    # Of each line only distinct tokens that occur in some template count.
    vocabulary = sorted(rank, key=rank.get)
    sets = F.transform(lines, lambda x: F.array_distinct(F.filter(tokens(x), lambda w: w.isin(vocabulary))))
    blocks = F.filter(sets, lambda s: F.exists(s, lambda w: w.isin(prefixes)))
    marked = marked.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), starts.alias("starts"), F.array_distinct(blocks).alias("blocks"),
        F.when(F.col("near"), F.col("words")).alias("words"), F.when(F.col("near"), F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))).alias("have"),
    )
    best = [F.greatest(_containment(F.col("blocks"), e), _in_windows(F.col("words"), F.col("have"), e)) for e in entries]
    marked = marked.withColumn("met", F.when(F.size("blocks") > 0, F.array(*best)))
    base = F.array(*[F.when(F.size(F.get("starts", F.lit(i))) > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())])
    own = F.array(*[F.when(F.get("met", F.lit(i)) > 0, F.lit(e["label"])) for i, e in enumerate(entries)])
    every = F.flatten("starts")
    text_of = lambda labels: F.array_join(F.array_sort(F.array_distinct(F.array_compact(labels))), ",")
    return marked.select(
        "doc_id", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        text_of(base).alias("base_labels"), text_of(F.concat(base, own)).alias("labels"),
        F.when(F.size(every) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("met"), F.lit(0.0))).alias("score"),
    )


def _containment(blocks: Column, entry: dict) -> Column:
    """The largest share of a template's tokens in one block that passes all filters, 0 if none does."""
    need, own = entry["need"], entry["tokens"]
    ordered = F.array(*[F.lit(t) for t in own])

    def share(block: Column) -> Column:
        first = F.coalesce(*[F.when(F.array_contains(block, t), F.lit(i)) for i, t in enumerate(entry["prefix"])])
        overlap = F.size(F.array_intersect(ordered, block))
        # Length filter, then the positional one: tokens before the first common one are lost.
        passes = (F.size(block) >= need) & (F.lit(len(own)) - first >= need)
        return F.when(F.coalesce(passes, F.lit(False)) & (overlap >= need), overlap / F.lit(float(len(own)))).otherwise(F.lit(0.0))

    return F.array_max(F.transform(blocks, share))


def _in_windows(words: Column, have: Column, entry: dict) -> Column:
    """The largest share of a template's tokens in as many words in a row as it has, 0 if below the threshold."""
    need, own, span = entry["need"], entry["tokens"], len(entry["words"])
    text = F.array(*[F.lit(t) for t in entry["words"]])
    ordered = F.array(*[F.lit(t) for t in own])
    overlap = lambda some: F.size(F.array_intersect(ordered, some))
    # A window that meets the threshold holds a token of the prefix.
    places = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(entry["prefix"]), i)))

    def placed(k: Column) -> Column:
        around = lambda j: F.slice(words, F.greatest(k + j + (1 - SHIFT), F.lit(1)), 2 * SHIFT + 1)
        return F.size(F.filter(F.sequence(F.lit(0), F.lit(span - 1)), lambda j: F.array_contains(around(j), F.get(text, j))))

    def most(i: Column) -> Column:
        first = F.greatest(i - (span - 1), F.lit(0))
        inside = F.array_max(F.transform(F.sequence(first, i), lambda k: F.when(placed(k) >= entry["placed"], overlap(F.slice(words, k + 1, span)))))
        # Length filter: all windows around the token together hold enough.
        return F.when(overlap(F.slice(words, first + 1, 2 * span - 1)) >= need, inside).otherwise(F.lit(0))

    best = F.coalesce(F.array_max(F.transform(places, most)), F.lit(0))
    best = F.when(best >= need, best / F.lit(float(len(own)))).otherwise(F.lit(0.0))
    return F.when(overlap(have) >= need, best).otherwise(F.lit(0.0))
