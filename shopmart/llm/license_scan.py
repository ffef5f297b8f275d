"""License scans: an exact set-similarity join of text blocks with license templates.

A template is a notice's set of words, with a label. A block is a stretch of a text's words: for templates of up
to s words (s a power of two) the 2s words from every multiple of s on, so any passage of up to s words lies
whole in a block. A block matches a template if it contains at least ``CONTAINMENT`` of the
template's words, which is ceil(``CONTAINMENT`` * size) = alpha of them.

All template words are ordered by the number of documents they occur in, the rarest first. A matching
block must contain one of the first size - alpha + 1 words of its template, in this order (prefix filter): only
blocks with such a word are formed, and meet the templates in a join on it. Of these, blocks with
fewer than alpha template words go (length filter), and pairs whose words from the shared one on are too
few for alpha on either side (positional filter). What is left is counted.

One scan of the texts keeps, per row, the number of words and the places of template words; all else
works on that. Everything is a DataFrame function: no Python runs on the executors.

Beside the templates there are phrases: words that must stand consecutively. Words are
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z were lower-cased. Nulls: a null text is an empty one, a null id is
kept. Repeated rows each get their row; ties cannot matter, as labels are sets. Empty
tables give no rows. Only the two named columns are read. Templates are a parameter of at most
``MAX_TEMPLATE_WORDS`` words, so what is broadcast has that bound.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm.common import stored

CONTAINMENT = 0.9
LEAST_STRIDE = 8
MAX_TEMPLATE_WORDS = 20_000

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording of public license notices and their labels.
TEMPLATES = (
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl-3", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def template_words(text: str) -> list[str]:
    """A notice's words in order, as a text's words are taken."""
    return [w.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)) for w in _WORD.findall(text)]


def lower(word: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(word, string.ascii_uppercase, string.ascii_lowercase)


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stride(n_words: int) -> int:
    """Half the length of the blocks for a template of so many words."""
    return max(LEAST_STRIDE, 1 << (n_words - 1).bit_length())


def placed_words(docs: DataFrame, vocabulary: Sequence[str], id_col: str, text_col: str) -> DataFrame:
    """``row``, id, ``n_words`` and ``hits``: place and word of each word in the vocabulary, in order."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, SEPARATORS), lambda w: w != "")
    known = sorted(vocabulary)

    def hits(found: Column) -> Column:
        # lower() also changes other letters; what it lets through is lowered and asked again.
        numbered = F.transform(found, lambda w, i: F.struct(i.alias("i"), w.alias("w")))
        likely = F.filter(numbered, lambda x: F.lower(x["w"]).isin(known))
        lowered = F.transform(likely, lambda x: F.struct(x["i"].alias("i"), lower(x["w"]).alias("w")))
        return F.struct(
            F.size(found).cast("long").alias("n_words"),
            F.filter(lowered, lambda x: x["w"].isin(known)).alias("hits"),
        )

    taken = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        _bound(words, hits).alias("found"),
    )
    return taken.select("row", "id", "found.n_words", "found.hits")


def _starts(phrase: str) -> Column:
    """Places of a phrase among ``hits``, which hold all of its words."""
    words, last = template_words(phrase), len(template_words(phrase)) - 1

    def at(hit: Column, k: Column) -> Column:
        same = hit["w"] == words[0]
        for j in range(1, last + 1):
            same = same & (F.get(F.col("hits"), k + j)["w"] == words[j])
        ends = F.get(F.col("hits"), k + last)["i"] == hit["i"] + last
        return F.when(same & ends, hit["i"])

    return F.filter(F.transform("hits", at), lambda i: i.isNotNull())


def phrase_labels(placed: DataFrame, phrases: Mapping[str, str]) -> DataFrame:
    """``row``, id, ``n_words``, ``n_base``, ``first_word``, ``last_word`` and ``base`` (distinct labels)."""
    given = {" ".join(template_words(p)): label for p, label in phrases.items()}
    places = [_starts(p) for p in given]
    found = placed.select("row", "id", "n_words", *[p.alias(f"p{k}") for k, p in enumerate(places)])
    columns = [F.col(f"p{k}") for k in range(len(places))]
    none = F.array().cast("array<int>")
    named = [
        F.when(F.size(c) > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
        for c, label in zip(columns, given.values(), strict=True)
    ]
    found = found.withColumn("all", F.concat(none, *columns))
    return found.select(
        "row",
        "id",
        "n_words",
        F.size("all").cast("long").alias("n_base"),
        F.array_min("all").cast("long").alias("first_word"),
        F.array_max("all").cast("long").alias("last_word"),
        F.array_distinct(F.concat(F.array().cast("array<string>"), *named)).alias("base"),
    )


def frequency_order(placed: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """The vocabulary (bounded) by the number of rows a word occurs in over the whole table, the rarest first."""
    own = placed.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x["w"]))).alias("w"))
    counts = {r.w: r.n for r in own.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _alpha(size: int, containment: float) -> int:
    return math.ceil(containment * size - 1e-9)


def prefix_index(
    spark: SparkSession, templates: Sequence[tuple[str, str]], order: Sequence[str], containment: float
) -> tuple[DataFrame, dict[int, list[str]]]:
    """Rows of (stride, word rank, label, the template's ranks in order, alpha, place of the word among them), one
    for each word of each template's prefix; and the prefix words by stride."""
    rank = {w: k for k, w in enumerate(order)}
    rows, prefixes = [], {}
    for label, text in templates:
        words = template_words(text)
        ranks = sorted({rank[w] for w in words})
        alpha, s = _alpha(len(ranks), containment), stride(len(words))
        for place, r in enumerate(ranks[: len(ranks) - alpha + 1]):
            rows.append((s, r, label, ranks, alpha, place))
            prefixes.setdefault(s, set()).add(order[r])
    schema = "stride int, token int, label string, template array<int>, alpha int, place int"
    return spark.createDataFrame(rows, schema), {s: sorted(w) for s, w in prefixes.items()}


def candidate_blocks(placed: DataFrame, prefixes: Mapping[int, Sequence[str]], order: Sequence[str]) -> DataFrame:
    """``row``, ``stride`` and ``tokens`` (ranks of the block's template words, in order): the blocks with a prefix word.

    A block is taken at its first prefix word, from the hits near it, so that a text costs in
    proportion to its length.
    """
    ranked = F.array(*[F.lit(w) for w in order]).cast("array<string>")
    kinds = [_blocks(s, list(words), ranked) for s, words in sorted(prefixes.items())]
    none = F.array().cast("array<struct<stride:int,tokens:array<int>>>")
    return placed.select("row", F.explode(F.concat(none, *kinds)).alias("b")).select("row", "b.*")


def _blocks(s: int, prefix: list[str], ranked: Column) -> Column:
    """The blocks of a stride that hold one of its prefix words."""
    numbered = F.transform(
        "hits", lambda x, k: F.struct(x["i"].alias("i"), x["w"].alias("w"), k.alias("k"))
    )
    at = F.filter(numbered, lambda x: x["w"].isin(prefix))

    def of_hits(found: Column) -> Column:
        def of_hit(hit: Column, n: Column) -> Column:
            own = F.floor(hit["i"] / s).cast("int")
            before = F.floor(F.get(found, n - 1)["i"] / s).cast("int")
            first = F.greatest(hit["k"] - 2 * s, F.lit(0)) + 1
            near = F.slice(F.col("hits"), first, F.lit(4 * s + 1))

            def block(j: Column) -> Column:
                inside = F.filter(near, lambda y: (y["i"] >= j * s) & (y["i"] < (j + 2) * s))
                tokens = F.transform(inside, lambda y: F.array_position(ranked, y["w"]).cast("int") - 1)
                tokens = F.sort_array(F.array_distinct(F.filter(tokens, lambda t: t >= 0)))
                return F.struct(F.lit(s).alias("stride"), tokens.alias("tokens"))

            # Blocks that hold an earlier prefix word were taken there.
            new = F.filter(F.array(own - 1, own), lambda j: (j >= 0) & F.coalesce(j > before, F.lit(True)))
            return F.transform(new, block)

        return F.flatten(F.transform(found, of_hit))

    return _bound(at, of_hits)


def similar_blocks(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """``row``, ``label`` and ``score`` of block and template pairs that meet the containment."""
    least = index.groupBy("stride").agg(F.min("alpha").alias("least"))
    long_enough = blocks.join(F.broadcast(least), "stride").where(F.size("tokens") >= F.col("least"))
    probes = long_enough.select(
        "row", "stride", "tokens", F.posexplode("tokens").alias("x", "token")
    )
    pairs = probes.join(F.broadcast(index), ["stride", "token"])
    rest = F.least(F.size("tokens") - F.col("x"), F.size("template") - F.col("place"))
    # At the first shared word no rarer one is shared, so these words are all that can be.
    pairs = pairs.where(rest >= F.col("alpha"))
    shared = F.size(F.array_intersect("tokens", "template"))
    counted = pairs.withColumn("shared", shared).where(F.col("shared") >= F.col("alpha"))
    return counted.select("row", "label", (F.col("shared") / F.size("template")).alias("score"))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Every row's id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score``.

    ``n_base`` counts all places of phrases, of which ``first_word`` and ``last_word`` are the smallest and
    largest (null without any). ``labels`` has the templates' labels beside the phrases'. ``score``
    is 1 with a phrase, else the largest containment of a template in a block that meets the bound, else 0.
    """
    templates = [t for t in templates if template_words(t[1])]
    sizes = sum(len(template_words(t)) for t in (*phrases, *(t for _, t in templates)))
    if sizes > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have {sizes} words, more than {MAX_TEMPLATE_WORDS}")
    vocabulary = {w for _, t in templates for w in template_words(t)}
    known = vocabulary | {w for p in phrases for w in template_words(p)}
    placed = stored(placed_words(docs, known, id_col, text_col), "license-words")
    order = frequency_order(placed, vocabulary)
    index, prefixes = prefix_index(docs.sparkSession, templates, order, containment)
    found = similar_blocks(candidate_blocks(placed, prefixes, order), index)
    found = found.groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max("score").alias("near")
    )
    joined = phrase_labels(placed, phrases).join(found, "row", "left")
    none = F.array().cast("array<string>")
    every = F.array_distinct(F.concat("base", F.coalesce("more", none)))
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("near", F.lit(0.0))).alias("score"),
    )
