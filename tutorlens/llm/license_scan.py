"""Operator 5: licence scan by an exact set-similarity join (native).

A text block is a window: as many consecutive words of a paragraph (lines with
words, without a blank line between) as a notice has, divided by ``threshold``;
a template is the word set of a licence notice.  A block meets a template when it
contains at least ``threshold`` of its words.  Words are ordered by the number of
texts of the whole corpus that hold them, rarest first.  A match holds enough of
the template's words (length filter), and its rarest one stands early enough in
the template's order (prefix and positional filter: from there on enough words
are left); what passes is verified.  All filters are lossless.

Every text is folded once, into a narrow staged table: the columns of the base
phrases, the words of the vocabulary that it holds, and, only where these are
enough for some template, its folded lines.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutorlens.llm.common import staged

#: Consecutive words and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: The first sentences of common notices.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}

THRESHOLD = 0.8
#: Characters outside words but for the blank and, in the second, the line end.
_OTHER = r"\x00-\x1F\x21-\x2F\x3A-\x60\x7B-\x7F"
_OTHER_IN_LINE = r"\x00-\x09\x0B-\x1F\x21-\x2F\x3A-\x60\x7B-\x7F"


def lowered(text: Column) -> Column:
    """A-Z in lower case.

    ``lower`` is many times faster than a translation; beyond A-Z it changes no
    letter into one of a-z but the Kelvin sign and the dotted capital I.
    """
    plain = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.contains(text, F.lit("K")) | F.contains(text, F.lit("İ")), plain).otherwise(F.lower(text))


def folded(text: Column, other: str = _OTHER) -> Column:
    """The text in lower case, each run of blanks and ``other`` characters as one blank (single blanks are left as they are)."""
    return F.regexp_replace(lowered(text), f" *[{other}][ {other}]*| {{2,}}", " ")


def least_words(templates: dict[str, str], threshold: float) -> dict[str, int]:
    return {label: math.ceil(round(threshold * len({*notice.split()}), 9)) for label, notice in templates.items()}


def windows_of(templates: dict[str, str], threshold: float) -> dict[str, int]:
    """Words of a block of each template."""
    return {label: math.floor(round(len(notice.split()) / threshold, 9)) for label, notice in templates.items()}


def _spaces(text: str) -> str:
    return f"(octet_length({text}) - octet_length(replace({text}, ' ', '')))"


def _words(words) -> str:
    return f"array({', '.join(f'{w!r}' for w in words)})"


def folded_texts(docs: DataFrame, phrases: dict[str, str], templates: dict[str, str], threshold: float) -> DataFrame:
    """doc_id, digest, n_words, n_base, first_word, last_word, found (labels of the phrases), held, lines: a row for each row.

    ``held`` are the vocabulary's words that the text holds; ``lines`` the folded
    text with its line ends, null where no template has enough of its words there.
    """
    vocabulary = sorted({w for text in [*phrases, *templates.values()] for w in text.split()})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.concat(F.lit(" "), F.trim(folded(F.col("text"))), F.lit(" ")).alias("words"))
    rows = rows.withColumn("tokens", F.split("words", " "))
    # (a blank before, between and after the words: two empty tokens beside them)
    rows = rows.select(
        "doc_id", "text", "words",
        F.expr("IF(words = '  ', 0, size(tokens) - 2)").alias("n_words"),
        F.expr(f"array_intersect({_words(vocabulary)}, tokens)").alias("held"),
    )
    columns = {}
    for k, phrase in enumerate(phrases):
        here = " AND ".join([f"array_contains(held, {w!r})" for w in phrase.split()] + [f"contains(words, ' {phrase} ')"])
        first = f"substring(words, 1, locate(' {phrase} ', words) - 1)"
        after = f"substring_index(words, ' {phrase} ', -1)"
        # the space between two places belongs to both
        columns[f"n{k}"] = F.expr(f"IF({here}, regexp_count(words, ' {phrase}(?= )'), 0)")
        columns[f"first{k}"] = F.expr(f"IF({here}, {_spaces(first)}, NULL)")
        columns[f"last{k}"] = F.expr(f"IF({here}, n_words - {_spaces(after)} - {len(phrase.split())}, NULL)")
    rows = rows.withColumns(columns)
    every = range(len(phrases))
    labels = ", ".join(f"IF(n{k} > 0, '{label}', NULL)" for k, label in enumerate(phrases.values()))
    least = least_words(templates, threshold)
    enough = " OR ".join(f"size(array_intersect(held, {_words({*notice.split()})})) >= {least[label]}" for label, notice in templates.items())
    return rows.select(
        "doc_id",
        F.xxhash64("text").alias("digest"),
        F.col("n_words").cast("long").alias("n_words"),
        F.expr(" + ".join(f"n{k}" for k in every)).cast("long").alias("n_base"),
        F.least(*(f"first{k}" for k in every), F.lit(None)).cast("long").alias("first_word"),
        F.greatest(*(f"last{k}" for k in every), F.lit(None)).cast("long").alias("last_word"),
        F.expr(f"array_compact(array({labels}))").alias("found"),
        "held",
        F.when(F.expr(enough), folded(F.col("text"), _OTHER_IN_LINE)).alias("lines"),
    )


def word_order(texts: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Words of the templates by the number of texts that hold them, rarest first: their ranks."""
    counts = texts.select(F.explode("held").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    n = {r["word"]: r["n"] for r in counts.collect()}  # a row for each word of the vocabulary at most
    return {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (n.get(w, 0), w)))}


def blocks(texts: DataFrame, templates: dict[str, str], threshold: float, rank: dict[str, int]) -> DataFrame:
    """doc_id, digest, label, containment, n_blocks: the templates that a text meets.

    containment is the largest of a block, n_blocks the number of places:
    overlapping blocks of a template are one.
    """
    sets = {label: sorted({*notice.split()}, key=rank.get) for label, notice in templates.items()}
    least, width = least_words(templates, threshold), windows_of(templates, threshold)
    index = texts.sparkSession.createDataFrame(
        [(label, sets[label], least[label], width[label]) for label in sets], "label string, template array<string>, least int, width int"
    )
    # The templates of which a text holds enough words, with one of the rarest (the prefix) among them.
    labels = ", ".join(
        f"IF(size(array_intersect(held, {_words(words)})) >= {least[label]} AND arrays_overlap(held, {_words(words[: len(words) - least[label] + 1])}), '{label}', NULL)"
        for label, words in sets.items()
    )
    near = texts.where("lines IS NOT NULL").select("doc_id", "digest", F.expr(f"array_compact(array({labels}))").alias("labels"), "lines")
    # Words in their order; a gap as wide as any block stands for blank lines.
    near = near.withColumn("lines", F.expr("transform(split(lines, '\n'), x -> filter(split(x, ' '), w -> w <> ''))"))
    near = near.withColumn("kept", F.expr("filter(lines, (x, i) -> size(x) > 0 OR i > 0 AND size(lines[i - 1]) > 0)"))
    gap = f"array_repeat(CAST(NULL AS STRING), {max(width.values())})"
    near = near.select("doc_id", "digest", "labels", F.expr(f"flatten(transform(kept, x -> IF(size(x) = 0, {gap}, x)))").alias("tokens"))
    rows = near.select("doc_id", "digest", "tokens", F.explode_outer("labels").alias("label")).join(F.broadcast(index), "label")  # a row for each template
    # Every block stands whole in one of the overlapping stretches of twice its width: only stretches with enough words are walked.
    stretch = "slice(tokens, CAST(c * width + 1 AS INT), {})"
    rows = rows.withColumn(
        "stretches", F.expr(f"filter(sequence(0, size(tokens) div width), c -> size(array_intersect({stretch.format('2 * width')}, template)) >= least)")
    )
    # (where the next stretch is walked too, the second half is left to it)
    walked = stretch.format("IF(get(stretches, k + 1) <=> c + 1, width, 2 * width)")
    words = f"filter(transform({walked}, (w, i) -> struct(c * width + i AS at, array_position(template, w) AS place)), h -> h.place > 0)"
    rows = rows.withColumn("hits", F.expr(f"flatten(transform(stretches, (c, k) -> {words}))"))
    # A block begins at each of the template's words; places count from 1 in the template's order.
    found = "transform(hits, (h, a) -> filter(slice(hits, a + 1, width), y -> y.at < h.at + width))"
    found = f"filter({found}, b -> size(b) >= least AND array_min(b.place) + least - 1 <= size(template))"
    met = f"filter(transform({found}, b -> struct(b[0].at AS start, element_at(b, -1).at AS last, size(array_distinct(b.place)) AS common)), m -> m.common >= least)"
    best = "struct(array_max(m.common) / size(template) AS containment, size(filter(m, (x, i) -> i = 0 OR x.start > m[i - 1].last)) AS n_blocks)"
    # from an outer explode no condition is inferred that would walk the texts again
    rows = rows.select("doc_id", "digest", "label", F.explode_outer(F.expr(f"transform(array({met}), m -> {best})")).alias("m")).where("m.n_blocks > 0")
    return rows.select("doc_id", "digest", "label", "m.containment", F.col("m.n_blocks").cast("long").alias("n_blocks")).dropDuplicates(["doc_id", "digest", "label"])


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks.

    One row for each row of ``docs``.  score is the largest containment found, or
    1 where a base phrase stands, else 0; n_blocks counts the places where a
    block meets a template (overlapping blocks of a template are one place).  A
    null text is empty: no words, no labels.  Rows that repeat doc_id and text
    repeat their results; an empty table gives no rows; extra columns are never
    read.
    """
    phrases, templates = phrases or BASE_PHRASES, templates or TEMPLATES
    texts = staged(folded_texts(docs, phrases, templates, threshold), "license-texts")
    rank = word_order(texts, sorted({w for notice in templates.values() for w in notice.split()}))
    met = staged(blocks(texts, templates, threshold, rank), "license-blocks")
    found = met.groupBy("doc_id", "digest").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("containment"), F.sum("n_blocks").alias("n_blocks")
    )
    found = staged(found.withColumnsRenamed({"doc_id": "found_id", "digest": "found_digest"}), "license-found")
    both = texts.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("digest") == F.col("found_digest")), "left")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        joined(F.col("found")).alias("base_labels"),
        joined(F.concat("found", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.greatest(F.coalesce("containment", F.lit(0.0)), F.expr("IF(n_base > 0, 1D, 0D)")).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
    )
