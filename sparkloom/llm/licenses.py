"""License scans: an exact set-similarity join of text blocks with license templates.

Templates and blocks are sets of tokens, ordered by how many documents hold a
token, rarest first.  A block meets a template if it holds at least
``THRESHOLD`` of the template's tokens (containment).  Three filters leave no
such pair out: a block that meets a template of n tokens, of which it needs m,
has m tokens of the vocabulary (length filter); the first n - m + 1 tokens of the
template and of the block's own order share one (prefix filter); and the
tokens behind that first shared one suffice on both sides (positional
filter).  What is left is compared in full.

Blocks are windows over the words of a text, of twice the next power of two from a
template's length, each half a window after the last, so a passage as long as the
template lies whole in one of them, however its lines are broken.

Scale.  DataFrame functions only.  The templates are a fixed list, so the vocabulary, its
counts (one aggregate over all documents, a row for each token) and the index are
literals of the plan; each text is scanned where it is read and never
shuffled, so hot sources, copies and repeated ids make no difference.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import free_name

THRESHOLD = 0.9
SHORTEST_WINDOW = 16

# Phrases whose places are counted, and their labels.
PHRASES: tuple[tuple[str, str], ...] = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Notices of common licenses, in words as the scan reads them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("agpl", "licensed under the gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "licensed under the apache license 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words in order: stretches of ASCII digits, letters (A-Z as a-z) and characters beyond ASCII; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), F.lit(WORD), 0)


def window_of(words: int) -> int:
    """Length of the blocks for a template of so many words."""
    return max(SHORTEST_WINDOW, 2 << (max(words, 1) - 1).bit_length())


def needed(tokens: int, threshold: float = THRESHOLD) -> int:
    """How many of a template's tokens a block must hold."""
    return max(1, math.ceil(threshold * tokens - 1e-9))


def _strings(values) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each token of ``vocabulary`` occurs: over all documents, one row a token comes back."""
    held = docs.select(F.explode(F.array_intersect(_strings(vocabulary), words_of(F.col(text_col)))).alias("token"))
    return {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()}


class _Index:
    """Templates with one window length, in the order of a vocabulary."""

    def __init__(self, window: int, templates: list[tuple[str, str]], rank: dict[str, int], threshold: float):
        self.window = window
        self.rows = []
        for label, text in templates:
            tokens = sorted(set(text.split()), key=rank.__getitem__)
            need = needed(len(tokens), threshold)
            self.rows.append((label, tokens, need, tokens[: len(tokens) - need + 1]))
        self.vocabulary = sorted({t for _, ts, _, _ in self.rows for t in ts}, key=rank.__getitem__)
        self.prefixes = sorted({t for *_, p in self.rows for t in p})

    def literal(self) -> Column:
        return F.array(*(
            F.struct(F.lit(label).alias("label"), _strings(tokens).alias("tokens"), F.lit(need).alias("need"), _strings(prefix).alias("prefix"))
            for label, tokens, need, prefix in self.rows
        ))

    def blocks(self, words: Column) -> Column:
        """The windows of a text that hold a token of some prefix, as sets of the vocabulary in its order."""
        half = self.window // 2
        starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(words) / half) - 2, F.lit(0)).cast("int"))
        cut = F.transform(starts, lambda i: F.slice(words, i * half + 1, self.window))
        return F.transform(F.filter(cut, lambda b: F.arrays_overlap(b, _strings(self.prefixes))), lambda b: F.array_intersect(_strings(self.vocabulary), b))

    def met(self, block: Column, templates: Column) -> Column:
        """(label, containment) of the templates that a block meets."""

        def candidate(t: Column) -> Column:
            size = F.size(block)
            own = F.slice(block, 1, size - t["need"] + 1)
            first = F.get(F.array_intersect(t["prefix"], own), F.lit(0))  # rarest shared token
            behind = F.least(F.size(t["tokens"]) - F.array_position(t["tokens"], first), size - F.array_position(block, first))
            full = F.size(F.array_intersect(t["tokens"], block)) >= t["need"]
            return F.when(size < t["need"], F.lit(False)).when(first.isNull(), F.lit(False)).when(behind + 1 < t["need"], F.lit(False)).otherwise(full)

        share = lambda t: F.size(F.array_intersect(t["tokens"], block)) / F.size(t["tokens"])
        return F.transform(F.filter(templates, candidate), lambda t: F.struct(t["label"].alias("label"), share(t).alias("containment")))

    def matches(self, words: Column) -> Column:
        templates = self.literal()
        return F.flatten(F.transform(self.blocks(words), lambda b: self.met(b, templates)))


def oracle_sql() -> str:
    """The query's rows as SQL, without the filters: every block against every template whose tokens the text holds."""
    quoted = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    rows = []
    for label, text in TEMPLATES:
        tokens = sorted(set(text.split()))
        rows.append(f"('{label}', {quoted(tokens)}, {len(tokens)}, {needed(len(tokens))}, {window_of(len(text.split()))})")
    phrases = [
        f"SELECT doc_id, '{label}' AS label, i AS start FROM d, LATERAL (SELECT unnest(range(n)) AS i) WHERE "
        + " AND ".join(f"w[i + {k}] = '{part}'" for k, part in enumerate(phrase.split(), 1))
        for phrase, label in PHRASES
    ]
    return f"""WITH t(label, tokens, size, need, width) AS (VALUES {", ".join(rows)}),
d AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents)),
p AS ({" UNION ALL ".join(phrases)}),
base AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY doc_id),
near AS (SELECT doc_id, w, n, label, tokens, size, need, width FROM d, t WHERE len(list_intersect(list_distinct(w), tokens)) >= need),
block AS (SELECT doc_id, label, size, need, len(list_intersect(list_distinct(w[i * (width // 2) + 1 : i * (width // 2) + width]), tokens)) AS held
  FROM (SELECT *, unnest(range(n // (width // 2) + 1)) AS i FROM near)),
hit AS (SELECT doc_id, label, max(held / size) AS containment FROM block WHERE held >= need GROUP BY doc_id, label),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM p UNION ALL SELECT doc_id, label FROM hit) GROUP BY doc_id),
best AS (SELECT doc_id, max(containment) AS containment FROM hit GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(containment, 0.0) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN best USING (doc_id)"""


def phrase_places(words: Column, phrase: str) -> Column:
    """Starts of the places where the words of ``phrase`` stand one after the other."""
    parts = phrase.split()
    last = F.size(words) - len(parts)

    def here(i: Column) -> Column:
        same = F.get(words, i) == parts[0]
        for n, part in enumerate(parts[1:], 1):
            same = same & (F.get(words, i + n) == part)
        return same

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(F.array().cast("array<int>"))


def _labelled(starts: Column, label: str) -> Column:
    return F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.alias("start")))


def license_matches(
    docs: DataFrame, text_col: str = "text", *, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD,
    words_col: str = "n_words", places_col: str = "places", matches_col: str = "matches",
) -> DataFrame:
    """``docs`` with the number of words, the places of ``phrases`` and the templates that some block of the text meets.

    ``places_col`` is an array of (label, start) with words from 0, by start;
    ``matches_col`` of (label, containment), the greatest containment of each label,
    by label.  Null, empty and wordless texts have 0 words and two empty arrays.
    Rows are treated one by one, so ids, null or repeated, don't matter; columns of these
    three names are replaced, all others stay.
    """
    rest = docs.drop(words_col, places_col, matches_col)
    everything = sorted({t for _, text in templates for t in text.split()})
    df = document_frequencies(docs, text_col, everything) if everything else {}
    rank = {t: i for i, t in enumerate(sorted(everything, key=lambda t: (df.get(t, 0), t)))}
    by_window: dict[int, list[tuple[str, str]]] = {}
    for label, text in templates:
        by_window.setdefault(window_of(len(text.split())), []).append((label, text))
    indexes = [_Index(w, some, rank, threshold) for w, some in sorted(by_window.items())]

    words, some = free_name(rest, "words"), free_name(rest, "some")
    of_hits = "array<struct<label:string,containment:double>>"
    of_places = "array<struct<label:string,start:int>>"
    # evaluated once: a generator's output isn't merged with the projections that read it
    out = docs.select(*(rest[c] for c in rest.columns), F.explode(F.array(words_of(F.col(text_col)))).alias(words))
    marks = sorted({t for index in indexes for t in index.prefixes} | {p.split()[0] for p, _ in phrases})
    out = out.withColumn(some, F.arrays_overlap(words, _strings(marks)) if marks else F.lit(False))
    out = out.withColumn(words_col, F.size(words).cast("long"))
    places = F.lit(None).cast(of_places)
    if phrases:
        found = [_labelled(phrase_places(F.col(words), p), label) for p, label in phrases]
        places = F.array_sort(F.concat(*found), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    out = out.withColumn(places_col, F.coalesce(F.when(F.col(some), places), F.array().cast(of_places)))
    hits = F.lit(None).cast(of_hits)
    if indexes:
        hits = F.concat(*(index.matches(F.col(words)) for index in indexes))
    out = out.withColumn(matches_col, F.coalesce(F.when(F.col(some), hits), F.array().cast(of_hits)))
    labels = F.array_sort(F.array_distinct(F.transform(matches_col, lambda h: h["label"])))
    best = F.transform(labels, lambda label: F.struct(label.alias("label"), F.array_max(F.transform(F.filter(matches_col, lambda h: h["label"] == label), lambda h: h["containment"])).alias("containment")))
    return out.withColumn(matches_col, best).drop(words, some)
