"""License scans: an exact set-similarity join of text blocks with license templates.

A block holds a template when at least ``NUM / DEN`` of the template's distinct
words stand in it.  Blocks are lines for the one-line notices, and paragraphs
(lines up to an empty one) for the notices of several lines.

1. Frequencies.  The templates' words are counted over all blocks of all
   documents (partial counts in each task, one row per word to the driver,
   which the templates bound) and ordered globally, rare ones first.
2. Prefix filter.  A template of n words of which k are required can't be held
   by a block without any of its n - k + 1 rarest words: only these are
   looked up, in an index from word to templates.
3. Length filter.  A block with fewer than k distinct words is no candidate.
4. Positional filter.  Where the rarest shared word stands at place i of the
   template and at place j among the block's words in the same order, at most
   ``min(n - i, m - j)`` words can be shared.
5. Candidates that are left are counted exactly.

Every held template is found; where a block holds several (one notice's words
are among another's), the closest are marked: the largest share, then the
longest template.

Documents are read in Arrow batches beside the scan, with no shuffle of texts;
the templates are broadcast (their size is checked).

The base search runs beside it: places where a phrase's words stand
consecutively, found from the places of the phrase's last word.

Cases: a null text is an empty one; texts without words have no finding;
rows without an id, repeated rows and rows that share an id are each
answered; findings are ordered by first word, then label; other columns are
kept, columns named as the results are replaced.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import array_chunks, utf8_views

#: Share of a template's distinct words that a block must hold.
NUM, DEN = 8, 10
#: Bytes of all templates together that are broadcast.
TEMPLATE_BYTES = 4 << 20

# Phrases and labels of the base search.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# One-line notices, and opening or whole texts of public license notices.
LINES = {
    "mit": ["Released under the MIT License."],
    "apache": ["Licensed under the Apache License, Version 2.0."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "bsd": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "reserved": ["All rights reserved."],
}
PARAGRAPHS = {
    "mit": ["""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:"""],
    "apache": ["""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at"""],
    "gpl": ["""This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version."""],
    "bsd": ["""Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:"""],
    "isc": ["""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""],
    "unlicense": ["""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""],
}

_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Words stay, A-Z become a-z, line ends stay, all else becomes a blank.
TABLE = bytes(b if b in _KEEP or b == 10 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
FOUND = ("struct<n_words:bigint,places:array<struct<label:string,word:bigint,words:int>>,"
         "blocks:array<struct<label:string,template:int,first_word:bigint,words:bigint,shared:int,size:int,closest:boolean>>>")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class Templates:
    """Templates as sets of words, with the words' global order once it is known."""

    def __init__(self, lines=LINES, paragraphs=PARAGRAPHS, num: int = NUM, den: int = DEN, phrases=PHRASES):
        self.num, self.den = num, den
        self.label, self.words, self.kind = [], [], []
        for kind, texts in (("line", lines), ("paragraph", paragraphs)):
            for label in sorted(texts):
                for text in texts[label]:
                    if own := frozenset(words_of(text.encode())):
                        self.label.append(label)
                        self.words.append(own)
                        self.kind.append(kind)
        self.vocabulary = frozenset().union(*self.words) if self.words else frozenset()
        self.phrases = [(tuple(words_of(p.encode())), label) for p, label in phrases.items()]
        self.required = [-(-num * len(w) // den) for w in self.words]
        if sum(map(len, self.vocabulary)) > TEMPLATE_BYTES:
            raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes of words are not broadcast")

    def ordered(self, counts: dict[bytes, int]) -> "Templates":
        """With the index of each template's prefix: its rarest words, one more than it may lack."""
        rank = {w: k for k, w in enumerate(sorted(self.vocabulary, key=lambda w: (counts.get(w, 0), w)))}
        self.rank = rank
        self.index = {"line": defaultdict(list), "paragraph": defaultdict(list)}
        for t, own in enumerate(self.words):
            listed = sorted(own, key=rank.__getitem__)
            for i, w in enumerate(listed[:len(listed) - self.required[t] + 1]):
                self.index[self.kind[t]][w].append((t, i))
        self.starts = {k: frozenset(v) for k, v in self.index.items()}
        self.any_start = frozenset().union(*self.starts.values())
        return self

    def held(self, kind: str, words: list[bytes]) -> list[tuple[int, int]]:
        """(template, shared words) of the templates that a block of these words holds."""
        own = frozenset(words)
        rare = own & self.starts[kind]
        if not rare:
            return []
        # The block's words in the same global order; words of no template stand behind all others.
        known = sorted(own & self.vocabulary, key=self.rank.__getitem__)
        out, seen = [], set()
        for j, w in enumerate(known):
            if w not in rare:
                continue
            for t, i in self.index[kind][w]:
                if t in seen:
                    continue
                # Words come in order, so this is the pair's first shared word of the prefix.
                seen.add(t)
                need = self.required[t]
                if len(own) < need or min(len(self.words[t]) - i, len(known) - j) < need:
                    continue
                if (shared := len(self.words[t] & own)) >= need:
                    out.append((t, shared))
        return out

    def closest(self, held: list[tuple[int, int]]) -> set[int]:
        """Of the templates that a block holds, those with the largest share, the longest of them (ties: all)."""
        fit = {t: (Fraction(shared, len(self.words[t])), len(self.words[t])) for t, shared in held}
        return {t for t, f in fit.items() if f == max(fit.values())}


def _blocks(text: bytes):
    """(kind, first word, words) of the lines, and of the paragraphs of several lines."""
    at, paragraph, start, lines = 0, [], 0, 0
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            if not lines:
                start = at
            yield "line", at, words
            paragraph += words
            lines += 1
            at += len(words)
        elif lines:
            yield "paragraph", start, paragraph
            paragraph, lines = [], 0
    if lines:
        yield "paragraph", start, paragraph


def scan(text: bytes, templates: Templates):
    """Number of words, places of the phrases, blocks that hold templates."""
    clean = text.translate(TABLE)
    words = clean.split()
    present = frozenset(words)
    places = []
    for phrase, label in templates.phrases:
        if present.issuperset(phrase):
            last, n, at = phrase[-1], len(phrase), -1
            try:
                while True:
                    at = words.index(last, at + 1)
                    if at >= n - 1 and tuple(words[at - n + 1:at + 1]) == phrase:
                        places.append((label, at - n + 1, n))
            except ValueError:
                pass
    blocks = []
    if not present.isdisjoint(templates.any_start):
        for kind, at, own in _blocks(clean):
            if held := templates.held(kind, own):
                closest = templates.closest(held)
                blocks += [(templates.label[t], t, at, len(own), shared, len(templates.words[t]), t in closest)
                           for t, shared in held]
    places.sort(key=lambda p: (p[1], p[0]))
    blocks.sort(key=lambda b: (b[2], b[0], b[1]))
    return len(words), places, blocks


def frequencies(docs: DataFrame, text: str, templates: Templates) -> dict[bytes, int]:
    """How often each word of the templates stands in the texts; at most as many rows as the templates have words."""
    vocabulary = templates.vocabulary

    def run(batches):
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for part in array_chunks(batch.column(0)):
                for t in utf8_views(part):
                    counts.update(filter(vocabulary.__contains__, t.translate(TABLE).split()))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                             names=["word", "n"])

    rows = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "word binary, n bigint")
    return {bytes(r["word"]): r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def find(docs: DataFrame, text: str = "text", templates: Templates | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``places`` (base phrases) and ``blocks`` (held templates)."""
    templates = templates or Templates()
    spark = docs.sparkSession
    docs = docs.drop("n_words", "places", "blocks")
    templates.ordered(frequencies(docs, text, templates))
    sent = spark.sparkContext.broadcast(templates)
    place = pa.struct([("label", pa.string()), ("word", pa.int64()), ("words", pa.int32())])
    block = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("words", pa.int64()),
                       ("shared", pa.int32()), ("size", pa.int32()), ("closest", pa.bool_())])

    def structs(rows, kind):
        return [[dict(zip([f.name for f in kind], r, strict=True)) for r in own] for own in rows]

    def run(batches):
        known = sent.value
        for batch in batches:
            got = [scan(t, known) for part in array_chunks(batch) for t in utf8_views(part)]
            yield pa.StructArray.from_arrays(
                [pa.array([g[0] for g in got], pa.int64()), pa.array(structs((g[1] for g in got), place), pa.list_(place)),
                 pa.array(structs((g[2] for g in got), block), pa.list_(block))], names=["n_words", "places", "blocks"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    got = docs.withColumn("__found", F.arrow_udf(run, returnType=FOUND)(F.col(text).cast("string")))
    return got.select(*[F.col(f"`{c}`") for c in docs.columns], "__found.*")


def labels(*found: Column) -> Column:
    """The distinct labels of the findings, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.transform(f, lambda x: x["label"]) for f in found]))), ",")


def score(places: Column, blocks: Column) -> Column:
    """The largest share of a template's words that a block holds; 1 where a phrase stands, 0 without findings."""
    best = F.array_max(F.transform(blocks, lambda b: b["shared"].cast("double") / b["size"]))
    return F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0)))
