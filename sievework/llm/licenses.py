"""License scans: positional rare-token index.

Templates are licence notices as token sequences with mandatory key phrases. The
index maps each template's ``anchors`` highest-IDF words to (template, position).
A file is looked up by its licence words in order of IDF: a word at position p of
the file that a template has at position o votes for an alignment of the template
at p - o. Alignments on which enough distinct anchor words agree (positions may
slip by ``slack`` tokens) are verified: every mandatory phrase must occur
inside the aligned window and a share of the template's tokens must be there.

IDF comes from a first pass over all documents that counts, for the words of the
templates only, the documents that have them. The template set is fixed, so what
is sent to the executors does not grow with the corpus.

Defined results: null and empty texts have no licence; a text that carries a
notice several times yields one row per place; where templates overlap on the same
place the one with more matched tokens stays (ties: lower name). Repeated rows
each yield their rows. Tokens are compared in lower case.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.shared import table

TOKEN = re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")

#: licence -> notices: (text, mandatory phrases). Phrases are runs of the notice's tokens.
TEMPLATES: dict[str, list[tuple[str, tuple[str, ...]]]] = {
    "MIT": [
        ("Released under the MIT License", ("mit license",)),
        ("Licensed under the MIT License", ("mit license",)),
        ("SPDX-License-Identifier: MIT", ("spdx-license-identifier mit",)),
        (
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies",
            ("permission is hereby granted free of charge", "without restriction", "sublicense"),
        ),
    ],
    "Apache-2.0": [
        ("Licensed under the Apache License, Version 2.0", ("apache license version 2.0",)),
        ("SPDX-License-Identifier: Apache-2.0", ("spdx-license-identifier apache-2.0",)),
    ],
    "GPL-3.0": [
        ("This work is licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
        ("under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version", ("gnu general public license", "free software foundation", "version 3")),
        ("SPDX-License-Identifier: GPL-3.0-only", ("spdx-license-identifier gpl-3.0-only",)),
        ("SPDX-License-Identifier: GPL-3.0-or-later", ("spdx-license-identifier gpl-3.0-or-later",)),
    ],
    "GPL-2.0": [
        ("This work is licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
        ("under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or any later version", ("gnu general public license", "free software foundation", "version 2")),
        ("SPDX-License-Identifier: GPL-2.0-only", ("spdx-license-identifier gpl-2.0-only",)),
    ],
    "LGPL-3.0": [("This library is licensed under the GNU Lesser General Public License, version 3", ("gnu lesser general public license version 3",))],
    "AGPL-3.0": [("This program is licensed under the GNU Affero General Public License, version 3", ("gnu affero general public license version 3",))],
    "MPL-2.0": [("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license v 2.0",))],
    "BSD-3-Clause": [
        (
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            ("redistribution and use in source and binary forms", "permitted provided that the following conditions"),
        ),
        ("SPDX-License-Identifier: BSD-3-Clause", ("spdx-license-identifier bsd-3-clause",)),
    ],
    "ISC": [("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee is hereby granted",))],
    "CC-BY-4.0": [("Licensed under CC BY 4.0", ("cc by 4.0",)), ("licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4.0",))],
    "CC-BY-SA-4.0": [("Licensed under CC BY-SA 4.0", ("cc by-sa 4.0",))],
    "CC-BY-NC-4.0": [("Licensed under CC BY-NC 4.0", ("cc by-nc 4.0",)), ("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("creative commons attribution-noncommercial 4.0",))],
    "CC0-1.0": [("To the extent possible under law, the author has waived all copyright and related rights, CC0 1.0 Universal", ("cc0 1.0",))],
    "Unlicense": [("This is free and unencumbered software released into the public domain", ("free and unencumbered software released into the public domain",))],
}


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    phrases: tuple[tuple[str, ...], ...]


def templates(source: dict = TEMPLATES) -> list[Template]:
    return [Template(name, tuple(tokens(text)), tuple(tuple(tokens(p)) for p in phrases)) for name, notices in sorted(source.items()) for text, phrases in notices]


@dataclass
class LicenseIndex:
    """``postings``: rare word -> [(template number, position)]; ``idf`` ranks the words of a file."""

    items: list[Template]
    postings: dict[str, list[tuple[int, int]]]
    idf: dict[str, float]
    needed: list[int]
    slack: int = 3
    coverage: float = 0.6

    def find(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(licence, first token, one past the last token, share of the template's tokens found), by place."""
        if not text:
            return []
        toks = tokens(text)
        places = [i for i, t in enumerate(toks) if t in self.postings]
        if not places:
            return []
        votes: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for i in sorted(places, key=lambda i: (-self.idf[toks[i]], i)):
            for number, offset in self.postings[toks[i]]:
                votes[number].append((i - offset, toks[i]))
        hits = []
        for number, cast in votes.items():
            cast.sort()
            lo, inside = 0, Counter()
            starts: list[int] = []
            for start, word in cast:
                inside[word] += 1
                while start - cast[lo][0] > self.slack:
                    inside[cast[lo][1]] -= 1
                    inside += Counter()
                    lo += 1
                if len(inside) >= self.needed[number] and (not starts or start - starts[-1] > self.slack):
                    starts.append(start)
            hits += [h for s in starts if (h := self.verify(toks, number, s))]
        hits.sort(key=lambda h: (-h[3], h[0], h[1]))
        kept: list = []
        for h in hits:
            if all(h[2] <= k[1] or h[1] >= k[2] for k in kept):
                kept.append(h)
        return sorted(((h[0], h[1], h[2], h[4]) for h in kept), key=lambda h: (h[1], h[0]))

    def verify(self, toks: list[str], number: int, start: int) -> tuple[str, int, int, int, float] | None:
        t = self.items[number]
        a, b = max(0, start - self.slack), min(len(toks), start + len(t.words) + self.slack)
        window = toks[a:b]
        spans = []
        for phrase in t.phrases:
            n = len(phrase)
            at = next((i for i in range(len(window) - n + 1) if tuple(window[i : i + n]) == phrase), None)
            if at is None:
                return None
            spans.append((a + at, a + at + n))
        found = sum((Counter(window) & Counter(t.words)).values())
        share = found / len(t.words)
        if share < self.coverage:
            return None
        return t.name, min(s for s, _ in spans), max(e for _, e in spans), found, share


def document_frequencies(docs: DataFrame, items: list[Template]) -> tuple[int, dict[str, int]]:
    """(documents, documents with each word of the templates), over all of ``docs`` (text)."""
    vocabulary = frozenset(w for t in items for w in t.words)

    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df: Counter = Counter()
        for pdf in it:
            for text in pdf["text"]:
                df[""] += 1
                if text:
                    df.update(vocabulary.intersection(TOKEN.findall(text.lower())))
        yield pd.DataFrame(list(df.items()), columns=["word", "n"])

    rows = docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    got = {r["word"]: r["n"] for r in rows}
    return got.pop("", 0), got


def build_index(n_docs: int, df: dict[str, int], items: list[Template], anchors: int = 4) -> LicenseIndex:
    """The ``anchors`` highest-IDF words of each template, at all their positions."""
    idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 0.5)) for t in items for w in t.words}
    postings: dict[str, list[tuple[int, int]]] = defaultdict(list)
    needed = []
    for number, t in enumerate(items):
        rare = sorted(set(t.words), key=lambda w: (-idf[w], w))[:anchors]
        needed.append(max(1, (len(rare) + 1) // 2))
        for o, w in enumerate(t.words):
            if w in rare:
                postings[w].append((number, o))
    return LicenseIndex(items, dict(postings), idf, needed)


def scan(docs: DataFrame, index: LicenseIndex) -> DataFrame:
    """One row per notice found in ``docs`` (doc_id, text)."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [(i, *h) for i, text in zip(pdf["doc_id"], pdf["text"]) for h in index.find(text)]
            yield pd.DataFrame(rows, columns=["doc_id", "license", "start_token", "end_token", "coverage"])

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, license string, start_token long, end_token long, coverage double")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence notice in every document, with its place in tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = templates()
    n, df = document_frequencies(docs, items)
    return scan(docs, build_index(n, df, items)).withColumn("coverage", F.round("coverage", 6))
