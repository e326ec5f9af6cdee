"""License scan with a positional index of rare words.

Templates are notices and license texts. Document frequencies of all their words are counted over all documents;
each template is indexed by its words of highest inverse document frequency, with their positions. A file's rare
words are looked up in that index, and postings of a template that agree on its relative place vote for an
alignment, weighted by rarity. An alignment holds if every mandatory key phrase of the template stands around it and
enough of the template's words are in place. Fixed phrases are found besides.

Defined cases: null text is empty and has no words; repeated rows get equal results; ties go to the earlier
alignment. Other columns are kept. The index is as large as the templates, whatever the input.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.texts import map_texts, slices
from storeloom.llm.words import alphanumeric_words

# Fixed by the output contract: phrase and label.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

RARE_WORDS = 8
SLACK = 4
MIN_SHARE = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


# Public notices and license openings, with the phrases that must be present.
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
             " associated documentation files, to deal in the Software without restriction, including without limitation"
             " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
             ("permission is hereby granted free of charge", "without restriction")),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance"
             " with the License. You may obtain a copy of the License at", ("apache license", "except in compliance")),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
             " General Public License as published by the Free Software Foundation",
             ("free software", "general public license")),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             ("lesser general public license",)),
    Template("cc", "Licensed under CC BY-NC 4.0", ("cc by",)),
    Template("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"
             " provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "conditions are met")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"
             " is hereby granted", ("with or without fee is hereby granted",)),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("released into the public domain",)),
)


def _words(text: str) -> list[bytes]:
    return alphanumeric_words(text.encode())


VOCABULARY = frozenset(w for t in TEMPLATES for w in _words(t.text))


def phrase_places(words: list[bytes], phrase: list[bytes], start: int = 0, end: int | None = None) -> list[int]:
    """Where the phrase's words stand consecutively, overlapping places included."""
    end = len(words) if end is None else min(end, len(words))
    out, at = [], max(0, start)
    while True:
        try:
            at = words.index(phrase[0], at, max(at, end - len(phrase) + 1))
        except ValueError:
            return out
        if words[at:at + len(phrase)] == phrase:
            out.append(at)
        at += 1


class Index:
    """Postings of the templates' rarest words."""

    def __init__(self, document_counts: dict[bytes, int], documents: int):
        self.idf = {w: math.log((documents + 1) / (document_counts.get(w, 0) + 1)) + 1e-6 for w in VOCABULARY}
        self.templates = [(t.label, _words(t.text), [p.encode().split() for p in t.phrases]) for t in TEMPLATES]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, words, _) in enumerate(self.templates):
            for w in sorted(set(words), key=lambda w: (-self.idf[w], w))[:RARE_WORDS]:
                self.postings[w] += [(k, i) for i, x in enumerate(words) if x == w]
        self.rare = frozenset(self.postings)

    def find(self, words: list[bytes], distinct: frozenset[bytes]) -> dict[str, float]:
        """Label -> best share of a template's words found in place."""
        rare = distinct & self.rare
        if len(rare) < 2:
            return {}
        votes: dict[tuple[int, int], float] = defaultdict(float)
        seen: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        for at, w in enumerate(words):
            if w in rare:
                for k, i in self.postings[w]:
                    if w not in seen[k, at - i]:
                        seen[k, at - i].add(w)
                        votes[k, at - i] += self.idf[w]
        found: dict[str, float] = {}
        for (k, start), _ in sorted(votes.items(), key=lambda v: (v[0][0], -v[1], v[0][1])):
            label, template, phrases = self.templates[k]
            if len(seen[k, start]) < 2 or found.get(label, 0) >= 1:
                continue
            low, high = max(0, start - SLACK), start + len(template) + SLACK
            if all(phrase_places(words, p, low, high) for p in phrases):
                # In place: at its own offset, or shifted by at most SLACK words.
                held = sum(w in words[max(0, start + i - SLACK):start + i + SLACK + 1] for i, w in enumerate(template))
                share = held / len(template)
                if share >= MIN_SHARE:
                    found[label] = max(found.get(label, 0), share)
        return found


def document_counts(documents: DataFrame, text: Column) -> tuple[dict[bytes, int], int]:
    """In how many documents each template word occurs, and how many documents there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for _, texts in slices(batch):
                counts[b""] += len(texts)
                for value in texts:
                    counts.update(VOCABULARY.intersection(alphanumeric_words(value)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(counts.values(), pa.int64())],
                                         names=["word", "n"])

    rows = (documents.select(text.cast("string").cast("binary").alias("text")).mapInArrow(run, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    counts = {bytes(r["word"]): r["n"] for r in rows}
    return counts, counts.pop(b"", 0)


ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType())])


def scan(documents: DataFrame, text: Column, keep: tuple[str, ...] | None = None) -> DataFrame:
    """All rows (with all columns or those to keep) in struct ``row`` with word count, places of the fixed phrases, labels and score: the best share of a
    license's words in place, at least one half where only a fixed phrase is found, else 0."""
    counts = document_counts(documents, text)
    base = [(p.encode().split(), label) for p, label in BASE.items()]

    def run(parts: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        index = Index(*counts)
        for texts in parts:
            rows = []
            for value in texts:
                words = alphanumeric_words(value)
                distinct = VOCABULARY.intersection(words)
                places, labels = [], set()
                if b"license" in distinct:
                    for phrase, label in base:
                        at = phrase_places(words, phrase)
                        places += at
                        labels |= {label} if at else set()
                found = index.find(words, distinct)
                score = max([*found.values(), 0.5 if labels else 0.0])
                rows.append((len(words), len(places), min(places, default=None), max(places, default=None),
                             ",".join(sorted(labels)), ",".join(sorted(labels | found.keys())), score))
            yield [list(c) for c in zip(*rows, strict=True)]

    return map_texts(documents, text, ADDED, run, keep=keep)
