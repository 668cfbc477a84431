"""Licence scans by a positional rare-token index over licence templates.

Document frequencies of the templates' words are counted over all documents.  In each file the licence
words rare enough to tell something are looked up, rarest first, in the templates' positional postings; hits
that agree on the relative position of file and template are intersected, and a template whose matched
IDF weight is high enough is confirmed by its mandatory key phrases near that place.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Fixed values: (label, template, mandatory key phrases of which one has to stand there).
TEMPLATES = [
    ("mit", "this project is released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ["permission is hereby granted free of charge"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ["except in compliance with the license"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["general public license"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["general public license"]),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ["above copyright notice and this permission notice"]),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", ["unless required by applicable law or agreed to in writing"]),
    ("apache", "see the license for the specific language governing permissions and limitations under the license", ["specific language governing permissions and limitations"]),
    ("gpl", "either version 2 of the license or at your option any later version", ["at your option any later version"]),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", ["in the hope that it will be useful"]),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ["redistributions of source code must retain"]),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ["redistributions in binary form must reproduce"]),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ["endorse or promote products derived from this software"]),
    ("boost", "boost software license version 1 0", ["boost software license"]),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", ["accompanying documentation covered by this license"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ["in no event will the authors be held liable"]),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", ["must be plainly marked as such"]),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", ["eclipse public license"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ["waived all copyright and related"]),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", ["anyone is free to copy modify publish"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ["lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ["affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ["mozilla public license"]),
    ("cc", "this work is licensed under a creative commons attribution international license", ["creative commons"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software"]),
    ("reserved", "all rights reserved", ["all rights reserved"]),
]
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Edits that a template's copy may have between two of its words.
SLACK = 2


def words_of(text: str | None) -> list[bytes]:
    """Words after lowering A-Z only; bytes of the words, non-ASCII letters as they are."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def phrase_starts(words: list[bytes], phrase: list[bytes], low: int = 0, high: int | None = None) -> list[int]:
    """All starts in ``[low, high)`` of ``phrase``'s words standing consecutively, by way of its last word."""
    out, last, k = [], phrase[-1], len(phrase) - 1
    at, high = max(low, 0) + k, min(len(words), (len(words) if high is None else high) + k)
    while at < high:
        try:
            at = words.index(last, at, high)
        except ValueError:
            break
        if words[at - k : at + 1] == phrase:
            out.append(at - k)
        at += 1
    return out


class Scanner:
    """Index of the templates for given document frequencies."""

    def __init__(self, df: dict[bytes, int], n_docs: int, common: float = 0.05, least: float = 0.7):
        self.least = least
        self.idf = {w: math.log((n_docs + 1) / (c + 0.5)) for w, c in df.items()}
        self.base = [(p.encode().split(), label) for p, label in BASE]
        self.templates = [(label, t.encode().split(), [k.encode().split() for k in keys]) for label, t, keys in TEMPLATES]
        rare = math.log((n_docs + 1) / (common * n_docs + 1.5))
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.total = []
        for t, (_, words, keys) in enumerate(self.templates):
            weights = [self.idf.get(w, 0.0) for w in words]
            self.total.append(sum(weights))
            best = set(sorted(range(len(words)), key=lambda i: -weights[i])[:3])
            for i, w in enumerate(words):
                if weights[i] >= rare or i in best:
                    self.postings[w].append((t, i))
        self.words = frozenset(self.postings)

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str], set[str], float]:
        """(base starts, base labels, all labels, score): score is the best template's matched weight."""
        starts, base, labels, score = [], set(), set(), 0.0
        for phrase, label in self.base:
            if found := phrase_starts(words, phrase):
                starts += found
                base.add(label)
        held = self.words.intersection(words)
        if held:
            places = defaultdict(list)
            for i, w in enumerate(words):
                if w in held:
                    places[w].append(i)
            by_shift: dict[tuple[int, int], set[int]] = defaultdict(set)
            for w in sorted(held, key=lambda w: (-self.idf.get(w, 0), w)):
                for i in places[w]:
                    for t, p in self.postings[w]:
                        by_shift[t, i - p].add(p)
            for (t, shift), hits in by_shift.items():
                label, template, keys = self.templates[t]
                if len(hits) < min(2, len(template)) and self.total[t] > 0:
                    continue
                at = set()
                for i in range(len(template)):
                    low = max(0, shift + i - SLACK)
                    if template[i] in words[low : max(0, shift + i + SLACK + 1)]:
                        at.add(i)
                got = sum(self.idf.get(template[i], 0.0) for i in at) / self.total[t] if self.total[t] else 0.0
                if got < self.least:
                    continue
                if any(phrase_starts(words, k, shift - SLACK, shift + len(template) + SLACK) for k in keys):
                    labels.add(label)
                    score = max(score, min(1.0, got))
        return starts, base, base | labels, score


def document_frequencies(documents: DataFrame) -> tuple[dict[bytes, int], int]:
    """Documents that hold each template word, and the number of documents; the table's size is fixed."""
    vocabulary = frozenset(w for _, t, _ in TEMPLATES for w in t.encode().split())

    def run(batches):
        seen, n = Counter(), 0
        for pdf in batches:
            for text in pdf["text"]:
                n += 1
                seen.update(vocabulary.intersection(words_of(text)))
        yield pd.DataFrame({"word": [*(w.decode() for w in seen), ""], "n": [*seen.values(), n]})

    rows = documents.select("text").mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    n_docs = found.pop("", 0)
    return {w: found.get(w.decode(), 0) for w in vocabulary}, n_docs


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(documents: DataFrame, common: float = 0.05, least: float = 0.7) -> DataFrame:
    """Licence labels of each row of ``documents(doc_id, text)``; ``SCHEMA``.

    ``common``: a word in more than this share of documents is looked up only as one of its template's three
    rarest; ``least``: the share of a template's IDF weight that has to match.  A null or empty text has no words,
    no labels and score 0; repeated rows give repeated rows; an empty table an empty result; other columns are
    ignored.  Two passes over the texts and no shuffle of them.
    """
    df, n_docs = document_frequencies(documents)

    def run(batches):
        scanner = Scanner(df, n_docs, common, least)
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                words = words_of(text)
                starts, base, labels, score = scanner.scan(words)
                out.append((len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")][1:])
            frame.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield frame.astype({"doc_id": "Int64", "first_word": "Int64", "last_word": "Int64"})

    return documents.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, SCHEMA)
