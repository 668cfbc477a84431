"""Benchmark decontamination: rare word-pair seeds, then Smith-Waterman alignment.

A seed is a pair of words that stand next to each other or one word apart, in the item as in the document, so that a
substituted, inserted or deleted word between them doesn't hide it.  An alignment that reaches ``least`` of a perfect
copy's score (2 for a match, -1 for any edit) has n matches and e edits with 2 n - e >= 2 least N for an item of N words, and
at most e / 2 of the steps between its matches span more than one edit.  So it has seeds at ``least`` N - 1 places of the item
or more, and any choice of all places but that many less c holds c of them: an item is entered in the index at its
rarest such places only, and nothing that aligns is lost, however many documents or items hold a seed.

Where a document has c of them within the length of an alignment, the words and all seeds of the item are counted
there; what can still reach the score is aligned.  Items go to the tasks in blocks of a fixed size, each block against all documents.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

WORD = re.compile(r"\w+")
#: Characters of items in a block, which bounds what a task holds.
BLOCK_CHARS = 16_000_000
#: Pairs of a document's seeds with items' that are looked at together.
PAIRS = 2_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
SCHEMA = "doc_id long, item_id long, score double, first_word long, end_word long"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman with linear gaps: (best score, first, end) of the part of ``b`` that aligns with ``a``.

    Row by row; a gap along ``b`` within a row is a running maximum.  Starts travel with the scores.
    """
    n = len(b)
    step = np.arange(n + 1)
    h, start = np.zeros(n + 1, np.int64), step.copy()
    best = (0, 0, 0)
    for x in a:
        up = h + GAP
        new, by = up.copy(), start.copy()
        diagonal = h[:-1] + np.where(b == x, MATCH, MISMATCH)
        better = diagonal >= up[1:]
        new[1:][better], by[1:][better] = diagonal[better], start[:-1][better]
        off = new <= 0
        new[off], by[off] = 0, step[off]
        lifted = new - GAP * step
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, step, 0))
        run = top + GAP * step
        grow = run > new
        new[grow], by[grow] = run[grow], by[source[grow]]
        h, start = new, by
        k = int(h.argmax())
        if h[k] > best[0]:
            best = (int(h[k]), int(start[k]), k)
    return best


def pair_codes(ids: np.ndarray, apart: int) -> np.ndarray:
    """Hash of each pair of ids ``apart`` places from each other; 0 where one of them is no word of the items."""
    a, b = ids[: max(0, len(ids) - apart)].astype(np.uint64), ids[apart:].astype(np.uint64)
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ b
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    return np.where((a > 0) & (b > 0), h, 0).astype(np.uint64)


class Index:
    """Seeds of a block of items at their rarest places."""

    def __init__(self, items: list[tuple[int, str]], least: float = 0.5):
        texts = [(i, words_of(t)) for i, t in items]
        self.item = [(i, w) for i, w in texts if w]
        self.least = least
        self.id: dict[str, int] = {}
        for _, w in self.item:
            for x in w:
                self.id.setdefault(x, len(self.id) + 1)
        self.words = [np.array([self.id[x] for x in w], np.int64) for _, w in self.item]
        self.length = np.array([len(w) for w in self.words], np.int64)
        #: Places with seeds that a copy has at least, those of them that are in the index, and words that its place in the document can drift by.
        self.need = np.maximum(1, np.ceil(least * self.length - 1e-9).astype(np.int64) - 1)
        self.several = np.maximum(1, self.need // 3)
        self.drift = np.floor(2 * self.length * (1 - least) + 1e-9).astype(np.int64)
        none = np.zeros(0, np.int64)
        self.codes, of, place = [], [none], [none]
        for j, w in enumerate(self.words):
            one, two = (pair_codes(w, 1), pair_codes(w, 2)) if len(w) > 1 else (w.astype(np.uint64), none.astype(np.uint64))
            self.codes.append(np.concatenate([one, two]))
            of.append(np.full(len(one) + len(two), j))
            place += [np.arange(len(one)), np.arange(len(two))]
        of, place = np.concatenate(of), np.concatenate(place)
        _, seed, times = np.unique(np.concatenate([none.astype(np.uint64), *self.codes]), return_inverse=True, return_counts=True)
        keep = np.zeros(len(of), bool)
        ends = np.cumsum([len(c) for c in self.codes])
        for j, (a, b) in enumerate(zip(ends - [len(c) for c in self.codes], ends)):
            often = np.zeros(place[a:b].max() + 1, np.int64)
            np.maximum.at(often, place[a:b], times[seed[a:b]])
            rare = np.argsort(often, kind="stable")[: max(1, len(often) - self.need[j] + self.several[j])]
            keep[a:b] = np.isin(place[a:b], rare)
        of, place = of[keep], place[keep]
        self.known, seed = np.unique(np.concatenate([none.astype(np.uint64), *self.codes])[keep], return_inverse=True)
        #: Places of the seeds, in order of (seed, item): keys are seed * number of items + item.
        order = np.lexsort((place, of, seed))
        self.keys, self.of, self.place = (seed * len(self.words) + of)[order], of[order], place[order]
        self.single = bool((self.length == 1).any())
        # most words of a text start no seed; a table of hash bits says so at once
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def find(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word ids of the text; place and number of each indexed seed that stands in it."""
        get = self.id.get
        ids = np.array([get(w, 0) for w in words_of(text)], np.int64)
        places, seeds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for codes in [pair_codes(ids, 1), pair_codes(ids, 2), *([ids.astype(np.uint64)] if self.single else [])]:
            at = np.flatnonzero((codes > 0) & self.bits[(codes & np.uint64((1 << 22) - 1)).astype(np.int64)])
            if len(at):
                k = np.minimum(np.searchsorted(self.known, codes[at]), len(self.known) - 1)
                hit = self.known[k] == codes[at]
                places.append(at[hit])
                seeds.append(k[hit])
        return ids, np.concatenate(places), np.concatenate(seeds)

    def joined(self, at: np.ndarray, seed: np.ndarray, low: int, high: int):
        """Items ``low`` to ``high`` that hold the seeds: (item, place in it, place in the text), all places of an item together."""
        first = np.searchsorted(self.keys, seed * len(self.words) + low)
        count = np.searchsorted(self.keys, seed * len(self.words) + high) - first
        total = int(count.sum())
        if total > PAIRS and high - low > 1:
            middle = (low + high) // 2
            yield from self.joined(at, seed, low, middle)
            yield from self.joined(at, seed, middle, high)
        elif total:
            k = np.repeat(first - np.cumsum(count) + count, count) + np.arange(total)
            yield self.of[k], self.place[k], np.repeat(at, count)

    def hits(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item number, score, first word, end word) of the best alignment of each item that reaches ``least``."""
        ids, at, seed = self.find(text)
        out = []
        for item, place, at_ in self.joined(at, seed, 0, len(self.words)):
            # seeds from which on there are enough in an alignment's length
            order = np.lexsort((at_, item))
            item, place, at_ = item[order], place[order], at_[order]
            stride = len(ids) + int(self.length.max() + self.drift.max()) + 1
            last = np.searchsorted(item * stride + at_, item * stride + at_ + self.length[item] + self.drift[item], "right")
            keep = last - np.arange(len(item)) >= self.several[item]
            item, shift = item[keep], (at_ - place)[keep]
            order = np.lexsort((shift, item))
            item, shift = item[order], shift[order]
            low = np.maximum(0, shift - self.drift[item])
            high = np.minimum(len(ids), shift + self.drift[item] + self.length[item])
            edges = np.flatnonzero(np.diff(item, prepend=-1, append=-1)) if len(item) else []
            for a, b in zip(edges[:-1], edges[1:]):
                best = self.best(int(item[a]), ids, low[a:b], high[a:b])
                if best:
                    out.append((int(item[a]), best[0] / (MATCH * len(self.words[item[a]])), best[1], best[2]))
        return out

    def best(self, j: int, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[int, int, int] | None:
        """(score, first word, end word) of the best alignment of an item in windows of a text, if it reaches ``least``.

        Windows with too few of the item's words or seeds for that are left out; those that overlap are aligned as one.
        """
        item, base = self.words[j], int(low[0])
        n, best = len(item), None
        part = ids[base : high[-1]]

        def enough(found: np.ndarray, least: float) -> np.ndarray:
            have = np.concatenate([[0], np.cumsum(found)])
            return have[np.minimum(high - base, len(found))] - have[np.minimum(low - base, len(found))] >= least

        good = enough(np.isin(part, item), self.least * n)
        if n > 1 and good.any():
            seeds = np.zeros(len(part), bool)
            for apart in (1, 2):
                seeds[: max(0, len(part) - apart)] |= np.isin(pair_codes(part, apart), self.codes[j])
            good &= enough(seeds, self.need[j])
        low, high = low[good], high[good]
        if not len(low):
            return None
        known, times = np.unique(item, return_counts=True)
        cut = np.flatnonzero(low[1:] > high[:-1])
        for x, y in zip(low[np.r_[0, cut + 1]].tolist(), high[np.r_[cut, len(high) - 1]].tolist()):
            part = ids[x:y]
            inside = part[np.isin(part, known)]
            if np.minimum(np.bincount(np.searchsorted(known, inside), minlength=len(known)), times).sum() < self.least * n:
                continue
            score, first, end = align(item, part)
            if score >= self.least * MATCH * n and (best is None or score > best[0]):
                best = (score, x + first, x + end)
        return best


def _blocks(benchmark: DataFrame, chars: int, least: float):
    """The items in blocks of about ``chars`` characters, collected one at a time."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    sized = items.select("*", F.char_length("text").cast("long").alias("_size"))
    total = sized.agg(F.sum("_size")).first()[0] or 0
    shares = -(-total // chars)
    todo = [(shares, k) for k in range(shares)]
    while todo:
        n, k = todo.pop()
        part = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        size, count = part.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.count("*")).first()
        if size > 2 * chars and count > 1 and n < 1 << 40:  # an uneven share is dealt again
            todo += [(2 * n, k), (2 * n, k + n)]
        elif count:
            rows = part.select("item_id", "text").orderBy("item_id", "text").toArrow().to_pylist()
            yield Index([(r["item_id"], r["text"]) for r in rows], least)


def contaminated(documents: DataFrame, benchmark: DataFrame, least: float = 0.5, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Hits of ``benchmark(item_id, text)`` in ``documents(doc_id, text)``; one row for a document and item, ``SCHEMA``.

    ``least``: share of a perfect copy's alignment score; words count from 0, ``end_word`` exclusive.  Null or empty
    texts and items without words match nothing; rows with a null item_id are skipped; items with several texts
    give a row for each that hits; a copy shares a pair of words (an item of one word: that word) at least; repeated rows repeat their hits; an empty table gives an empty result.
    Whole texts are read once for each block and never shuffled.
    """
    small_batches(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for index in _blocks(benchmark, block_chars, least):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches, shared=shared):
            index = shared.value
            for pdf in batches:
                rows = [(doc, index.item[j][0], score, a, b) for doc, text in zip(pdf["doc_id"], pdf["text"]) for j, score, a, b in index.hits(text)]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"doc_id": "Int64"})

        hits = docs.mapInPandas(search, SCHEMA)
        out = hits if out is None else out.unionByName(hits)
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``documents`` without those that hold a copy of an item; null doc_ids stay."""
    return documents.join(contaminated(documents, benchmark, **options).select("doc_id").distinct(), "doc_id", "left_anti").select(documents.columns)
