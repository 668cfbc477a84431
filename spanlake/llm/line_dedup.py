"""Line dedup: an exact set-similarity join over all lines of all documents.

A line is the set of its lower-case words.  Lines are ordered by document and place; a line is removed if any
earlier line of the corpus has a Jaccard similarity of at least ``percent`` % with it (equal sets included).

Equal sets are one class with its earliest line.  Classes are joined by prefix filtering: tokens are in one
global order, rarest first, and two sets can only be similar if they share one of their first
n - ceil(t n) + 1 tokens; a shared token also has to leave enough tokens after it (positional filter), the sizes
have to fit (length filter), and the parities of their words' hashes must not differ in more bits than
similar sets can differ in words (bitmap filter).  Candidates are verified on the words themselves.

Texts are read again instead of carrying sets of words from step to step: only postings (one for each prefix
token, packed by hash of the token) and the words of candidates are shuffled.  Every list of postings is searched within one task in numpy, where
each line hands out its earlier lines, or the ``NEAREST`` if there are over ``FEW``.  Lists of over ``WIDE`` lines are first split by a second token:
similar sets share two of their first n - ceil(t n) + 2 tokens, the first of them within the prefix, so a posting of a frequent token also
carries short hashes of the tokens after it up to there, and a line is only compared with lines that share one of these.  As the first two tokens that
two sets share, both leave enough tokens after them (positional filter by the second), so a line stays out of lists where it fits nobody.  Lists that this doesn't settle (a line without a match has more
candidates there, or the list is long) go in rounds of hubs: the earliest line of each of ever more hashed parts of a list is
paired with the lines after it that aren't matched yet, until each member has been a hub or no unmatched line is left after it.  Only lines that come before
an unmatched one go there, and where a list has few unmatched ones (``SEEKERS``), only those that pass the filters with one of them.
So no line's earlier match is missed, and no group's pairs are all made.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, scratch
from .line_words import chunks, mix

TOKEN = re.compile(r"\w+")
#: Bits of the table of token counts (a byte for each hash value, 8 MB).  It gives the order of the tokens and tells which can't be
#: shared; a full table makes lists longer but changes no result.
SLOTS = 23
SEGMENT = 15
#: Candidates that a line hands out from one list: all of them if there are no more than FEW, else the NEAREST at first.
NEAREST, FEW = 8, 32
#: Longest list that is searched whole in numpy; longer ones go in rounds, after each line was compared with its NEIGHBOURS by size.
LONG, NEIGHBOURS = 2048, 64
#: Longest list that is searched as it is; longer ones are split by a second token.
WIDE = 768
#: Order (8 log2 of the count) from which on a token's postings carry what splits their list.
PAIRED = 8 * 9
#: Order (8 log2 of the count) from which on a token's postings are dealt by line instead of being gathered: 2**19 lines.
SPREAD = 8 * 19
#: Most hubs of a list in one array.
HUBS = 1024
#: Unmatched lines of a list that are held against all lines before them at once, and the hashed parts in which they are told apart.
SEEKERS, PARTS = 64, 4096
#: Bits of the table that says which lines are wanted.
WANTED = 25
_U = np.uint64
POSTING = "key long, c long, size long, map long, map2 long, map3 long, map4 long, doc long, line int"
NAMES = [x.split()[0] for x in POSTING.split(", ")]
#: Sets of more words have parities of 128 bits, or 256.
TWO, FOUR = 72, 180
#: Postings that are searched together in a task, about.
BUCKET = 500_000


def line_tokens(line: str) -> list[str]:
    """Sorted distinct lower-case words of a line."""
    return sorted(set(TOKEN.findall(line.lower())))


def prefix_length(n, percent: int):
    """Tokens of which a set of ``n`` has to share one with any set at ``percent`` % similarity."""
    return n - -(-percent * n // 100) + 1


def least_size(percent: int) -> int:
    """A set of fewer words can be similar only to an equal one."""
    least = 1
    while (least + 1) * percent > least * 100:
        least += 1
    return least


def _read(batches):
    """Chunks of lines of batches of doc_id, version, text: ((doc_id, version) of each line, its number, Lines)."""
    for pdf in batches:
        rows = (((d, v), t) for d, v, t in zip(pdf["doc_id"].tolist(), pdf["version"].tolist(), pdf["text"]))
        for keys, first, found in chunks(rows):
            own = np.array(keys, np.int64).reshape(-1, 2)[found.owner]
            yield own, first[found.owner] + found.line, found


def _first_of_class(found) -> np.ndarray:
    """Index of the first line of each class in a chunk, in order."""
    order = np.argsort(found.c, kind="stable")
    c, c2 = found.c[order], found.c2[order]
    new = np.ones(len(order), bool)
    new[1:] = (c[1:] != c[:-1]) | (c2[1:] != c2[:-1])
    return np.sort(order[new])


def _select(found, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the lines ``keep``, the place of each one's line in ``keep``, and where each line's words start."""
    n = found.n[keep]
    start = np.cumsum(n) - n
    own = np.repeat(np.arange(len(keep)), n)
    return found.words[np.repeat(found.first[keep] - start, n) + np.arange(len(own))], own, start


def _gathered(parts, rows: int = 50_000):
    """Dictionaries of columns, joined to ones of about ``rows`` rows."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part["c"])
        if size >= rows:
            yield {k: np.concatenate([x[k] for x in held]) for k in held[0]}
            held, size = [], 0
    if size:
        yield {k: np.concatenate([x[k] for x in held]) for k in held[0]}


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``n`` numbers from each ``first`` on, one after the other."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _documents(documents: DataFrame, versions: bool = False) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null and text <> ''")
    return docs.select("doc_id", (F.xxhash64("text") if versions else F.lit(0).cast("long")).alias("version"), "text")


def lines_and_counts(documents: DataFrame, percent: int) -> DataFrame:
    """Every line with words (doc_id, version, line, c, c2), and counts of words by hash slot (segment, counts), in one read.

    Segment -1 counts the postings to come.
    """
    names = ["doc_id", "version", "line", "c", "c2", "segment", "counts"]

    def run(batches):
        table, total = np.zeros(1 << SLOTS, np.int32), 0

        def rows():
            nonlocal total
            for own, line, found in _read(batches):
                total += int(prefix_length(found.n, percent).sum())
                slots = np.sort((found.words & _U((1 << SLOTS) - 1)).astype(np.uint32))
                first = np.flatnonzero(np.append(True, slots[1:] != slots[:-1])) if len(slots) else slots
                table[slots[first]] += np.diff(np.append(first, len(slots))).astype(np.int32)
                yield {"doc_id": own[:, 0], "version": own[:, 1], "line": line, "c": found.c, "c2": found.c2}

        for part in _gathered(rows()):
            frame = pd.DataFrame(part)
            yield frame.assign(segment=pd.Series([None] * len(frame), dtype="Int64"), counts=None)
        slots = np.flatnonzero(table)
        cut = np.searchsorted(slots, np.arange(0, (1 << SLOTS) + 1, 1 << SEGMENT))
        held = (slots << 32) | table[slots]
        out = pd.DataFrame([(k, held[a:b].astype("<i8").tobytes()) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a] + [(-1, total.to_bytes(8, "little"))], columns=names[5:])
        yield out.reindex(columns=names).astype({k: "Int64" for k in names[:6]})

    return _documents(documents, True).mapInPandas(run, "doc_id long, version long, line int, c long, c2 long, segment int, counts binary")


def token_order(read: DataFrame) -> tuple[np.ndarray, int]:
    """8 log2 of the number of lines that hold a word of each hash slot (0: one line or none), a byte each; the number of postings."""

    def run(batches):
        tables: dict[int, np.ndarray] = {}
        total = 0
        for pdf in batches:
            for segment, counts in zip(pdf["segment"].tolist(), pdf["counts"]):
                if segment < 0:
                    total += int.from_bytes(counts, "little")
                    continue
                own = tables.setdefault(segment, np.zeros(1 << SEGMENT, np.int64))
                held = np.frombuffer(counts, "<i8")
                own[(held >> 32) & ((1 << SEGMENT) - 1)] += held & 0xFFFFFFFF
        if total:
            yield pd.DataFrame({"segment": [-1], "part": [total.to_bytes(8, "little")]})
        for segment, own in tables.items():
            yield pd.DataFrame({"segment": [segment], "part": [np.minimum(255, np.round(8 * np.log2(np.maximum(own, 1)))).astype(np.uint8).tobytes()]})

    parts = read.where("segment is not null").select("segment", "counts").repartition("segment").mapInPandas(run, "segment int, part binary")
    out, total = np.zeros(1 << SLOTS, np.uint8), 0
    for r in parts.toArrow().to_pylist():
        if r["segment"] < 0:
            total += int.from_bytes(r["part"], "little")
        else:
            out[r["segment"] << SEGMENT : (r["segment"] + 1) << SEGMENT] = np.frombuffer(r["part"], np.uint8)
    return out, total


def parities(words: np.ndarray, start: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """Parities of each set's words by bits of their hashes: 64 bits, and for larger sets what splits them into 128 or 256."""
    bit = _U(1) << ((words >> _U(17)) & _U(63))
    out = {k: np.zeros(len(n), _U) for k in ("map", "map2", "map3", "map4")}
    out["map"] = np.bitwise_xor.reduceat(bit, start)
    large = np.flatnonzero(n > TWO)
    if len(large):
        size = n[large]
        first = np.cumsum(size) - size
        at = np.repeat(start[large] - first, size) + np.arange(size.sum())
        bit, quarter = bit[at], (words[at] >> _U(15)) & _U(3)
        fold = lambda of: np.bitwise_xor.reduceat(np.where(of, bit, _U(0)), first)
        out["map2"][large] = fold(quarter & _U(1) == 1)
        for name, k in (("map3", 2), ("map4", 3)):
            out[name][large] = np.where(size > FOUR, fold(quarter == k), _U(0))
    return {k: v.view(np.int64) for k, v in out.items()}


def tokens_after(key: np.ndarray, size: np.ndarray, percent: int, spread: int = SPREAD, paired: int = PAIRED) -> np.ndarray:
    """How many tokens after its own each posting carries: those among the set's first ``prefix_length`` + 1."""
    if least_size(percent) * percent <= 100:  # sets might be similar by one word
        return np.zeros(len(key), np.int64)
    n, order = size >> 31, key >> 39
    return np.where((order >= paired) & (order < spread), prefix_length(n, percent) - (size & ((1 << 31) - 1)), 0)


def postings(documents: DataFrame, order: np.ndarray, percent: int, buckets: int, spread: int = SPREAD, paired: int = PAIRED) -> DataFrame:
    """Prefix postings of the words that several lines may share, packed: ``bucket`` and the columns of ``POSTING`` as binaries.

    key: place of the word in the global order (8 bits of count, 39 of hash; words of one key count as one); c: class; size: the set's
    number of words and below it the number of those before this one (31 bits); map...: see ``parities``; doc, line: first line of the
    class that was seen; after: 16 bits of hash of each of the ``tokens_after``.  A key's postings share a bucket; those of frequent words, which are only passed on, are dealt by class.
    """
    sent = documents.sparkSession.sparkContext.broadcast(order.tobytes())
    least = least_size(percent)

    def rows(batches):
        order = np.frombuffer(sent.value, np.uint8)
        for own, line, found in _read(batches):
            keep = _first_of_class(found)
            keep = keep[found.n[keep] >= least]
            words, of, start = _select(found, keep)
            if not len(words):
                continue
            # a chunk has under 2**17 lines
            key = (order[(words & _U((1 << SLOTS) - 1)).astype(np.int64)].astype(_U) << _U(39)) | (words >> _U(25))
            key = np.sort((of.astype(_U) << _U(47)) | key) & _U((1 << 47) - 1)
            n = found.n[keep]
            pos = np.arange(len(of)) - start[of]
            at = np.flatnonzero((pos < prefix_length(n, percent)[of]) & (key >= _U(1 << 39)))
            maps = parities(words, start, n)
            of = of[at]
            row = keep[of]
            own_key, size = key[at].view(np.int64), (n[of] << 31) | pos[at]
            after = (mix(key[_ranges(at + 1, tokens_after(own_key, size, percent, spread, paired))]) & _U(0xFFFF)).astype("<u2")
            yield {"key": own_key, "c": found.c[row], "size": size, "doc": own[row, 0], "line": line[row], "after": after} | {k: v[of] for k, v in maps.items()}

    def run(batches):
        for part in _gathered(rows(batches), 200_000):
            key, c = part["key"], part["c"]
            bucket = (mix(np.where(key >> 39 >= spread, c, key).view(_U)) % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            found, first = np.unique(bucket[order], return_index=True)
            edges = np.append(first, len(order))
            n = tokens_after(key, part["size"], percent, spread, paired)
            after = part["after"][_ranges((np.cumsum(n) - n)[order], n[order])]
            ends = np.append(0, np.cumsum(n[order]))[edges]
            held = {k: part[k].astype("<i8")[order] for k in NAMES}
            out = {"bucket": found} | {k: [v[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])] for k, v in held.items()}
            yield pd.DataFrame(out | {"after": [after[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]})

    return _documents(documents).mapInPandas(run, "bucket int, " + ", ".join(f"{k} binary" for k in [*NAMES, "after"]))


def fits(x: str, y: str, percent: int) -> str:
    """``x`` is earlier, and the length, positional and bitmap filters let two postings of one token pass.

    Two sets differ in at least as many words as their parities differ in bits.
    """
    return (
        f"struct({x}.doc, {x}.line, {x}.c) < struct({y}.doc, {y}.line, {y}.c) and least({x}.n, {y}.n) * 100L >= {percent} * greatest({x}.n, {y}.n)"
        f" and least({x}.n - {x}.pos, {y}.n - {y}.pos) * {100 + percent}L >= {percent} * ({x}.n + {y}.n)"
        f" and bit_count({x}.map ^ {y}.map) * {100 + percent}L <= {100 - percent}L * ({x}.n + {y}.n)"
        f" and (least({x}.n, {y}.n) <= {TWO} or (bit_count({x}.map2 ^ {y}.map2) + bit_count({x}.map ^ {x}.map2 ^ {y}.map ^ {y}.map2)) * {100 + percent}L <= {100 - percent}L * ({x}.n + {y}.n))"
    )


class ListSearch:
    """Candidates among the postings of whole lists, given in columns."""

    def __init__(self, percent: int, nearest: int = NEAREST, long: int = LONG, spread: int = SPREAD, few: int = FEW, wide: int = WIDE, paired: int = PAIRED):
        self.percent, self.nearest, self.long, self.spread, self.few, self.wide, self.paired = percent, nearest, long, spread, few, wide, paired

    def distinct(self, p: dict) -> dict:
        """One posting for each key and class, with its earliest line, in order of key and size."""
        order = np.argsort(p["key"])
        key = p["key"][order]
        run = np.cumsum(np.diff(key, prepend=key[0]) != 0)
        n, c = np.minimum(p["size"][order] >> 31, (1 << 20) - 1), p["c"][order]
        again = np.argsort((run << 43) | (n << 23) | (c & 0x7FFFFF)) if run[-1] < 1 << 20 else np.lexsort((c, n, run))
        order = order[again]
        p = {k: v[order] for k, v in p.items()}
        new = np.ones(len(order), bool)
        new[1:] = (p["key"][1:] != p["key"][:-1]) | (p["c"][1:] != p["c"][:-1]) | (p["size"][1:] != p["size"][:-1]) | (p["map"][1:] != p["map"][:-1])
        if new.all():
            return p
        first = np.flatnonzero(new)
        doc = np.minimum.reduceat(p["doc"], first)
        own = np.repeat(doc, np.diff(np.append(first, len(new)))) == p["doc"]
        line = np.minimum.reduceat(np.where(own, p["line"], np.iinfo(np.int32).max), first)
        return {k: v[first] for k, v in p.items()} | {"doc": doc, "line": line}

    def search(self, p: dict) -> tuple[np.ndarray, dict]:
        """Candidates handed out, and postings of lists that need rounds, with ``over``.

        Candidates: earlier class, later class, difference of their parities, document and line of either.
        ``over`` marks postings whose line has more candidates in the list than it hands out.
        """
        after = p["after"]
        n = tokens_after(p["key"], p["size"], self.percent, self.spread, self.paired)
        p = self.distinct({k: p[k] for k in NAMES} | {"from": np.cumsum(n) - n})
        p |= {"n": p["size"] >> 31, "left": (p["size"] >> 31) - (p["size"] & ((1 << 31) - 1))}
        start = np.flatnonzero(np.diff(p["key"], prepend=p["key"][0] - 1))
        length = np.diff(np.append(start, len(p["key"])))
        n = tokens_after(p["key"], p["size"], self.percent, self.spread, self.paired)
        wide = np.repeat(length > self.wide, length) & (n > 0)
        found = [self.search_lists({k: v[~wide] for k, v in p.items()})]
        found += [self.search_lists(part) for part in self.split({k: v[wide] for k, v in p.items()}, n[wide], after)]
        return np.concatenate([x for x, _ in found], axis=1), {k: np.concatenate([x[k] for _, x in found]) for k in found[0][1]}

    def split(self, p: dict, n: np.ndarray, after: np.ndarray, rows: int = 500_000):
        """The lists ``p`` as lists of those that also share one of the ``n`` tokens after; a list's key is made of both."""
        key = p["key"]
        starts = np.append(np.flatnonzero(np.diff(key, prepend=-1)), len(key))
        total = np.append(0, np.cumsum(n))
        lo = 0
        while lo < len(starts) - 1:  # whole lists of about ``rows`` postings in all
            hi = max(lo + 1, int(np.searchsorted(total[starts], total[starts[lo]] + rows, "right")) - 1)
            a, b = starts[lo], starts[hi]
            i = np.repeat(np.arange(a, b), n[a:b])
            skipped = _ranges(np.zeros(b - a, np.int64), n[a:b])
            second = after[_ranges(p["from"][a:b], n[a:b])].astype(np.int64)
            part = (np.cumsum(np.diff(key[a:b], prepend=-1) != 0)[i - a] << 16) | second
            order = np.argsort(part, kind="stable")  # sizes still rise within a list
            part, i, skipped = part[order], i[order], skipped[order]
            new = np.append(True, (part[1:] != part[:-1]) | (i[1:] != i[:-1]))
            part, i, skipped = part[new], i[new], skipped[new]
            for useful in (self.several, lambda *x: self.fitting(*x, p), self.several):
                kept = useful(part, i, skipped)
                part, i, skipped = part[kept], i[kept], skipped[kept]
            first = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            at = 0
            while at < len(first) - 1:
                to = max(at + 1, int(np.searchsorted(first, first[at] + rows, "right")) - 1)
                own = slice(first[at], first[to])
                both = mix(key[i[own]].view(_U) ^ mix((part[own] & 0xFFFF).view(_U))) >> _U(2)
                lists = {k: v[i[own]] for k, v in p.items()} | {"key": (both | _U(1 << 62)).view(np.int64)}
                yield lists | {"size": lists["size"] + skipped[own], "left": lists["left"] - skipped[own]}
                at = to
            lo = hi

    @staticmethod
    def several(part: np.ndarray, *_) -> np.ndarray:
        """Which entries aren't alone in their list."""
        alike = part[1:] == part[:-1]
        return (np.append(False, alike) | np.append(alike, False))[: len(part)]

    def fitting(self, part: np.ndarray, i: np.ndarray, skipped: np.ndarray, p: dict) -> np.ndarray:
        """Which entries leave enough tokens for the smallest other set of their list that may be similar by its size.

        ``skipped``: tokens between the two of a list, of which none is shared if these are the first two that are.
        """
        n, top = p["n"][i], (1 << 20) - 1
        code = (np.cumsum(np.diff(part, prepend=part[:1]) != 0) << 20) | np.minimum(n, top)
        at = np.searchsorted(code, (code & ~top) | np.minimum(-(-self.percent * n // 100), top))
        at += at == np.arange(len(at))
        at = np.minimum(at, len(at) - 1)
        # one that fits nobody by its size stays, if it leaves enough for a set of its own size
        least = np.where(code[at] >> 20 == code >> 20, np.minimum(n[at], top), n)
        return (p["left"][i] - skipped) * (100 + self.percent) >= self.percent * (n + least)

    def search_lists(self, p: dict) -> tuple[np.ndarray, dict]:
        """``search`` in lists as they are, which stand one after the other, sizes rising in each."""
        key, size = p["key"], len(p["key"])
        if not size:
            return np.zeros((7, 0), np.int64), {k: p[k] for k in NAMES} | {"over": np.zeros(0, bool)}
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        length = np.diff(np.append(start, size))
        end = np.repeat(start + length, length)
        spread = (key[start] >> 39 >= self.spread) & (key[start] < 1 << 62)
        long = (length > self.long) | spread
        reach = np.where(long, np.where(spread, 0, np.minimum(length - 1, NEIGHBOURS)), length - 1)
        end = np.minimum(end, np.arange(size) + 1 + np.repeat(reach, length))
        over = np.repeat(long, length)
        long = over.copy()
        pairs = []
        for lo, hi in self.blocks(start, length, np.cumsum(length * (reach + 1) // 2)):
            x, y, far = self.pairs(p, np.arange(lo, hi), end)
            if len(x):
                order = np.lexsort((p["line"][x], p["doc"][x], far, y))
                x, y, far = x[order], y[order], far[order]
                at = np.flatnonzero(np.diff(y, prepend=-1))
                count = np.diff(np.append(at, len(y)))
                over[y[at[count > self.few]]] = True
                place = np.arange(len(y)) - np.repeat(at, count)
                first = place < np.repeat(np.where((count > self.few) | long[y[at]], self.nearest, count), count)
                x, y, far = x[first], y[first], far[first]
                pairs.append(np.stack([p["c"][x], p["c"][y], far, p["doc"][x], p["line"][x], p["doc"][y], p["line"][y]]))
        opened = np.repeat(np.maximum.reduceat(over, start), length)
        rest = {k: p[k][opened] for k in NAMES} | {"over": over[opened]}
        return np.concatenate([np.zeros((7, 0), np.int64), *pairs], axis=1), rest

    @staticmethod
    def blocks(first, length, work, most: int = 4_000_000):
        """Whole lists of a bounded number of comparisons."""
        lo = 0
        while lo < len(first):
            done = work[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(work, done + most, "right")))
            yield first[lo], first[hi - 1] + length[hi - 1]
            lo = hi

    def pairs(self, p, a, end):
        """(earlier, later, difference of their parities) of the pairs that pass the filters."""
        n, left, t = p["n"], p["left"], self.percent
        one, two, three, four = (p[k].view(_U) for k in ("map", "map2", "map3", "map4"))
        count = lambda v: np.bitwise_count(v).astype(np.int64)
        out, step = [], 1
        while True:
            a = a[a + step < end[a]]
            a = a[n[a] * 100 >= t * n[a + step]]  # sizes rise within a list
            if not len(a):
                break
            b, total = a + step, n[a] + n[a + step]
            ok = np.minimum(left[a], left[b]) * (100 + t) >= t * total
            x, y, total = a[ok], b[ok], total[ok]
            far = count(one[x] ^ one[y])
            ok = (far * (100 + t) <= (100 - t) * total) & (p["c"][x] != p["c"][y])
            x, y, far, total = x[ok], y[ok], far[ok], total[ok]
            # the parities of larger sets come in halves, or quarters
            i = np.flatnonzero(np.minimum(n[x], n[y]) > TWO)
            if len(i):
                a2, b2 = two[x[i]] ^ two[y[i]], one[x[i]] ^ one[y[i]]
                far[i] = count(a2) + count(a2 ^ b2)
                j = np.flatnonzero(np.minimum(n[x[i]], n[y[i]]) > FOUR)
                if len(j):
                    k = i[j]
                    c3, d4 = three[x[k]] ^ three[y[k]], four[x[k]] ^ four[y[k]]
                    far[k] = count(c3) + count(d4) + count(a2[j] ^ d4) + count(b2[j] ^ a2[j] ^ c3)
                ok = far * (100 + t) <= (100 - t) * total
                x, y, far = x[ok], y[ok], far[ok]
            swap = p["doc"][x] > p["doc"][y]
            tie = np.flatnonzero(p["doc"][x] == p["doc"][y])
            i, j = x[tie], y[tie]
            swap[tie] = (p["line"][i] > p["line"][j]) | ((p["line"][i] == p["line"][j]) & (p["c"][i] > p["c"][j]))
            out.append((np.where(swap, y, x), np.where(swap, x, y), far))
            step += 1
        return [np.concatenate(v) for v in zip(*out)] if out else [np.zeros(0, np.int64)] * 3


def search_lists(lists: DataFrame, percent: int, nearest: int = NEAREST, long: int = LONG, spread: int = SPREAD, few: int = FEW, wide: int = WIDE, paired: int = PAIRED) -> DataFrame:
    """Candidates (a, b, far and places), and the postings of lists that need rounds (``POSTING``, over), as one table."""
    ends = ["a", "b", "far", "adoc", "aline", "bdoc", "bline"]
    columns = [*ends, *NAMES, "over"]

    def frames(search, held):
        found, rest = search.search({k: np.frombuffer(b"".join(v for part in held for v in part[k]), "<u2" if k == "after" else "<i8") for k in [*NAMES, "after"]})
        if found.shape[1]:
            found = found[:, np.lexsort((found[2], found[0], found[1]))]
            new = np.ones(found.shape[1], bool)
            new[1:] = (found[0, 1:] != found[0, :-1]) | (found[1, 1:] != found[1, :-1])
            yield pd.DataFrame(dict(zip(ends, found[:, new]))).reindex(columns=columns).astype({k: "Int64" for k in NAMES} | {"over": "boolean"})
        if len(rest["key"]):
            yield pd.DataFrame(rest).reindex(columns=columns).astype({k: "Int64" for k in ends})

    def run(batches):
        search, held, last = ListSearch(percent, nearest, long, spread, few, wide, paired), [], None
        for pdf in batches:
            for bucket, part in pdf.groupby("bucket"):  # in order; a bucket may go on in the next batch
                if held and bucket != last:
                    yield from frames(search, held)
                    held = []
                last = bucket
                held.append(part)
        if held:
            yield from frames(search, held)

    return lists.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(run, f"a long, b long, far int, adoc long, aline int, bdoc long, bline int, {POSTING}, over boolean")


def _slot(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    return (mix(doc.astype(np.int64).view(_U) * _U(0x9E3779B97F4A7C15) + line.astype(_U)) & _U((1 << WANTED) - 1)).astype(np.int64)


def _wanted(places: DataFrame) -> bytes:
    """A bit for each hash value that one of the lines ``places(doc, line)`` has: 2**WANTED bits, however many they are."""

    def run(batches):
        bits = np.zeros(1 << WANTED, bool)
        for pdf in batches:
            bits[_slot(pdf["doc"].to_numpy(), pdf["line"].to_numpy())] = True
        words = np.packbits(bits, bitorder="little").view("<i8")
        at = np.flatnonzero(words)
        yield pd.DataFrame({"w": at, "b": words[at]})

    out = np.zeros(1 << (WANTED - 6), np.int64)
    found = places.mapInPandas(run, "w int, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out[found["w"].to_numpy()] = found["b"].to_numpy()
    return out.astype("<i8").tobytes()


def sets_of(documents: DataFrame, places: DataFrame) -> DataFrame:
    """Words of the lines ``places(doc, line)`` (and of a few others): c, c2, toks (sorted, blank between)."""
    sent = documents.sparkSession.sparkContext.broadcast(_wanted(places))

    def run(batches):
        bits = np.frombuffer(sent.value, np.uint8)
        for pdf in batches:
            docs, texts = pdf["doc_id"].to_numpy(), pdf["text"].tolist()
            lines = np.array([t.count("\n") + 1 for t in texts], np.int64)
            number = np.arange(lines.sum()) - np.repeat(np.cumsum(lines) - lines, lines)
            slot = _slot(np.repeat(docs, lines), number)
            of = np.repeat(np.arange(len(texts)), lines)
            at = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
            pieces, last, own = [], -1, []
            for i, k in zip(of[at].tolist(), number[at].tolist()):
                if i != last:
                    last, own = i, texts[i].split("\n")
                pieces.append(own[k])
            for _, _, found in chunks((None, x) for x in pieces):
                keep = _first_of_class(found)
                yield pd.DataFrame({"c": found.c[keep], "c2": found.c2[keep], "toks": [" ".join(line_tokens(found.string(i))) for i in keep.tolist()]})

    return _documents(documents).select("doc_id", "text").mapInPandas(run, "c long, c2 long, toks string")


def verified(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b)`` with b2 (the rest of b's identity) and ``ok``, by the words of both (``held``: c, c2, toks)."""
    held = held.groupBy("c").agg(F.max(F.struct("toks", "c2")).alias("h"))
    both = pairs.join(held.select(F.col("c").alias("a"), F.col("h.toks").alias("x")), "a")
    both = both.join(held.select(F.col("c").alias("b"), F.col("h").alias("y")), "b")
    x, y = F.split("x", " "), F.split("y.toks", " ")
    overlap = F.size(F.array_intersect(x, y))
    return scratch(both.select("a", "b", F.col("y.c2").alias("b2"), (overlap * (100 + percent) >= percent * (F.size(x) + F.size(y))).alias("ok")), "judged")


def later_matches(documents: DataFrame, order: np.ndarray, total: int, percent: int, hubs: int = 8, growth: int = 512, nearest: int = NEAREST, long: int = LONG, spread: int = SPREAD, few: int = FEW, wide: int = WIDE, paired: int = PAIRED) -> DataFrame:
    """Classes (c, c2) to which an earlier class is similar; the last eight decide only which way a match is found."""
    buckets = max(4 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    lists = scratch(search_lists(postings(documents, order, percent, min(buckets, 1 << 30), spread, paired), percent, nearest, long, spread, few, wide, paired), "lists")
    pairs = scratch(lists.where("a is not null").groupBy("a", "b").agg(*(F.min(n).alias(n) for n in ("far", "adoc", "aline", "bdoc", "bline"))), "pairs")
    places = pairs.select(F.explode(F.array(F.struct(F.col("adoc").alias("doc"), F.col("aline").alias("line")), F.struct(F.col("bdoc").alias("doc"), F.col("bline").alias("line")))).alias("p"))
    opened = lists.where("key is not null").select("doc", "line")
    held = scratch(sets_of(documents, places.select("p.*").union(opened)), "held")
    # each line's likeliest candidate first; the others only where that fails
    judged = verified(pairs.groupBy("b").agg(F.min_by("a", F.struct("far", "a")).alias("a")), held, percent)
    found = judged.where("ok").select(F.col("b").alias("c"), F.col("b2").alias("c2")).distinct()
    others = pairs.select("a", "b").join(judged.where("ok").select("b").distinct(), "b", "left_anti").join(judged.select("a", "b"), ["a", "b"], "left_anti")
    more = verified(others, held, percent)
    tested = judged.union(more).where("not ok").select("a", "b")
    matched = scratch(found.union(more.where("ok").select("b", "b2")).distinct(), "matched")
    drop_scratch(pairs)
    columns = ["key", "c", "n", "pos", "map", "map2", "doc", "line"]
    place, posting = F.struct("doc", "line", "c"), F.struct(*columns[1:])
    size = F.shiftright("size", 31).cast("int").alias("n"), F.col("size").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("pos")
    rest = lists.where("key is not null").select("key", "c", *size, "map", "map2", "doc", "line", "over")

    def whole(postings: DataFrame) -> DataFrame:
        """A frequent word's list comes in parts, and a class in several of them no more than once."""
        return postings.groupBy("key", "c", "n", "map", "map2").agg(F.min("pos").alias("pos"), F.min(F.struct("doc", "line")).alias("at")).select(*columns[:4], "map", "map2", "at.*")

    def tried(postings: DataFrame, seekers: DataFrame) -> DataFrame:
        """Those that come before one of the list's ``seekers``, and pass the filters with one if there are few."""
        parts = seekers.groupBy("key", F.pmod(F.xxhash64("c"), F.lit(PARTS)).alias("part")).agg(F.min_by(posting, place).alias("s"), F.max(place).alias("last"), F.count("*").alias("k"))
        bound = parts.groupBy("key").agg(F.max("last").alias("last"), F.sum("k").alias("k"), F.collect_list("s").alias("all"))
        few = F.when((F.col("k") <= SEEKERS) & (F.size("all") == F.col("k")), F.col("all")).alias("few")
        near = F.expr(f"few is null or exists(few, s -> {fits('me', 's', percent)})")
        return postings.withColumn("me", posting).join(bound.select("key", "last", few), "key").where((place < F.col("last")) & near).select(postings.columns)

    seekers = scratch(whole(rest.where("over").join(matched.select("c").distinct(), "c", "left_anti")), "seekers")
    members = scratch(whole(tried(rest, seekers)), "members")
    drop_scratch(lists)
    many = hubs
    while not members.isEmpty():
        # a list's hubs travel as arrays of HUBS at most
        part = F.pmod(F.xxhash64("c"), F.lit(many))
        least = members.groupBy("key", part.alias("part")).agg(F.min_by(posting, place).alias("hub"))
        arrays = least.groupBy("key", F.floor(F.col("part") / HUBS).alias("g")).agg(F.collect_list("hub").alias("hubs")).drop("g")
        near = F.expr(f"filter(hubs, h -> {fits('h', 'me', percent)})")
        pairs = seekers.withColumn("me", posting).join(arrays, "key").select(F.explode(near).alias("h"), F.col("c").alias("b"))
        pairs = pairs.select(F.col("h.c").alias("a"), "b").distinct().join(tested, ["a", "b"], "left_anti")
        judged = verified(pairs, held, percent)
        tested = tested.union(judged.where("not ok").select("a", "b"))
        matched = scratch(matched.union(judged.where("ok").select("b", "b2")).distinct(), "matched")
        left = scratch(seekers.join(matched.select("c").distinct(), "c", "left_anti").select(columns), "seekers")
        hub = least.select("key", "hub.c")
        after = scratch(tried(members, left).join(hub, ["key", "c"], "left_anti").select(columns), "members")
        drop_scratch(seekers)
        drop_scratch(members)
        seekers, members, many = left, after, many * growth
    drop_scratch(seekers)
    drop_scratch(members)
    drop_scratch(held)
    return matched


def find_duplicates(documents: DataFrame, percent: int = 80, **ways) -> DataFrame:
    """doc_id, version, removed (sorted line numbers from 0): documents that lose lines."""
    read = scratch(lines_and_counts(documents, percent), "lines")
    matched = later_matches(documents, *token_order(read), percent, **ways)
    rows = read.where("c is not null").select("doc_id", "version", "line", "c", "c2")
    classes = rows.groupBy("c", "c2").agg(F.min(F.struct("doc_id", "line", "version")).alias("first"), F.count("*").alias("times"))
    gone = classes.join(matched.withColumn("gone", F.lit(True)), ["c", "c2"], "left").where("gone or times > 1")
    gone = scratch(gone.select("c", "c2", "first", "times", F.coalesce("gone", F.lit(False)).alias("gone")), "gone")
    # a class with over a thousandth of the lines: there are 1000 at most
    hot = F.col("times") * 1000 > rows.count()
    hottest = gone.where(hot)
    if hottest.isEmpty():
        lost = rows.join(gone, ["c", "c2"])
    else:
        hottest = F.broadcast(hottest)
        lost = rows.join(hottest, ["c", "c2"]).unionByName(rows.join(hottest, ["c", "c2"], "left_anti").join(gone.where(~hot), ["c", "c2"]))
    lost = lost.where(F.col("gone") | (F.struct("doc_id", "line", "version") != F.col("first")))
    return lost.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("line")).alias("removed"))


def dedup_lines(documents: DataFrame, percent: int = 80, **ways) -> DataFrame:
    """``documents`` without its later matching lines: its columns with ``text`` cleaned, and ``removed``.

    Lines without words (blank or marks only) match nothing and stay.  Every row stays, with an empty text if all its
    lines go.  Null texts and rows with a null doc_id stay as they are and take no part.  Rows that share a
    doc_id and a text are one document; of rows that share a doc_id only, equal lines at one place are in order of their texts' hashes.
    Any 64-bit doc_ids and any number of lines will do; a line is held whole in a task, at some 60 bytes a character.
    A column ``removed`` is replaced; other columns may have any names.  An empty table gives an empty result.
    """
    removed = find_duplicates(documents, percent, **ways)
    names = [n for n in documents.columns if n != "removed"]
    own = documents.select(F.struct(*names).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"))
    joined = own.join(removed, ["doc_id", "version"], "left")
    kept = F.transform(
        F.array(F.split("row.text", "\n", -1)),
        lambda lines: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed")), lambda i: F.get(lines, i)), "\n"),
    )
    text = F.when(F.size("removed") > 0, F.element_at(kept, 1)).otherwise(F.col("row.text"))
    return joined.select(*((text if n == "text" else F.col("row").getField(n)).alias(n) for n in names), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def report(documents: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers, comma-joined), text (what is left)."""
    docs = documents.select("doc_id", "text", F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n", -1))).otherwise(0).cast("long").alias("n_lines"))
    out = dedup_lines(docs, percent)
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed"), "text")


#: DuckDB: the same prefix filter as one query.
ORACLE = """
with l as (select doc_id, text, unnest(string_split(text, chr(10))) line, unnest(range(len(string_split(text, chr(10))))) i from documents),
t as (select doc_id, i, line, list_sort(list_distinct(regexp_extract_all(lower(line), '[\\p{L}\\p{N}_]+'))) toks from l),
r as (select doc_id, i, toks, row_number() over (order by doc_id, i) id from t where len(toks) > 0),
c as (select toks, min(id) id, len(toks) n from r group by toks),
e as (select id, n, unnest(toks) w from c),
f as (select id, e.n, e.w, row_number() over (partition by id order by d.c, e.w) p from e join (select w, count(*) c from e group by w) d using (w)),
x as (select * from f where p <= n - cast(ceil(0.8 * n) as bigint) + 1),
q as (select distinct a.id a, b.id b from x a join x b on a.w = b.w and a.id < b.id and least(a.n, b.n) * 100 >= 80 * greatest(a.n, b.n)),
m as (select distinct q.b id from q join c y on y.id = q.a join c z on z.id = q.b where len(list_intersect(y.toks, z.toks)) * 180 >= 80 * (y.n + z.n)),
gone as (select r.doc_id, r.i from r join c using (toks) where r.id <> c.id or c.id in (select id from m))
select t.doc_id, count(*) n_lines, count(g.i) n_removed, coalesce(string_agg(cast(t.i as varchar), ',' order by t.i) filter (g.i is not null), '') removed,
  coalesce(string_agg(t.line, chr(10) order by t.i) filter (g.i is null), '') as text
from t left join gone g on g.doc_id = t.doc_id and g.i = t.i group by t.doc_id
"""
