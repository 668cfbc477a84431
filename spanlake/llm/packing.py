"""Packing: token sequences of a fixed length by the online sum-of-squares rule.

A window (one output sequence while it fills) has a level: its number of tokens so far.  ``N[h]`` counts
the open windows at level ``h``.  A piece of ``s`` tokens goes to the level that makes the sum of ``N[h]**2``
least afterwards: raising a window from ``h`` to ``h + s`` changes that sum by ``2 (N[h+s] - N[h] + 1)``,
opening one by ``2 N[s] + 1``, and filling one exactly by ``1 - 2 N[h]``.

A document longer than a window first fills whole windows of its own; its remainder is one piece.  A piece
may also be cut, its first part filling a window exactly and the rest opening one: that changes the sum by
``1 - 2 N[h] + 2 N[s - g] + 1`` for a gap of ``g``, and counts as ``cut_cost`` more, so that it happens only where many
windows stand alike.  It keeps about ``cut_cost / 2`` windows open at a level at most, whatever the sizes of the documents.

When a task's input ends, the fullest open windows stay as the rule filled them, and the pieces of the emptiest ones
are cut to fill their gaps.  The last window is cut into power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 1
#: What a cut counts in the sum of squares.
CUT_COST = 8
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class SumOfSquares:
    """Level array of open windows; yields closed windows as lists of pieces."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = defaultdict(list)
        self.n_open = 0

    def best(self, size: int) -> tuple[int, int]:
        """(change of the sum, level) of the best window for a piece below the window's size; level 0 opens one."""
        w, n = self.window, self.count
        levels = np.arange(1, w - size + 1)
        rise = 2 * (n[levels + size] - n[levels] + 1)
        rise[-1] = 1 - 2 * n[w - size]
        rise[n[levels] == 0] = np.iinfo(np.int64).max
        k, opened = int(np.argmin(rise)), int(2 * n[size] + 1)
        return (int(rise[k]), k + 1) if rise[k] <= opened else (opened, 0)

    def best_cut(self, size: int) -> tuple[int, int]:
        """(change of the sum, level) of the best window that a part of the piece fills, the rest opening one."""
        w, n = self.window, self.count
        levels = np.arange(w - size + 1, w)
        rise = 2 - 2 * n[levels] + 2 * n[size - w + levels]
        rise[n[levels] == 0] = np.iinfo(np.int64).max
        k = int(np.argmin(rise)) if len(levels) else 0
        return (int(rise[k]), int(levels[k])) if len(levels) else (np.iinfo(np.int64).max, 0)

    def put(self, piece, size: int, level: int) -> list | None:
        """Put a piece into a window of the level; the window, if that fills it."""
        window = []
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
            self.n_open -= 1
        window.append(piece)
        level += size
        if level == self.window:
            return window
        self.open[level].append(window)
        self.count[level] += 1
        self.n_open += 1
        return None

    def place(self, piece, size: int) -> list | None:
        """Place one piece whole; the window it fills exactly, if it does."""
        return [piece] if size == self.window else self.put(piece, size, self.best(size)[1])

    def drain(self) -> list[list]:
        """The open windows, fullest first; nothing stays open."""
        windows = [window for level in sorted(self.open, reverse=True) for window in self.open[level]]
        self.open.clear()
        self.count[:] = 0
        self.n_open = 0
        return windows


def length(piece) -> int:
    return len(piece[2]) // 4


def cut(piece, size: int):
    """The first ``size`` ids of a piece, and the rest."""
    doc, start, ids, total = piece
    return (doc, start, ids[: 4 * size], total), (doc, start + size, ids[4 * size :], total)


def close(windows: list[list], window: int) -> Iterator[list]:
    """Full windows out of open ones (fullest first): gaps are filled from the emptiest; the last goes in powers of two."""
    low, high, spare, last = 0, len(windows), [], []
    while low < high or spare:
        held = windows[low] if low < high else []
        low += 1
        gap = window - sum(map(length, held))
        while gap and (spare or low < high):
            if not spare:
                high -= 1
                spare = windows[high][::-1]
            part, rest = cut(spare.pop(), gap)
            held.append(part)
            gap -= length(part)
            if length(rest):
                spare.append(rest)
        if not gap:
            yield held
        else:
            last = held
    left = sum(map(length, last))
    while left:
        size, take = 1 << (left.bit_length() - 1), []
        left -= size
        while size:
            part, rest = cut(last.pop(0), size)
            take.append(part)
            size -= length(part)
            if length(rest):
                last.insert(0, rest)
        yield take


def pack_stream(docs: Iterator[tuple], window: int, cut_cost: int = CUT_COST, first_sequence: int = 0) -> Iterator[tuple]:
    """(doc_id, ids as little-endian uint32 bytes) -> rows of ``SCHEMA``; each id lies in one piece."""
    levels, sequence = SumOfSquares(window), first_sequence

    def rows(pieces):
        nonlocal sequence
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            yield doc, start, n, zlib.crc32(ids), total, sequence, at
            at += n
        sequence += 1

    for doc, ids in docs:
        total = len(ids) // 4
        for start in range(0, total, window):
            piece = (doc, start, ids[4 * start : 4 * (start + window)], total)
            size = length(piece)
            if size == window:
                yield from rows([piece])
                continue
            change, level = levels.best(size)
            cut_change, cut_level = levels.best_cut(size)
            if cut_change < change - cut_cost:
                part, piece = cut(piece, window - cut_level)
                yield from rows(levels.put(part, length(part), cut_level))
                size, level = length(piece), 0
            if full := levels.put(piece, size, level):
                yield from rows(full)
    for full in close(levels.drain(), window):
        yield from rows(full)


def added_tokens(path: str) -> dict[str, int]:
    """Tokens that a tokenizer file finds in texts before any other, by their strings."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}


def load_encoder(ranks_path: str, pattern: str, added: dict[str, int]):
    """Byte-pair encoder of the vocabulary file: text -> ids; ``added`` tokens are cut out of the text first."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    strings = re.compile("|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None

    def encode(text: str) -> list[int]:
        out, at = [], 0
        for m in strings.finditer(text) if strings else ():
            out += plain(text[at : m.start()])
            out.append(added[m[0]])
            at = m.end()
        return out + plain(text[at:]) if at else plain(text)

    return encode


def pack(documents: DataFrame, ranks_path: str, pattern: str, added: dict[str, int] | None = None, window: int = 2048, cut_cost: int = CUT_COST) -> DataFrame:
    """Pack ``documents(doc_id, text)``; one row per piece, ``SCHEMA``.

    Each task packs its own input as a stream, with no shuffle; ``sequence_id`` starts with the task's
    partition number.  Memory: one Arrow batch and the ids of the open windows, see above.  ``added``: strings of the vocabulary's added tokens.

    A null or empty text is the one id ``END_ID``; a null doc_id stays null; repeated rows are packed each
    on their own; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches):
        encode = load_encoder(ranks_path, pattern, added or {})
        first = TaskContext.get().partitionId() << 40

        def docs(pdf):
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                ids = np.array([*encode(text), END_ID] if text else [END_ID], "<u4")
                yield (None if pd.isna(doc) else int(doc)), ids.tobytes()

        out = []
        for row in pack_stream((d for pdf in batches for d in docs(pdf)), window, cut_cost, first):
            out.append(row)
            if len(out) >= 20_000:
                yield as_frame(out)
                out = []
        yield as_frame(out)

    def as_frame(rows):
        pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
        return pdf.astype({"doc_id": "Int64"})

    return documents.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, SCHEMA)
