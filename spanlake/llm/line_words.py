"""Lines of texts as sets of word hashes, in numpy: no Python object for a word.

A word is a run of letters, digits and ``_`` (as ``\\w`` has it) of the lower-case text.  Its hash is a polynomial
in its code points modulo 2**64, taken from prefix sums over the whole chunk; words of over ``PLAIN`` code points, for
which such polynomials can be made to collide, are hashed one by one.  A set of words is identified by its
size and two sums of mixed hashes (128 bits).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import xxhash

PLAIN = 256
#: Characters that are looked at together (their arrays stay in a core's cache); a longer line is a chunk of its own.
CHUNK = 1 << 17
_U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@cache
def _tables() -> tuple[bytes, bytes, np.ndarray]:
    """Lower case of each Latin-1 character, whether it is part of a word, and the latter for every code point."""
    word = np.fromiter((c == 95 or chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    return bytes(range(256)).decode("latin-1").lower().encode("latin-1"), word[:256].tobytes(), word


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2**64."""
    out = []
    for b in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, b, _U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Lines:
    """The lines with words of some pieces of texts; a line's words stand together, in no particular order.

    ``owner``: number of the piece a line is of; ``line``: its number there; ``n``: its distinct words;
    ``first``: where they start in ``words`` (hashes); ``c``, ``c2``: identity of the set.
    """

    def __init__(self, pieces: list[str]):
        text = "\n".join(pieces)
        lower, latin, word = _tables()
        try:  # a byte for a character, nearly always
            held = text.encode("latin-1").translate(lower)
            cp, inside = np.frombuffer(held, np.uint8), np.frombuffer(held.translate(latin), bool)
            self.text = text
        except UnicodeEncodeError:
            self.text = text.lower()
            cp = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), "<u4")
            inside = word[cp]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(cp) and inside[0]:
            edge = np.append(0, edge)
        start, end = edge[::2], np.append(edge, len(cp))[1::2] if len(edge) & 1 else edge[1::2]
        power, inverse = _powers(1 << max(18, int(len(cp) + 1).bit_length()))
        value = np.multiply(cp, power[: len(cp)], dtype=_U)
        total = np.add.reduceat(value, edge)[::2] if len(edge) and edge[-1] < len(cp) else np.add.reduceat(value, edge[:-1])[::2] if len(edge) else value[:0]
        h = mix(total * inverse[start] + (end - start).astype(_U))
        for i in np.flatnonzero(end - start > PLAIN).tolist():
            h[i] = xxhash.xxh3_64_intdigest(cp[start[i] : end[i]].astype("<u4").tobytes())
        breaks = np.flatnonzero(cp == 10)
        inside = np.diff(np.concatenate([[0], np.searchsorted(start, breaks), [len(start)]]))  # words of each line
        at = np.repeat(np.arange(len(inside)), inside)
        # sets: words of a line in order of (line, hash), repeats dropped
        bits = _U(max(1, int(len(breaks) + 1).bit_length()))
        order = np.argsort((at.astype(_U) << (_U(64) - bits)) | (h >> bits))
        at, h = at[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (at[1:] != at[:-1]) | (h[1:] != h[:-1])
        at, self.words = at[new], h[new]
        self.first = np.flatnonzero(np.diff(at, prepend=-1))
        self.n = np.diff(np.append(self.first, len(at)))
        self.at = at[self.first]
        if len(self.first):
            self.c = np.add.reduceat(mix(self.words ^ _U(0xA0761D6478BD642F)), self.first).view(np.int64)
            self.c2 = np.add.reduceat(mix(self.words ^ _U(0xE7037ED1A0B428DB)), self.first).view(np.int64)
        else:
            self.c = self.c2 = np.zeros(0, np.int64)
        # pieces start at known lines
        lines = np.cumsum([0] + [p.count("\n") + 1 for p in pieces])
        self.owner = np.searchsorted(lines, self.at, "right") - 1
        self.line = self.at - lines[self.owner]
        self.breaks = breaks

    def string(self, i: int) -> str:
        """The i-th line, in lower case."""
        k = self.at[i]
        return self.text[self.breaks[k - 1] + 1 if k else 0 : self.breaks[k] if k < len(self.breaks) else len(self.text)].lower()


def chunks(texts: Iterator[tuple], size: int = CHUNK) -> Iterator[tuple[list, np.ndarray, Lines]]:
    """(key, text) -> (keys, first line number of each piece, their lines), about ``size`` characters together."""
    keys, firsts, pieces, held = [], [], [], 0
    for key, text in texts:
        line = at = 0
        while at <= len(text):
            end = len(text) if len(text) - at <= size else text.rfind("\n", at, at + size)
            if end < 0:
                end = text.find("\n", at)
                end = len(text) if end < 0 else end
            piece = text[at:end]
            if held and held + len(piece) > size:
                yield keys, np.array(firsts, np.int64), Lines(pieces)
                keys, firsts, pieces, held = [], [], [], 0
            keys.append(key)
            firsts.append(line)
            pieces.append(piece)
            held += len(piece) + 1
            line += piece.count("\n") + 1
            at = end + 1
    if pieces:
        yield keys, np.array(firsts, np.int64), Lines(pieces)
