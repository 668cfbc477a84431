"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Each line has a state, good or bad.  Its features describe the line and its neighbouring lines; the chain
adds weights for the first state and for each pair of neighbouring states.  It is trained by maximum
likelihood (forward-backward, Adam) on documents whose lines all take the document's label.  A document's
score is the mean of its lines' marginal probabilities of being good, weighted by their lengths.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, training_sample

#: Documents that the model is fitted on, at most.
TRAIN_BOUND = 3000
CHARS_AT_ONCE = 1_000_000
_CLASSES = 6  # upper, lower, digit, space, mark, symbol


def _class_table() -> np.ndarray:
    table = np.full(65536, 5, np.uint8)
    for i in range(65536):
        c = chr(i)
        table[i] = 0 if c.isupper() else 1 if c.isalpha() else 2 if c.isdigit() else 3 if c.isspace() else 4 if c in ".,;:'\"-()?" else 5
    return table


CLASS = _class_table()
N_OWN = 16
N_FEATURES = 3 * N_OWN + 3


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, line lengths, lines of each text); a text without lines is one empty line."""
    lines, counts = [], []
    for t in texts:
        own = t.split("\n")
        lines += own
        counts.append(len(own))
    counts = np.array(counts, np.int64)
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    n = len(lines)
    codes = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = CLASS[np.minimum(codes, 65535)] if codes.size else np.zeros(0, np.uint8)
    at = np.cumsum(length + 1) - length - 1
    by = np.zeros((n, _CLASSES), np.float32)
    if codes.size:
        for k in range(_CLASSES):
            total = np.concatenate([[0], np.cumsum(kinds == k)])
            by[:, k] = total[at + length] - total[at]
    word = np.zeros((n, 5), np.float32)
    for i, line in enumerate(lines):
        w = line.split()
        if w:
            word[i, 0], word[i, 1] = len(w), len(set(w))
            word[i, 2] = sum(a == b for a, b in zip(w, w[1:]))
            word[i, 3] = w.count("|")
            word[i, 4] = sum(not a[-2:].isalnum() and not a[-2:-1].isalnum() for a in w if len(a) > 2)
    chars, words = np.maximum(length, 1).astype(np.float32), np.maximum(word[:, 0], 1)
    letters = np.maximum(by[:, 0] + by[:, 1], 1)
    upper, symbol, repeat, again = by[:, 0] / letters, by[:, 5] / chars, 1 - word[:, 1] / words, word[:, 2] / words
    bars, ends = word[:, 3] / words, word[:, 4] / words
    own = np.stack([
        np.log1p(length) / 8, np.log1p(word[:, 0]) / 6, upper, upper > 0.5, symbol * 5, symbol > 0.05, repeat, (repeat > 0.6) & (words > 8),
        again, again > 0.2, bars, bars > 0.1, ends, ends > 0.3, by[:, 2] / chars, length == 0,
    ], 1).astype(np.float32)
    first = np.zeros(n, bool)
    first[np.cumsum(counts) - counts] = True
    last = np.roll(first, -1)
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[first], after[last] = 0, 0
    x = np.concatenate([own, before, after, np.ones((n, 1)), first[:, None], last[:, None]], 1).astype(np.float32)
    return x, length, counts


def marginals(node: np.ndarray, counts: np.ndarray, start: np.ndarray, pair: np.ndarray):
    """Forward-backward over all chains at once.

    ``node`` holds each line's two scores.  Returns each line's marginals, the expected state pairs summed,
    the first lines' marginals summed, and the log partition sum.  Chains are ordered by length so that step t works on
    those that reach it; probabilities are rescaled at every step.
    """
    order = np.argsort(-counts, kind="stable")
    begin = (np.cumsum(counts) - counts)[order]
    size = counts[order]
    top = node.max(1, keepdims=True)
    e = np.exp(node - top)
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
    alpha, beta, scale = np.zeros_like(e), np.zeros_like(e), np.ones(len(e))
    p, s = np.exp(pair), np.exp(start)
    for t in range(longest):
        i = begin[: alive[t]] + t
        a = e[i] * (s if t == 0 else alpha[i - 1] @ p)
        scale[i] = a.sum(1)
        alpha[i] = a / scale[i, None]
    pairs = np.zeros((2, 2))
    for t in range(longest - 1, -1, -1):
        i = begin[: alive[t]] + t
        k = alive[t + 1] if t + 1 < longest else 0
        beta[i[k:]] = 1
        if k:
            j = i[:k]
            right = e[j + 1] * beta[j + 1] / scale[j + 1, None]
            beta[j] = right @ p.T
            pairs += p * (alpha[j].T @ right)
    gamma = alpha * beta
    return gamma, pairs, gamma[begin].sum(0), float(np.log(scale).sum() + top.sum())


def train(rows: list[tuple[str, int]], rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> dict[str, np.ndarray]:
    """Fit on (text, label) rows; an empty sample gives the model that scores every line 1/2."""
    model = {"w": np.zeros((N_FEATURES, 2)), "start": np.zeros(2), "pair": np.zeros((2, 2))}
    if not rows:
        return model
    # a text's features don't depend on others; those of all texts at once would take some 25 bytes a character
    parts = [line_features([t for t, _ in rows[a:b]]) for a, b in pieces([t for t, _ in rows])]
    x, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[2] for p in parts])
    y = np.repeat([int(v > 0) for _, v in rows], counts)
    hot = np.eye(2)[y]
    begin = np.cumsum(counts) - counts
    inside = np.ones(len(y), bool)
    inside[begin] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[np.flatnonzero(inside) - 1], y[inside]), 1)
    weight = np.repeat(1 / counts, counts)  # each document counts alike in the node weights
    m = {k: np.zeros_like(v) for k, v in model.items()}
    v = {k: np.zeros_like(a) for k, a in model.items()}
    for r in range(1, rounds + 1):
        gamma, pairs, firsts, _ = marginals(x @ model["w"], counts, model["start"], model["pair"])
        grad = {"w": x.T @ ((gamma - hot) * weight[:, None]), "start": firsts - hot[begin].sum(0), "pair": (pairs - seen) / max(1.0, counts.mean())}
        for k in model:
            g = grad[k] / len(rows) + decay * model[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            model[k] = model[k] - rate * (m[k] / (1 - 0.9**r)) / (np.sqrt(v[k] / (1 - 0.999**r)) + 1e-8)
    return model


def score_texts(texts: list[str], model: dict[str, np.ndarray]) -> np.ndarray:
    x, length, counts = line_features(texts)
    gamma, *_ = marginals((x @ model["w"]).astype(np.float64), counts, model["start"], model["pair"])
    weight = length + 1.0
    at = np.cumsum(counts) - counts
    return np.clip(np.add.reduceat(gamma[:, 1] * weight, at) / np.add.reduceat(weight, at), 0, 1)


def pieces(texts: list[str], chars: int = CHARS_AT_ONCE):
    """Slices of whole texts that hold about ``chars`` characters, so that memory doesn't follow the batch."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def quality_model(documents: DataFrame, labels: DataFrame, bound: int = TRAIN_BOUND) -> dict[str, np.ndarray]:
    return train(training_sample(documents, labels, "quality", bound))


def score(documents: DataFrame, model: dict[str, np.ndarray], keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Columns ``keep`` (default doc_id; none of them ``score`` or ``_t``) and ``score`` of the column ``text``, whole, with no shuffle.

    A null or empty text is one empty line; every row gives a row; an empty table an empty result.
    """
    keep = keep or ["doc_id"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema)

    def run(batches):
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["_t"]]
            out = np.zeros(len(texts))
            for a, b in pieces(texts):
                out[a:b] = score_texts(texts[a:b], model)
            yield pdf[keep].assign(**{"score": out})

    return documents.select(*keep, F.col(text).alias("_t")).mapInPandas(run, f"{schema}, score double")


def classify(documents: DataFrame, labels: DataFrame, bound: int = TRAIN_BOUND) -> DataFrame:
    """doc_id, held_out, score, predicted (score of at least 1/2); held-out rows are never learnt from."""
    scored = score(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), quality_model(documents, labels, bound))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
