"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the sum of a learned word vector (for words of the training sample) and the mean of learned
vectors of its hashed character trigrams, so unknown spellings have an input too.  Windows of ``WINDOW``
words, overlapping by ``WINDOW - STRIDE``, cover the whole text; a forward and a backward GRU read each window,
attention pools their states, and a logistic output scores it.  A document's score is its windows' highest.

Training is by multiple instances: only a document's label is known, so at each step all windows of a
document are scored and the highest stands for it.  Labels are noisy: after a start with cross-entropy the loss turns to the
generalised one, whose gradient fades for labels that the model finds incredible, so that it doesn't
learn single wrong labels by heart.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, training_sample

#: Documents that the model is fitted on, at most.
TRAIN_BOUND = 3000
WINDOW, STRIDE = 32, 24
#: Windows that training scores together.
AT_ONCE = 2048
EMBED, HIDDEN, TRIGRAMS = 16, 8, 2048
#: Words that a task keeps inputs of; the store is emptied when it is full.
STORE = 100_000
WORDS = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    """Lower-case words; a text without words is one empty word."""
    return (WORDS.findall(text.lower()) if text else None) or [""]


def trigram_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams of ``^word$`` for all words, flat, with the number of each word's."""
    joined = "".join(f"^{w}$" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    h = (codes[:-2] * 1_000_003 + codes[1:-1]) * 1_000_003 + codes[2:] if len(codes) > 2 else np.zeros(0, np.uint64)
    h = ((h ^ (h >> np.uint64(15))) * np.uint64(2_654_435_761) >> np.uint64(13)) % TRIGRAMS
    end = np.cumsum(size)
    keep = np.ones(max(len(codes) - 2, 0), bool)
    for back in (1, 2):
        at = end - back
        keep[at[at < len(keep)]] = False
    return h[keep].astype(np.int64), np.maximum(size - 2, 0)


def char_means(words: list[str], table: np.ndarray) -> np.ndarray:
    """Mean trigram vector of each word; zero for the empty word."""
    ids, n = trigram_ids(words)
    out = np.zeros((len(words), table.shape[1]), np.float32)
    np.add.at(out, np.repeat(np.arange(len(words)), n), table[ids])
    return out / np.maximum(n, 1)[:, None]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_model(n_words: int, seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    d, h = EMBED, HIDDEN
    init = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    m = {"word": 0.1 * init(n_words + 1, d) * np.sqrt(n_words + 1).astype(np.float32), "char": 0.1 * r.standard_normal((TRIGRAMS, d)).astype(np.float32)}
    m["word"][0] = 0
    for side in "fb":
        m |= {f"W{side}": init(d, 3 * h), f"U{side}": init(h, 3 * h), f"c{side}": np.zeros(3 * h, np.float32)}
    return m | {"A": init(2 * h, 2 * h), "a": init(2 * h), "v": init(2 * h), "o": np.zeros(1, np.float32)}


def gru(p: np.ndarray, mask: np.ndarray, U: np.ndarray, keep: bool = False):
    """States of a GRU over projected inputs ``p`` (steps, windows, 3 hidden), with update, reset, candidate."""
    h = U.shape[0]
    state = np.zeros((p.shape[1], h), np.float32)
    out, saved = np.empty((*p.shape[:2], h), np.float32), []
    Ug, Uc = np.ascontiguousarray(U[:, : 2 * h]), np.ascontiguousarray(U[:, 2 * h :])
    for t in range(len(p)):
        g = 1 / (1 + np.exp(-(p[t, :, : 2 * h] + state @ Ug)))
        c = np.tanh(p[t, :, 2 * h :] + (g[:, h:] * state) @ Uc)
        z = g[:, :h] * mask[t][:, None]
        if keep:
            saved.append((state, g, c, z))
        state = state + z * (c - state)
        out[t] = state
    return out, saved


def gru_back(dout: np.ndarray, saved: list, mask: np.ndarray, U: np.ndarray):
    """Gradients of ``gru`` for its projected inputs and ``U``."""
    h = U.shape[0]
    Ug, Uc = U[:, : 2 * h], U[:, 2 * h :]
    dp, dU = np.zeros((*dout.shape[:2], 3 * h), np.float32), np.zeros_like(U)
    ds = np.zeros_like(dout[0])
    for t in range(len(dout) - 1, -1, -1):
        state, g, c, z = saved[t]
        ds = ds + dout[t]
        dz = ds * (c - state) * mask[t][:, None]
        dc = ds * z * (1 - c * c)
        rs = g[:, h:] * state
        drs = dc @ Uc.T
        dg = np.concatenate([dz, drs * state], 1) * g * (1 - g)
        dp[t, :, : 2 * h], dp[t, :, 2 * h :] = dg, dc
        dU[:, : 2 * h] += state.T @ dg
        dU[:, 2 * h :] += rs.T @ dc
        ds = ds * (1 - z) + drs * g[:, h:] + dg @ Ug.T
    return dp, dU


def forward(m: dict, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Scores (logits) of windows with inputs ``x`` (steps, windows, embed)."""
    f, fs = gru(x @ m["Wf"] + m["cf"], mask, m["Uf"], keep)
    b, bs = gru((x @ m["Wb"] + m["cb"])[::-1], mask[::-1], m["Ub"], keep)
    return pool(m, f, b, mask, (fs, bs), keep)


def pool(m: dict, f: np.ndarray, b: np.ndarray, mask: np.ndarray, saved=None, keep: bool = False):
    s = np.concatenate([f, b[::-1]], 2)
    u = np.tanh(s @ m["A"])
    score = np.where(mask > 0, u @ m["a"], -1e9)
    w = np.exp(score - score.max(0))
    w /= w.sum(0)
    pooled = (w[:, :, None] * s).sum(0)
    z = pooled @ m["v"] + m["o"][0]
    return (z, (s, u, w, pooled, *saved)) if keep else (z, None)


def backward(m: dict, x: np.ndarray, mask: np.ndarray, held, dz: np.ndarray) -> tuple[dict, np.ndarray]:
    s, u, w, pooled, fs, bs = held
    h = HIDDEN
    grad = {"o": np.array([dz.sum()], np.float32), "v": pooled.T @ dz}
    dpool = dz[:, None] * m["v"]
    ds = w[:, :, None] * dpool
    dw = (s * dpool).sum(2)
    dscore = w * (dw - (w * dw).sum(0))
    grad["a"] = (u * dscore[:, :, None]).sum((0, 1))
    du = dscore[:, :, None] * m["a"] * (1 - u * u)
    grad["A"] = s.reshape(-1, 2 * h).T @ du.reshape(-1, 2 * h)
    ds = ds + du @ m["A"].T
    dpf, grad["Uf"] = gru_back(ds[:, :, :h], fs, mask, m["Uf"])
    dpb, grad["Ub"] = gru_back(ds[::-1, :, h:], bs, mask[::-1], m["Ub"])
    dpb = dpb[::-1]
    flat = x.reshape(-1, x.shape[2])
    dx = np.zeros_like(x)
    for side, dp in (("f", dpf), ("b", dpb)):
        two = dp.reshape(-1, 3 * h)
        grad[f"W{side}"], grad[f"c{side}"] = flat.T @ two, two.sum(0)
        dx += dp @ m[f"W{side}"].T
    return grad, dx


def windows(n: int) -> list[int]:
    """Starts of the overlapping windows that cover ``n`` words."""
    return [*range(0, max(n - WINDOW, 0), STRIDE), max(n - WINDOW, 0)]


def window_matrix(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(WINDOW, windows) word ids, and a mask of the steps that stand before the end of the text."""
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    mask = (at < ends[None, :]).astype(np.float32)
    return ids[np.minimum(at, len(ids) - 1)], mask


class Words:
    """Ids of words; id 0 is no word of the sample."""

    def __init__(self, texts: list[list[str]], least: float = 0.01, most: int = 20_000):
        least = max(3, least * len(texts))
        df = Counter(w for t in texts for w in set(t))
        self.id = {w: i + 1 for i, (w, n) in enumerate(sorted(df.items(), key=lambda x: (-x[1], x[0]))[:most]) if n >= least}


def train(rows: list[tuple[str, int]], steps: int = 450, batch: int = 64, rate: float = 0.01, decay: float = 2e-3, seed: int = 7):
    """(model, word ids) from (text, label) rows; without rows, an untrained model."""
    texts = [tokens(t) for t, _ in rows]
    y = np.array([int(v > 0) for _, v in rows], np.float32)
    words = Words(texts)
    m = new_model(len(words.id), seed)
    if not rows:
        return m, words.id
    r = np.random.default_rng(seed)
    m["o"][0] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    every = sorted({w for t in texts for w in t})
    place = {w: i for i, w in enumerate(every)}
    wid = np.array([words.id.get(w, 0) for w in every])
    tri, tri_n = trigram_ids(every)
    tri_at = np.cumsum(tri_n) - tri_n
    flat = np.fromiter((place[w] for t in texts for w in t), np.int64)
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(size) - size
    first = {k: np.zeros_like(v) for k, v in m.items()}
    second = {k: np.zeros_like(v) for k, v in m.items()}
    step = 0
    batch = max(8, min(batch, len(rows) // 6))
    epochs = -(-steps // -(-len(rows) // batch))

    def inputs(ids):
        used, back = np.unique(ids, return_inverse=True)
        n = tri_n[used]
        take = np.repeat(tri_at[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        e = np.zeros((len(used), EMBED), np.float32)
        np.add.at(e, np.repeat(np.arange(len(used)), n), m["char"][tri[take]])
        e = e / np.maximum(n, 1)[:, None] + m["word"][wid[used]]
        return e[back.reshape(ids.shape)], used, back, n, take

    for _ in range(epochs):
        order = r.permutation(len(rows))
        for k in range(0, len(order), batch):
            docs = order[k : k + batch]
            starts, owner = [], []
            for j, d in enumerate(docs):
                own = windows(size[d])
                starts += [begin[d] + s for s in own]
                owner += [j] * len(own)
            starts, owner = np.array(starts), np.array(owner)
            ends = (begin + size)[docs][owner]
            z = np.empty(len(starts), np.float32)
            for a in range(0, len(starts), AT_ONCE):
                ids, mask = window_matrix(flat, starts[a : a + AT_ONCE], ends[a : a + AT_ONCE])
                z[a : a + AT_ONCE] = forward(m, inputs(ids)[0], mask)[0]
            best = np.lexsort((z, owner))[np.searchsorted(owner, np.arange(len(docs)), side="right") - 1]
            ids, mask = window_matrix(flat, starts[best], ends[best])
            x, used, back, n, take = inputs(ids)
            drop = (r.random(x.shape[:2]) > 0.1).astype(np.float32)[:, :, None]
            x = x * drop
            z, held = forward(m, x, mask, True)
            p = sigmoid(z)
            trust = np.where(y[docs] > 0, p, 1 - p) ** (0.7 if step > steps * 0.35 else 0.0)
            dz = ((p - y[docs]) * trust / len(docs)).astype(np.float32)
            grad, dx = backward(m, x, mask, held, dz)
            de = np.zeros((len(used), EMBED), np.float32)
            np.add.at(de, back.reshape(-1), (dx * drop).reshape(-1, EMBED))
            grad["word"], grad["char"] = np.zeros_like(m["word"]), np.zeros_like(m["char"])
            np.add.at(grad["word"], wid[used], de)
            grad["word"][0] = 0
            np.add.at(grad["char"], tri[take], np.repeat(de / np.maximum(n, 1)[:, None], n, 0))
            step += 1
            pace = rate * min(1.0, 2 * (1 - step / (epochs * -(-len(rows) // batch))))
            for name, g in grad.items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                if name in ("word", "char"):
                    m[name] *= 1 - pace * decay * 10
                m[name] -= pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-6)
    return m, words.id


class Scorer:
    """Scores whole texts; both GRUs' input projections of each word are computed once and stored."""

    def __init__(self, model: dict[str, np.ndarray], word_ids: dict[str, int]):
        self.m, self.word_ids = model, word_ids
        self.W = np.concatenate([model["Wf"], model["Wb"]], 1)
        self.c = np.concatenate([model["cf"], model["cb"]])
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1024, 6 * HIDDEN), np.float32)

    def ids(self, texts: list[list[str]]) -> np.ndarray:
        new = sorted({w for t in texts for w in t} - self.place.keys())
        if len(self.place) + len(new) > STORE:
            self.clear()
            new = sorted({w for t in texts for w in t})
        if new:
            e = char_means(new, self.m["char"]) + self.m["word"][[self.word_ids.get(w, 0) for w in new]]
            n = len(self.place)
            while n + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[n : n + len(new)] = e @ self.W + self.c
            self.place.update((w, n + i) for i, w in enumerate(new))
        get = self.place.__getitem__
        return np.fromiter((get(w) for t in texts for w in t), np.int64)

    def score(self, texts: list[list[str]], at_once: int = 2048) -> np.ndarray:
        flat = self.ids(texts)
        size = np.array([len(t) for t in texts])
        begin = np.cumsum(size) - size
        per = [windows(n) for n in size]
        n = np.array([len(p) for p in per])
        starts = np.fromiter((s for p in per for s in p), np.int64) + np.repeat(begin, n)
        ends = np.repeat(begin + size, n)
        z = np.empty(len(starts), np.float32)
        for k in range(0, len(starts), at_once):
            ids, mask = window_matrix(flat, starts[k : k + at_once], ends[k : k + at_once])
            p = self.rows[ids]
            f, _ = gru(p[:, :, : 3 * HIDDEN], mask, self.m["Uf"])
            b, _ = gru(p[::-1, :, 3 * HIDDEN :], mask[::-1], self.m["Ub"])
            z[k : k + at_once] = pool(self.m, f, b, mask)[0]
        return sigmoid(np.maximum.reduceat(z, np.cumsum(n) - n).astype(np.float64))


def toxicity_model(documents: DataFrame, labels: DataFrame, bound: int = TRAIN_BOUND):
    return train(training_sample(documents, labels, "toxic", bound))


def classify(documents: DataFrame, labels: DataFrame, bound: int = TRAIN_BOUND, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (score of at least ``threshold``), with no shuffle of texts.

    Every row gives a row.  A null or empty text is one window of one empty word; repeated rows give repeated
    rows; an empty table an empty result; without usable labels the network is untrained and its scores mean
    nothing; other columns are ignored.
    """
    model, word_ids = toxicity_model(documents, labels, bound)
    model = {k: v.astype(np.float32) for k, v in model.items()}

    def run(batches):
        scorer = Scorer(model, word_ids)
        for pdf in batches:
            for a in range(0, len(pdf), 64):
                part = pdf.iloc[a : a + 64]
                score = scorer.score([tokens(t if isinstance(t, str) else None) for t in part["text"]])
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "score": score})

    scored = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
