"""Models: gradients, held-out accuracy, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanlake.llm import common, quality_crf, toxicity

WORDS = "amber basil cedar delta ember fjord grove heron inlet jetty knoll larch maple north ocean piper quail ridge stone thorn".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def corpus(n=240):
    r, docs, labels = random.Random(5), [], []
    for i in range(n):
        bad, toxic = i % 4 == 0, i % 3 == 0
        lines = [prose(r, r.randint(4, 15)) for _ in range(r.randint(1, 5))]
        if toxic:
            lines[0] += " " + r.choice(["vile", "wretch"]) + " " + prose(r, 3)
        if bad:
            lines = [x.upper().replace(" ", "!! ") + "!!" for x in lines]
        docs.append((i, "\n".join(lines)))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs + [(9001, None), (9002, ""), (9003, "long " * 4000), (None, "x")], "doc_id long, text string").withColumns({"score": F.lit("clash"), "held_out": F.lit(1)})
    y = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    return d, y


@pytest.mark.parametrize("run, label", [(quality_crf.classify, "quality"), (toxicity.classify, "toxic")])
def test_held_out_accuracy(spark, tables, run, label):
    d, y = tables
    got = run(d, y).collect()
    assert len(got) == d.count() and all(0 <= r["score"] <= 1 for r in got)
    truth = {r["doc_id"]: r[label] for r in y.where("doc_id is not null and toxic is not null").collect()}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.9
    assert run(d.where("false"), y).count() == 0


def test_no_held_out_row_is_learnt_from(spark, tables):
    d, y = tables
    import zlib

    sample = common.training_sample(d, y, "quality", 10_000)
    texts = {r["text"] for r in d.where("doc_id is not null").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    assert sample and not texts & {t for t, _ in sample}
    assert len(common.training_sample(d, y, "quality", 7)) == 7


def test_without_labels(spark, tables):
    d, y = tables
    none = y.where("false")
    assert {round(r["score"], 6) for r in quality_crf.classify(d, none).collect()} == {0.5}
    assert toxicity.classify(d.limit(5), none).count() == 5


def test_forward_backward_is_exact():
    r = np.random.default_rng(0)
    counts = np.array([3, 1, 4])
    node, start, pair = r.standard_normal((8, 2)), r.standard_normal(2), r.standard_normal((2, 2))
    gamma, pairs, firsts, log_z = quality_crf.marginals(node, counts, start, pair)
    at, total, want, wp, wf = 0, 0.0, np.zeros((8, 2)), np.zeros((2, 2)), np.zeros(2)
    for n in counts:
        weights = []
        for code in range(2**n):
            s = [code >> k & 1 for k in range(n)]
            weights.append((np.exp(start[s[0]] + sum(node[at + k, s[k]] for k in range(n)) + sum(pair[a, b] for a, b in zip(s, s[1:]))), s))
        z = sum(w for w, _ in weights)
        total += np.log(z)
        for w, s in weights:
            wf[s[0]] += w / z
            for k in range(n):
                want[at + k, s[k]] += w / z
            for a, b in zip(s, s[1:]):
                wp[a, b] += w / z
        at += n
    assert np.allclose(gamma, want) and np.allclose(pairs, wp) and np.allclose(firsts, wf) and np.isclose(log_z, total)


def test_network_gradients():
    r = np.random.default_rng(1)
    m = {k: v.astype(np.float64) for k, v in toxicity.new_model(5).items()}
    x, mask = r.standard_normal((4, 3, toxicity.EMBED)), np.ones((4, 3))
    mask[2:, 1] = 0

    def loss():
        z, _ = toxicity.forward(m, x, mask)
        return float((z * np.array([1.0, -2.0, 0.5])).sum())

    _, held = toxicity.forward(m, x, mask, True)
    grad, dx = toxicity.backward(m, x, mask, held, np.array([1.0, -2.0, 0.5]))
    for name in ("Wf", "Ub", "cb", "A", "a", "v", "Uf", "Wb"):
        flat = m[name].reshape(-1)
        k = int(r.integers(len(flat)))
        old = flat[k]
        flat[k] = old + 1e-4
        up = loss()
        flat[k] = old - 1e-4
        down = loss()
        flat[k] = old
        assert abs((up - down) / 2e-4 - grad[name].reshape(-1)[k]) < 1e-3 * max(1, abs(grad[name].reshape(-1)[k])), name
    old = x[1, 0, 2]
    x[1, 0, 2] = old + 1e-4
    up = loss()
    x[1, 0, 2] = old - 1e-4
    assert abs((up - loss()) / 2e-4 - dx[1, 0, 2]) < 1e-3


def test_windows_cover_everything():
    for n in (1, 31, 32, 33, 57, 200, 1001):
        held = {i for s in toxicity.windows(n) for i in range(s, min(n, s + toxicity.WINDOW))}
        assert held == set(range(n))


def test_toxicity_training_scores_all_windows(monkeypatch):
    rows = [(" ".join(f"w{(i * 7 + k) % 50}" for k in range(700)), i % 2) for i in range(12)]
    scored, forward = [], toxicity.forward

    def spy(m, x, mask, keep=False):
        if not keep:
            scored.append(mask.shape[1])
        return forward(m, x, mask, keep)

    monkeypatch.setattr(toxicity, "forward", spy)
    toxicity.train(rows, steps=2)
    assert sum(scored) == 12 * len(toxicity.windows(700))


@pytest.mark.parametrize("run", [quality_crf.classify, toxicity.classify])
def test_scores_dont_depend_on_other_rows(spark, tables, run):
    """Repeated rows, rows of one doc_id, and a document by itself are scored alike."""
    d, y = tables
    few = d.where("doc_id in (3, 4, 5, 9003)").select("doc_id", "text")
    more = few.union(few).union(few.where("doc_id = 3").selectExpr("4L as doc_id", "text")).union(d.where("doc_id > 200 and doc_id < 230").select("doc_id", "text"))
    labelled = d.select("doc_id", "text").join(y.select("doc_id").distinct(), "doc_id", "left_semi")
    whole = {(x["doc_id"], x["score"]) for x in run(labelled.union(more).coalesce(1), y).where("doc_id in (3, 5, 9003)").collect()}
    by = {}
    for i, score in whole:
        by.setdefault(i, []).append(score)
    assert set(by) == {3, 5, 9003} and all(max(v) - min(v) < 1e-6 for v in by.values())


def test_quality_training_memory():
    """Training takes no memory that follows the characters of its sample, and features don't depend on the other texts."""
    import tracemalloc

    r = np.random.default_rng(4)
    texts = ["\n".join("w" * int(n) for n in r.integers(1, 40_000, 8)) for _ in range(60)]
    size = sum(map(len, texts))
    tracemalloc.start()
    model = quality_crf.train([(t, i % 2) for i, t in enumerate(texts)], rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size > 8_000_000 and peak < 80_000_000
    x, _, counts = quality_crf.line_features(texts)
    halves = [quality_crf.line_features(texts[:25]), quality_crf.line_features(texts[25:])]
    assert (np.concatenate([h[0] for h in halves]) == x).all() and (np.concatenate([h[2] for h in halves]) == counts).all()
    assert np.isfinite(model["w"]).all()
