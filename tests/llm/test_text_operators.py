"""URL filters, decontamination, licence scans, packing, personal data, pipeline: brute force and edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF, same_rows
from pyspark.sql import functions as F

from spanlake.llm import decontaminate, license_scan, packing, pii, queries, url_reputation


def test_registered_oracles(spark, duck):
    for name, sql in queries.oracle_sql().items():
        assert same_rows(queries.queries()[name](spark, SF), duck.sql(sql)), name


def test_urls(spark):
    rows = [
        (1, "HTTP://A.Example.COM/en/7?x=1#y", "a.example.com", "/en/7", "example.com/en/7", "allow"), (2, "x://b.com/en/6", "b.com", "/en/6", "com/en/", "block"),
        (3, "x://example.net/de/8", "example.net", "/de/8", "example.net/de/8", "block"), (4, "x://notexample.net/de/8", "notexample.net", "/de/8", "net/de/", "allow"),
        (5, "x://h?q/en/", "h", "", None, "allow"), (6, None, "", "", None, "allow"), (7, "no scheme", "", "", None, "allow"), (8, "x://bad.org/de/1", "bad.org", "/de/1", None, "block"),
        (9, "x://org/es/", "org", "/es/", "org/es/", "block"),
    ]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string").withColumns({"host": F.lit("clash"), "verdict": F.lit(1)})
    outcomes = spark.createDataFrame([("bad.org", 1)] * 40 + [("fine.org", 0)] * 200 + [("", 1), (None, 1), ("fine.org", None)], "host string, outcome int")
    got = {r["page_id"]: r for r in url_reputation.judge(pages, outcomes).collect()}
    for i, _, host, path, rule, verdict in rows:
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict)
    assert url_reputation.judge(pages.where("false"), outcomes).count() == 0
    assert url_reputation.judge(pages, outcomes.where("false")).where("verdict = 'block' and rule is null").count() == 0


def test_alignment_against_plain_recursion():
    r = random.Random(2)
    for _ in range(60):
        a, b = ([r.randint(1, 4) for _ in range(r.randint(1, 9))] for _ in range(2))
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        assert decontaminate.align(np.array(a), np.array(b))[0] == max(map(max, h))


def test_decontamination(spark):
    r = random.Random(9)
    word = lambda: f"w{r.randint(0, 5000)}"
    items = [(i, " ".join(word() for _ in range(30))) for i in range(5)] + [(7, None), (8, ""), (None, "a b c")]
    docs, leaks = [], set()
    for d in range(60):
        text = [word() for _ in range(80)]
        if d % 6 == 0:
            copy = items[d % 5][1].split()
            if d % 12 == 0:
                for k in range(0, 30, 6):
                    copy[k] = word()
            text[40:40] = copy
            leaks.add((d, d % 5))
        docs.append((d, " ".join(text).upper()))
    docs += [(100, None), (101, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for chars in (10**6, 200):
        hits = decontaminate.contaminated(df, bench, block_chars=chars).collect()
        assert {(r["doc_id"], r["item_id"]) for r in hits} == leaks
    assert all(abs(r["first_word"] - 40) <= 2 and abs(r["end_word"] - 70) <= 2 for r in hits)
    assert {r["doc_id"] for r in decontaminate.decontaminate(df, bench).collect()} == {d for d, _ in docs} - {d for d, _ in leaks}
    assert decontaminate.contaminated(df, bench.where("false")).count() == 0 and decontaminate.contaminated(df.where("false"), bench).count() == 0


def test_edited_passage_in_many_documents(spark, monkeypatch):
    """Five words of fifty changed, alike in 90 of 120 documents: no seed of it is rare, and none of the item is elsewhere."""
    r = random.Random(19)
    word = lambda: f"w{r.randint(0, 5000)}"
    items = [(i, " ".join(word() for _ in range(50))) for i in range(3)]
    edited = items[0][1].split()
    for k in (4, 14, 24, 34, 44):
        edited[k] = f"new{k}"
    docs = [(d, " ".join([word() for _ in range(20)] + (edited if d % 4 else []) + [word() for _ in range(20)])) for d in range(120)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(d, 0, 0.85, 20, 70) for d, _ in docs if d % 4}
    assert {(x["doc_id"], x["item_id"], round(x["score"], 6), x["first_word"], x["end_word"]) for x in decontaminate.contaminated(df, bench).collect()} == want
    monkeypatch.setattr(decontaminate, "PAIRS", 5)  # the same hits where seeds are joined in many parts
    index = decontaminate.Index(items)
    assert {(d, *h) for d, t in docs for h in index.hits(t)} == want


def test_decontamination_finds_what_exhaustive_alignment_finds(spark):
    """Regular and random edits of items, and documents of common words: every document against every item."""
    r = random.Random(23)
    word = lambda: f"w{r.randint(0, 60)}" if r.random() < 0.5 else f"r{r.randint(0, 4000)}"
    items = [(i, " ".join(word() for _ in range([1, 2, 3, 7, 12, 30, 50][i % 7]))) for i in range(35)]
    docs = []
    for d in range(220):
        t = items[d % 35][1].split()
        way = d % 10
        if way < 4:  # every second to fifth word replaced
            t = [word() if i % (way + 2) == 1 else w for i, w in enumerate(t)]
        elif way == 4:  # a word put after each
            t = [x for w in t for x in (w, word())]
        elif way == 5:
            t = [w for w in t if r.random() < 0.75]
        elif way == 6:  # one half
            t = t[: (len(t) + 1) // 2]
        else:
            t = [word() if r.random() < 0.1 * (way - 6) else w for w in t]
        docs.append((d, " ".join([word() for _ in range(r.randint(0, 40))] + t + [word() for _ in range(r.randint(0, 40))])))
    got = {(x["doc_id"], x["item_id"]): x["score"] for x in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for d, text in docs:
        b = text.split()
        for i, t in items:
            a = t.split()
            ids = {w: k + 1 for k, w in enumerate(dict.fromkeys(a))}
            x, y = np.array([ids[w] for w in a]), np.array([ids.get(w, 0) for w in b])
            score = decontaminate.align(x, y)[0] / (2 * len(a))
            shared = any((y[j], y[j + k]) in {(x[q], x[q + m]) for m in (1, 2) for q in range(len(x) - m)} for k in (1, 2) for j in range(len(y) - k) if y[j] and y[j + k]) if len(a) > 1 else True
            assert ((d, i) in got) == (score >= 0.5 and shared), (d, i, score)
            assert (d, i) not in got or abs(got[d, i] - score) < 1e-9


def test_licences(spark):
    apache = "Licensed under the Apache License, Version 2.0"
    docs = [(1, "x MIT License, the MIT  license"), (2, f"a b {apache} c"), (3, None), (4, ""), (5, "é plain words"), (6, "All rights reserved."), (7, "general public-license"), (8, "nothing " * 3000 + apache)]
    docs += [(100 + i, "nothing to see here of the and") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in license_scan.scan(df).collect()}
    assert (got[1]["n_words"], got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (6, 2, 1, 4, "mit")
    assert got[2]["labels"] == "apache" and got[2]["score"] > 0.9 and got[8]["labels"] == "apache" and got[8]["first_word"] == 3003
    assert got[3]["n_words"] == 0 and got[3]["first_word"] is None and got[4]["labels"] == "" and got[5]["n_words"] == 3
    assert got[6]["labels"] == "reserved" and got[6]["base_labels"] == "" and got[7]["base_labels"] == "gpl"
    assert all(got[100 + i]["labels"] == "" and got[100 + i]["score"] == 0 for i in range(200))
    assert license_scan.scan(df.where("false")).count() == 0


def test_licence_base_matches_brute_force(spark):
    """Words, base places and labels against a plain search, over random mixtures, repeated rows and ties."""
    r = random.Random(12)
    parts = ["mit", "MIT", "license", "License,", "apache", "general", "public", "GNU", "x", "é", "-", "\n", "_", "licenses", "9"]
    docs = [(i % 190, " ".join(r.choice(parts) for _ in range(r.randint(0, 40)))) for i in range(200)]
    docs += [(500 + i, f"a {t} b") for i, (_, t, _) in enumerate(license_scan.TEMPLATES)]
    got = {}
    for x in license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        got.setdefault(x["doc_id"], []).append(x)
    for d, text in docs:
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}).encode())
        hits = [(i, label) for phrase, label in license_scan.BASE for p in [phrase.encode().split()] for i in range(len(words)) if words[i : i + len(p)] == p]
        want = (len(words), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits})))
        same = [x for x in got[d] if (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) == want]
        assert same and all(set(filter(None, x["base_labels"].split(","))) <= set(x["labels"].split(",")) and 0 <= x["score"] <= 1 for x in got[d])
    assert sum(map(len, got.values())) == len(docs)
    for i, (label, _, _) in enumerate(license_scan.TEMPLATES):
        assert label in got[500 + i][0]["labels"].split(",") and got[500 + i][0]["score"] > 0.99


def check_packing(rows, ids, window=2048):
    at, fill, n_pieces = {}, {}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"], r["start"])):
        d = r["doc_id"]
        assert r["start"] == at.get(d, 0)
        at[d] = r["start"] + r["length"]
        part = np.array(ids[d][r["start"] : at[d]], "<u4").tobytes()
        assert zlib.crc32(part) == r["ids_crc32"] and r["doc_tokens"] == len(ids[d])
    assert at == {d: len(v) for d, v in ids.items()}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
        n_pieces[r["sequence_id"]] = n_pieces.get(r["sequence_id"], 0) + 1
    padding = sum(0 if f & (f - 1) == 0 else window - f for f in fill.values())
    assert max(fill.values()) <= window
    return padding


def test_packing_matches_the_tokenizer(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    r = random.Random(3)
    docs = [(i, " ".join(r.choice(["é", "ab", "Don't", "12 3", "\n\n", "<|endoftext|>", "long" * 9]) for _ in range(r.randint(0, 900)))) for i in range(80)] + [(1000, None), (1001, "")]
    docs.append((1002, "word " * 20_000))
    ids = {d: [*(tok.encode(t, add_special_tokens=False).ids if t else []), 1] for d, t in docs}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("length", F.lit("clash"))
    path, added = P.path("byte_bpe_50k.tiktoken"), packing.added_tokens(P.path("byte_bpe_50k.json"))
    assert added == {"<|endoftext|>": 50256} and any(50256 in x for x in ids.values())
    assert check_packing(packing.pack(df, path, P.PATTERN, added).collect(), ids) == 0
    assert packing.pack(df.where("false"), path, P.PATTERN, added).count() == 0


def test_sum_of_squares_rule():
    r = random.Random(4)
    levels = packing.SumOfSquares(16)
    for _ in range(400):
        size = r.randint(1, 16)
        before = levels.count.copy()
        best = None
        for h in range(0, 17 - size):
            if h and not before[h]:
                continue
            after = before.copy()
            after[h] -= h > 0
            after[h + size] += h + size < 16
            cost = int((after * after).sum())
            best = cost if best is None else min(best, cost)
        if size < 16:
            levels.place("x", size)
            assert int((levels.count * levels.count).sum()) == best
        assert levels.n_open == levels.count.sum() == sum(len(w) for w in levels.open.values())


def test_most_documents_stay_as_the_rule_placed_them():
    r = random.Random(8)
    for n, least in ((300, 0.9), (5000, 0.97)):
        docs = [(i, np.full(1 + int(r.expovariate(1 / 500)), i, "<u4").tobytes()) for i in range(n)]
        rows = [dict(zip([c.split()[0] for c in packing.SCHEMA.split(", ")], x)) for x in packing.pack_stream(iter(docs), 2048)]
        assert check_packing(rows, {i: [i] * (len(b) // 4) for i, b in docs}) == 0
        short = [i for i, b in docs if len(b) <= 4 * 2048]
        whole = {x["doc_id"] for x in rows if x["length"] == x["doc_tokens"]}
        assert len(whole & set(short)) >= least * len(short)


def test_open_windows_stay_few():
    """Documents that never fit together: cuts that the rule counts keep the level array low."""
    levels, most = packing.SumOfSquares(64), 0
    for rows in packing.pack_stream(((i, np.full(33, i, "<u4").tobytes()) for i in range(3000)), 64):
        pass
    for _ in range(3000):
        change, level = levels.best(33)
        cut_change, cut_level = levels.best_cut(33)
        if cut_change < change - packing.CUT_COST:
            levels.put("a", 64 - cut_level, cut_level)
            levels.put("b", 33 - 64 + cut_level, 0)
        else:
            levels.put("x", 33, level)
        most = max(most, levels.n_open)
    assert most <= 64 * packing.CUT_COST


def test_flush_of_many_open_windows():
    docs = [(i, np.full(1025 + i % 900, i, "<u4").tobytes()) for i in range(300)]
    rows = [dict(zip([c.split()[0] for c in packing.SCHEMA.split(", ")], r)) for r in packing.pack_stream(iter(docs), 2048, 10)]
    assert check_packing(rows, {i: [i] * (len(b) // 4) for i, b in docs}) == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m, d: 12 <= len(d) <= 19 and sum(v * (1 + i % 2) - 9 * (v * (1 + i % 2) > 9) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15),
]


def base_spans(text):
    found = [(m.start(), k, m.end(), name) for k, (name, p, good) in enumerate(BASE) for m in re.finditer(p, text) if good(m[0], re.sub("[^0-9]", "", m[0]))]
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(found))


def test_personal_data_base(spark):
    r = random.Random(6)
    parts = ["a@b.c", "x.y@z-1.co.uk", "@", "é", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (234) 555-1234", "+12", " ", "_", ".", "-", "\x01", "a@b", "5", "00", "\n", "4111111111111111"]
    docs = [(i, "".join(r.choice(parts) for _ in range(r.randint(1, 14)))) for i in range(400)] + [(900, None), (901, ""), (902, "1 " * 30_000), (903, "a@b" + ".c" * 20_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"spans": F.lit("clash"), "found": F.lit(1)})
    got = {x["doc_id"]: x for x in pii.detect(df).collect()}
    for i, t in docs:
        want = base_spans(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), t
        assert set(filter(None, want.split(","))) <= set(got[i]["spans"].split(","))
        assert got[i]["n_email"] == want.count("email:") and got[i]["n_phone"] == want.count("phone:")
    assert pii.detect(df.where("false")).count() == 0


def test_personal_data_beyond_base(spark):
    docs = [(i, f"say token = \"{hashlib.md5(str(i).encode()).hexdigest()}\" now") for i in range(30)] + [(100 + i, "plain words only, key = value") for i in range(30)] + [(200 + i, f"mail u{i}@x.com and 4111111111111111") for i in range(30)]
    got = {x["doc_id"]: x["spans"] for x in pii.detect(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(set(got[i].split(",")) - set(base_spans(docs[i][1]).split(",")) == {"secret:13:45"} for i in range(30)) and all(got[100 + i] == "" for i in range(30))


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for _, stage in p.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF)
        assert kept.columns == docs.columns
        kept = p.scratch(kept, "test")
        assert kept.count() <= before.count()
    assert 0.3 * docs.count() < kept.count() < docs.count()
    rows = p.STAGES[-1][1](spark, kept, SF)
    assert rows.select("doc_id").distinct().count() == kept.count()
    leaks = decontaminate.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).select("doc_id")
    assert kept.join(leaks, "doc_id", "left_semi").where("length(text) > 2000").count() == 0


def test_stages_handle_odd_rows_and_columns(spark):
    """Nulls, empty texts, repeated rows, an empty table, and columns named like the stages' own."""
    import corpus_pipeline as p

    text = "The first line of a plain text that is long enough.\nAnother line follows it here with more words.\nAnd a third one closes the document for good."
    rows = [(1, text, "a", "s", 5), (1, text, "a", "s", 5), (2, None, None, None, None), (3, "", "b", "t", 0), (None, text + " x", "c", "u", 1), (4, text.upper(), "d", "v", 2), (5, "word " * 30_000, "e", "w", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = docs.withColumns({n: F.lit(n) for n in ("score", "removed", "_t", "_v", "_doc", "_version", "row", "version", "c1", "component_id", "kept", "key", "node", "length", "item_id", "_row")})
    for name, stage in p.STAGES:
        for frame in (docs, odd):
            out = stage(spark, frame, SF)
            ids = [r["doc_id"] for r in out.collect()]
            if name != "packing":
                assert out.columns == frame.columns, name
            if name == "MinHash near-dedup":
                assert sorted(ids, key=lambda i: (i is None, i)) == [1, 2, 3, 5, None], name
            elif name in ("line dedup", "benchmark decontamination"):
                assert len(ids) == len(rows), name
            assert stage(spark, frame.where("false"), SF).count() == 0, name
