"""Near-dedup, components and line dedup against brute force; edge cases."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from spanlake.llm import common, fingerprints, line_dedup, line_words, near_dedup


def texts(spark, items, extra=True):
    df = spark.createDataFrame(items, "doc_id long, text string")
    return df.withColumns({"component_id": F.lit("x"), "kept": F.lit(1), "key": F.lit(None).cast("string"), "node": F.lit(2)}) if extra else df


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_components_of_a_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 180)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in common.connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 180)}}


def test_sketch_fills_and_estimates():
    s, r = near_dedup.Sketcher(3), random.Random(1)
    words = [b"w%d" % r.randint(0, 10**6) for _ in range(300)]
    x, y = s.shingles(words), s.shingles(words[:200] + [b"z%d" % i for i in range(100)])
    a, b = s.sketch(x), s.sketch(y)
    assert a.max() < np.iinfo(np.uint64).max
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs((a == b).mean() - true) < 0.1
    assert len(s.sketch(s.shingles([b"one"]))) == near_dedup.T and s.sketch(s.shingles([b"one"])).max() < np.iinfo(np.uint64).max


def test_near_duplicates_match_brute_force(spark):
    r = random.Random(7)
    base = [" ".join(f"w{r.randint(0, 3000)}" for _ in range(r.randint(1, 60))) for _ in range(25)]
    items = []
    for t in base:
        items.append(t)
        for _ in range(r.randint(0, 8)):
            w = r.choice([t, items[-1]]).split()
            if r.random() < 0.7:
                w[r.randrange(len(w))] = f"x{r.randint(0, 99)}"
            items.append(" ".join(w).upper() if r.random() < 0.2 else " ".join(w))
    r.shuffle(items)
    sets = [near_dedup.shingle_set(near_dedup.words_of(t), 3) for t in items]
    links = [(i, j) for i in range(len(items)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = components(len(items), links)
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(texts(spark, list(enumerate(items))), 3, 85).collect()}
    assert [got[i]["component_id"] for i in range(len(items))] == want
    assert all(got[i]["n_shingles"] == len(sets[i]) and got[i]["kept"] == (want[i] == i) for i in range(len(items)))


def test_crowded_buckets_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    r = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    items = []
    for i in range(90):
        w = list(base)
        for k in r.sample(range(60), r.randint(0, 5)):
            w[k] = f"x{r.randint(0, 9)}"
        items.append(" ".join(w))
    sets = [near_dedup.shingle_set(near_dedup.words_of(t), 3) for t in items]
    links = [(i, j) for i in range(len(items)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.near_duplicates(texts(spark, list(enumerate(items))), 3, 85, crowd=3).collect()}
    assert [got[i] for i in range(len(items))] == components(len(items), links)


def test_near_duplicates_edge_cases(spark):
    items = [(5, "a b"), (3, "A  b"), (7, None), (8, ""), (9, " \n"), (None, "a b"), (3, "A  b"), (20, "x " * 5000), (21, "x " * 5000 + "y")]
    got = sorted(near_dedup.near_duplicates(texts(spark, items), 3, 85).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    assert [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got] == [
        (3, 1, 3, True), (3, 1, 3, True), (5, 1, 3, False), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (20, 1, 20, True), (21, 2, 21, True), (None, 1, None, True),
    ]
    assert near_dedup.near_duplicates(texts(spark, items).where("false")).count() == 0


def brute_lines(items, percent=80):
    """Lines left of each (doc, text), by comparing every line with all before it."""
    before, out = [], {}
    for doc, text in sorted(items):
        kept = []
        for line in text.split("\n"):
            s = set(line_dedup.line_tokens(line))
            if not s or not any(100 * len(s & o) >= percent * len(s | o) for o in before):
                kept.append(line)
            if s:
                before.append(s)
        out[doc] = "\n".join(kept)
    return out


def test_line_dedup_matches_brute_force(spark):
    r = random.Random(3)
    common_words = [f"c{i}" for i in range(12)]
    pool = [" ".join(r.choice(common_words) if r.random() < 0.5 else f"w{r.randint(0, 400)}" for _ in range(r.randint(1, 14))) for _ in range(40)]
    items = []
    for doc in range(60):
        lines = []
        for _ in range(r.randint(1, 6)):
            w = r.choice(pool).split()
            if r.random() < 0.5:
                w[r.randrange(len(w))] = f"w{r.randint(0, 400)}"
            lines.append(" ".join(w).title() if r.random() < 0.3 else " ".join(w))
        items.append((doc, "\n".join(lines + [""] * r.randint(0, 2))))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(texts(spark, items)).collect()}
    assert got == brute_lines(items)


def test_line_dedup_ways_of_search(spark):
    """Crowds of alike lines, found by lists, by rounds of hubs and by spread lists, match brute force."""
    r = random.Random(8)
    items = []
    for doc in range(50):
        base = [f"w{i}" for i in range(14 if doc % 4 else 240 if doc % 8 else 100)] if doc % 3 else [f"v{r.randint(0, 9)}" for _ in range(8)]
        for i in r.sample(range(len(base)), r.randint(0, 3 + len(base) // 8)):
            base[i] = f"x{r.randint(0, 30)}"
        items.append((doc - 25 << 57, " ".join(base) + "\n" + " ".join(base[::-1] + ["more"])))
    want = brute_lines(items)
    for ways in ({}, {"nearest": 1, "few": 1}, {"long": 3}, {"long": 3, "spread": 1, "growth": 2, "hubs": 1}):
        assert {x["doc_id"]: x["text"] for x in line_dedup.dedup_lines(texts(spark, items), **ways).collect()} == want, ways


def test_line_dedup_of_wide_lists(spark):
    """Lists that are split by a second token, searched or in rounds, match brute force."""
    r = random.Random(12)
    items = [(doc, "\n".join(" ".join(f"w{int(40 * r.random() ** 2)}" for _ in range(r.randint(4, 14))) for _ in range(6))) for doc in range(50)]
    items += [(doc + 50, "\n".join(" ".join(r.choice([w, w, w, w, w, f"w{r.randint(0, 40)}"]) for w in line.split()) for line in text.split("\n"))) for doc, text in items]
    want = brute_lines(items)
    for ways in ({"wide": 2, "paired": 8}, {"wide": 2, "paired": 8, "long": 3, "hubs": 1, "growth": 2}, {"wide": 4, "paired": 24, "spread": 48, "few": 1, "nearest": 1}):
        assert {x["doc_id"]: x["text"] for x in line_dedup.dedup_lines(texts(spark, items), **ways).collect()} == want, ways


def test_wide_list_of_unlike_lines():
    """Lines that share a frequent word only aren't compared, however long its list is, and go to no rounds."""
    n, m = 3000, 12
    r = np.random.default_rng(1)
    key = np.int64(80 << 39 | 5)
    own = {k: np.zeros(n, np.int64) for k in line_dedup.NAMES} | {"key": np.full(n, key), "c": np.arange(n), "doc": np.arange(n), "size": np.full(n, m << 31)}
    after = r.integers(0, 1 << 16, (n, 3)).astype("<u2")
    after[1] = after[0] = [7, 8, 9]
    assert line_dedup.tokens_after(own["key"][:1], own["size"][:1], 80).tolist() == [3]
    found, rest = line_dedup.ListSearch(80).search(own | {"after": after.ravel()})
    assert (0, 1) in set(zip(found[0].tolist(), found[1].tolist())) and found.shape[1] < n and not len(rest["key"])


def test_lists_of_alike_long_lines():
    """Two frequent tokens make a list of alike lines only where enough tokens are left after both; lists that end up empty are no error."""
    n, m, after = 900, 60, 13
    own = {k: np.zeros(n * after, np.int64) for k in line_dedup.NAMES}
    pos, c = np.repeat(np.arange(after), n), np.tile(np.arange(n), after)
    own |= {"key": (80 << 39) + pos, "c": c, "doc": c, "size": (m << 31) | pos}
    held = np.concatenate([np.arange(p + 1, after + 1) for p in pos]).astype("<u2")
    found, rest = line_dedup.ListSearch(80).search(own | {"after": held})
    # 60 words: 54 have to be shared, so 6 may stand before the second token besides the first
    assert len(set(rest["key"].tolist())) == 28 and set(found[1].tolist()) == set(range(1, n))
    own["size"] = np.full(n * after, (m << 31) | 12)
    found, rest = line_dedup.ListSearch(80).search({k: v[:n] for k, v in own.items()} | {"after": np.full(n, 7, "<u2")})
    assert not found.shape[1] and not len(rest["key"])


def test_line_dedup_rounds_of_few_lines(spark, monkeypatch):
    """Lists go in rounds with the lines that a line without a match has to try, not with all lines; results match brute force."""
    r = random.Random(4)
    often = [f"y{i}" for i in range(40)]
    items = [(doc, " ".join([f"w{i}" for i in range(24)] + r.sample(often, 6))) for doc in range(160)]
    items.append((160, "\n".join(" ".join(often + [f"u{i * 15 + k}" for k in range(15)]) for i in range(170))))
    want, rows, scratch = brute_lines(items), [], line_dedup.scratch

    def counted(df, tag):
        out = scratch(df, tag)
        rows.extend([out.count()] if tag in ("rest", "members") else [])
        return out

    monkeypatch.setattr(line_dedup, "scratch", counted)
    made = []
    for seekers, ways in ((64, {"long": 20, "wide": 10, "paired": 8, "growth": 8}), (0, {"long": 20, "wide": 10, "paired": 8})):
        monkeypatch.setattr(line_dedup, "SEEKERS", seekers, raising=False)
        rows.clear()
        assert {x["doc_id"]: x["text"] for x in line_dedup.dedup_lines(texts(spark, items), **ways).collect()} == want, ways
        made.append(sum(rows))
    assert made[0] < min(made[1], 4000), made


def test_line_dedup_of_many_lines(spark):
    """Lines beyond 2**20 of a document, hashed ids, and rows of one doc_id."""
    head = "\n" * (1 << 20)
    items = [(-(1 << 63), head + "one two three\none two three"), ((1 << 63) - 1, "one two three\nwholly different words here"), (7, "p q r s"), (7, "p q r s\nnew words stand here")]
    got = [(x["doc_id"], x["text"], x["removed"]) for x in line_dedup.dedup_lines(spark.createDataFrame(items, "doc_id long, text string")).collect()]
    by = {(d, t.strip("\n")): r for d, t, r in got}
    assert by[-(1 << 63), "one two three"] == [(1 << 20) + 1] and by[(1 << 63) - 1, "wholly different words here"] == [0]
    assert sorted(r for d, _, r in got if d == 7) == [[], [0]]


def test_words_of_lines():
    r = random.Random(5)
    parts = ["a", "B", "é", "İ", "ß", "Σ", "_", "9", "²", "\ud800", "\U0001d7d9", "-", " ", "\n", "\r", "中", "x" * 300]
    pieces = ["".join(r.choice(parts) for _ in range(r.randint(0, 200))) for _ in range(60)]
    found = line_words.Lines(pieces)
    want = [(i, k, line_dedup.line_tokens(line)) for i, t in enumerate(pieces) for k, line in enumerate(t.split("\n"))]
    want = [(i, k, w) for i, k, w in want if w]
    assert list(zip(found.owner.tolist(), found.line.tolist(), found.n.tolist())) == [(i, k, len(w)) for i, k, w in want]
    assert [line_dedup.line_tokens(found.string(i)) for i in range(len(want))] == [w for _, _, w in want]
    ids = {}
    assert all(ids.setdefault(tuple(w), c) == c for (_, _, w), c in zip(want, zip(found.c, found.c2))) and len(set(ids.values())) == len(ids)
    texts_ = [(i, t) for i, t in enumerate(pieces)]
    for size in (1, 50, 1 << 20):
        rows = [(keys[o], f, tuple(line_dedup.line_tokens(x.string(j)))) for keys, first, x in line_words.chunks(iter(texts_), size) for j, (o, f) in enumerate(zip(x.owner.tolist(), (first[x.owner] + x.line).tolist()))]
        assert rows == [(i, k, tuple(w)) for i, k, w in want], size


def test_line_dedup_edge_cases(spark):
    items = [(1, "a b c\n\n***\na b c"), (2, None), (3, ""), (4, "c b a"), (None, "a b c"), (5, "long " * 3000)]
    df = texts(spark, items).withColumn("removed", F.lit("clash"))
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert {k: r["text"] for k, r in got.items()} == {1: "a b c\n\n***", 2: None, 3: "", 4: "", None: "a b c", 5: "long " * 3000}
    assert got[1]["removed"] == [3] and got[4]["removed"] == [0] and got[5]["removed"] == []
    assert line_dedup.dedup_lines(df.where("false")).count() == 0
    assert line_dedup.prefix_length(60, 80) == 13


def test_fingerprints(spark):
    items = [(10, "one two three four five six seven eight"), (20, None), (30, ""), (40, "one two three four five six seven eight"), (45, "é" * 7), (None, "z")]
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(texts(spark, items), rows_per_cell=2).collect()}
    assert got[10]["fingerprint"] == got[40]["fingerprint"] and len(got[10]["fingerprint"]) == 4 * fingerprints.SKETCHES
    assert got[20]["n_chars"] == 0 and got[20]["fingerprint"] == "" and got[20]["near_next"] == 1.0 and got[30]["near_next"] == 0.0
    assert got[10]["near_next"] == 0.0 and got[45]["n_chars"] == 7
    import hashlib

    order = [None, 10, 20, 30, 40, 45]
    text = {d: t or "" for d, t in items}
    for a, b in zip(order, order[1:] + order[:1]):
        h = len(text[a]) // 2
        assert got[a]["edited_sha256"] == hashlib.sha256((text[a][: len(text[a]) - h] + text[b][:h]).encode()).hexdigest()
    assert fingerprints.fingerprints(texts(spark, items).where("false")).count() == 0


def brute_signatures(spark, texts_):
    """Order MinHash by definition, over the engine's own hash."""
    import re

    words = {t: re.findall(fingerprints.WORD, t) for t in texts_}
    rows = {tuple(w[i : i + 2]) for w in words.values() for i in range(len(w))}
    bits = (1 << 64) - 1
    df = spark.createDataFrame([(a, b[0] if b else None) for a, *b in rows], "a string, b string")
    h = {(r["a"],) + ((r["b"],) if r["b"] is not None else ()): (r["h"] & bits) >> 32 for r in df.select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}
    items = {}
    for t, w in words.items():
        seen = {}
        items[t] = []
        for i in range(len(w)):
            x = h[tuple(w[i : i + 2])]
            items[t].append((x, seen.setdefault(x, []).append(0) or len(seen[x]) - 1))
    pairs = sorted({x for v in items.values() for x in v})
    again = {(r["x"], r["o"]): (r["v"] & bits) >> 32 for r in spark.createDataFrame(pairs, "x long, o int").select("x", "o", F.xxhash64("x", "o").alias("v")).collect()}
    ids = {t: [x if o == 0 else again[x, o] for x, o in v] for t, v in items.items()}
    every = spark.createDataFrame([(x,) for x in sorted({x for v in ids.values() for x in v})], "x long")
    last = fingerprints.ROUNDS + fingerprints.SKETCHES
    seed = lambda k: F.lit(k * fingerprints.ROUND).cast("long") if k < fingerprints.ROUNDS else F.lit(k)
    draw = {(r["x"], k): v & bits for r in every.select("x", *(F.xxhash64("x", seed(k)).alias(f"k{k}") for k in range(last + 1))).collect() for k, v in enumerate(r[1:])}
    chosen = {}
    for t, v in ids.items():
        order = sorted(range(len(v)), key=lambda i: (v[i], i))
        queue = {f: [] for f in range(fingerprints.SKETCHES)}
        for k in range(fingerprints.ROUNDS):
            for j, i in enumerate(order):
                d = draw[v[i], k]
                queue[d >> 57].append((k, d >> 32 & 262143, j, i))
        for f in queue:
            queue[f] += [(fingerprints.ROUNDS, draw[v[i], fingerprints.ROUNDS + 1 + f] >> 46, j, i) for j, i in enumerate(order)]
            two = list(dict.fromkeys(i for *_, i in sorted(queue[f])))[:2]
            chosen[t, f] = [v[i] for i in sorted(two)] * (1 if len(two) == 2 else 2)
    table = sorted({tuple(x) for x in chosen.values()  if x})
    coordinate = {(r["a"], r["b"]): r["v"] & 65535 for r in spark.createDataFrame(table, "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("v")).collect()}
    return {t: [coordinate[tuple(chosen[t, f])] for f in range(fingerprints.SKETCHES)] if v else [] for t, v in ids.items()}


def test_fingerprints_match_definition(spark):
    r = random.Random(4)
    items = [(i * 7, " ".join(f"w{r.randint(0, 9 + 40 * (i % 3))}" for _ in range([1, 2, 3, 12, 40, 130][i % 6]))) for i in range(14)]
    items += [(200, ""), (201, None), (202, "漢字かな mixed " * 4), (203, "x" * 30)]
    docs = dict(sorted((d, t or "") for d, t in items))
    following = dict(zip(docs, [*list(docs.values())[1:], next(iter(docs.values()))]))
    edited = {d: t[: len(t) - len(t) // 2] + following[d][: len(t) // 2] for d, t in docs.items()}
    want = brute_signatures(spark, {*docs.values(), *edited.values()})
    like = lambda a, b: 1.0 if not a and not b else 0.0 if not a or not b else sum(x == y for x, y in zip(a, b)) / fingerprints.SKETCHES
    for cell in (1, 5, 100):
        got = {x["doc_id"]: x for x in fingerprints.fingerprints(texts(spark, items), rows_per_cell=cell).collect()}
        for d, t in docs.items():
            own, changed, after = want[t], want[edited[d]], want[following[d]]
            assert got[d]["fingerprint"] == "".join(f"{v:04x}" for v in own) and got[d]["edited_fingerprint"] == "".join(f"{v:04x}" for v in changed), (d, t)
            assert (got[d]["near_edited"], got[d]["near_next"]) == (like(own, changed), like(own, after))


def test_word_patterns_agree(spark):
    """The pattern that runs finds the words of the defining one, for every code point and for runs of several kinds."""
    r = random.Random(6)
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    items = ["".join(points[i : i + 30_000]) for i in range(0, len(points), 30_000)]
    items += ["".join(r.choice("ab9_é—☃ \t\n\r\f\v\x1f\x7f\x85\u00a0\u3000\u0dff\u0e00\u0eff\u0f00ก一龥あヿ\u3100㐀\u4dc0\U00020000") for _ in range(400)) for _ in range(50)]
    rows = spark.createDataFrame(list(enumerate(items)), "i int, t string").selectExpr("i", f"regexp_extract_all(t, r'{fingerprints.PATTERN}', 0) w").collect()
    assert len(rows) == len(items) and all(x["w"] == re.findall(fingerprints.WORD, items[x["i"]]) for x in rows)


def test_fingerprint_of_a_long_text(spark):
    """Texts around the length from which one round is drawn, and a long one: the same as by all rounds."""
    r = random.Random(6)
    cases = [" ".join(f"w{r.randint(0, 4000)}" for _ in range(n)) for n in (fingerprints.DRAWS - 1, fingerprints.DRAWS, 60_000)]
    got = [x["s"] for x in fingerprints.with_signature(spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string"), "t", "s").orderBy("i").collect()]
    assert [got[0], got[1]] == [brute_signatures(spark, [t])[t] for t in cases[:2]] and len(got[2]) == fingerprints.SKETCHES
    words = cases[2].split()
    edits = [words[: 60_000 - k] + [f"x{i}" for i in range(k)] for k in (600, 30_000)]
    near = [x["s"] for x in fingerprints.with_signature(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(edits)], "i int, t string"), "t", "s").orderBy("i").collect()]
    share = [sum(a == b for a, b in zip(got[2], v)) / fingerprints.SKETCHES for v in near]
    assert share[0] > 0.9 and 0.05 < share[1] < 0.4


def test_cells_of_outlying_and_repeated_ids(spark):
    ids = [-(1 << 63), (1 << 63) - 1, *range(0, 400, 3), *[150] * 20, None]
    items = [(d, f"text {k}") for k, d in enumerate(ids)]
    got = [(x["doc_id"], x["text"], x["next_text"]) for x in fingerprints.with_next(texts(spark, items), rows_per_cell=5).where("_guest = 0").collect()]
    order = sorted(items, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert sorted(got, key=repr) == sorted(((d, t, n) for (d, t), (_, n) in zip(order, order[1:] + order[:1])), key=repr)
