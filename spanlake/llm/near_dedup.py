"""MinHash near-dedup with fast similarity sketches, banding and exact verification.

A document's sketch has ``T`` coordinates.  In round i < T every shingle is thrown into one hashed bin; an empty
bin takes the least value of the first round that reaches it.  Round T + i throws all shingles into bin i, so
that every coordinate is filled after 2 T rounds at the latest; rounds stop once no bin is empty.  Two sketches
agree in a coordinate with the probability of the Jaccard similarity of the sets, with concentration as for
independent coordinates.  Bands of coordinates make the buckets, as many rows each as keep a pair at the threshold from sharing
none with a probability of over ``MISSED``: at 0.85, 48 bands of 8, (1 - 0.85**8)**48 = 2e-7; at 0.8, 54 bands of 7, 3e-6.

Texts with the same words are one class and go on as one document.  In a bucket, hubs are tried against the
members of other components instead of all pairs: first one hub, then ever more, until each member of a bucket
that still spans several components has been a hub (large buckets: block against block).  Only pairs that some bucket holds and no component
already joins are verified, each once and on full shingle sets, so components are those of all pairs in common buckets.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, drop_scratch, scratch, small_batches

T = 384
#: Largest probability that a pair at the threshold shares no bucket.
MISSED = 1e-5
#: Word hashes that a task keeps; the store is emptied when it is full.
STORE = 100_000
#: Shingles in the sets that a verifying task keeps at hand.
SETS = 200_000
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def banding(percent: int) -> tuple[int, int]:
    """(rows, bands): the most rows of a band, up to 8, with which a pair at ``percent`` % is missed with a probability of ``MISSED`` at most."""
    for rows in range(8, 1, -1):
        if (1 - (percent / 100) ** rows) ** (T // rows) <= MISSED:
            return rows, T // rows
    return 1, T


SEEDS = _mix(np.arange(1, 2 * T + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def words_of(text: str | None) -> list[bytes]:
    """Words between white space (\\x20, \\x09-\\x0D), A-Z lowered."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(words: list[bytes], k: int) -> frozenset:
    """Distinct ``k``-word shingles; the whole sequence as one if it is shorter."""
    return frozenset(zip(*(words[i:] for i in range(k)))) if len(words) >= k else frozenset([tuple(words)] if words else [])


class Sketcher:
    """Hashed shingle sets and their sketches."""

    def __init__(self, k: int, percent: int = 85):
        self.k = k
        self.rows, self.count = banding(percent)
        self.store: dict[bytes, int] = {}

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingle set."""
        if len(self.store) > STORE:
            self.store.clear()
        get, store = self.store.get, self.store
        h = []
        for w in words:
            v = get(w)
            if v is None:
                v = store[w] = xxhash.xxh3_64_intdigest(w)
            h.append(v)
        h = np.array(h, np.uint64)
        if len(h) < self.k:
            x = np.array([xxhash.xxh3_64_intdigest(b"\n".join(words))], np.uint64) if words else h
        else:
            x = np.zeros(len(h) - self.k + 1, np.uint64)
            for i in range(self.k):
                x = _mix(x * _U(0x9E3779B97F4A7C15) + h[i : len(h) - self.k + 1 + i])
        return np.unique(x)

    def sketch(self, x: np.ndarray) -> np.ndarray:
        """The ``T`` coordinates of a non-empty set of hashes: (round, value) packed, least first."""
        s = np.full(T, np.iinfo(np.uint64).max, np.uint64)
        i = 0
        while i < T:
            rounds = min(T - i, max(1, 3000 // len(x)))
            h = _mix(x[None, :] ^ SEEDS[i : i + rounds, None])
            value = (np.arange(i, i + rounds, dtype=np.uint64)[:, None] << _U(52)) | (h >> _U(12))
            np.minimum.at(s, (_mix(h) % _U(T)).astype(np.int64).ravel(), value.ravel())
            i += rounds
            if s.max() != np.iinfo(np.uint64).max:
                return s
        for b in np.flatnonzero(s == np.iinfo(np.uint64).max):
            s[b] = (_U(T + b) << _U(52)) | (_mix(x ^ SEEDS[T + b]).min() >> _U(12))
        return s

    def bands(self, x: np.ndarray) -> list[int]:
        """One 64-bit bucket key for each band."""
        s = self.sketch(x)[: self.rows * self.count].reshape(self.count, self.rows)
        key = np.arange(self.count, dtype=np.uint64)
        for r in range(self.rows):
            key = _mix(key * _U(0x9E3779B97F4A7C15) + s[:, r])
        return key.view(np.int64).tolist()


def sketches(documents: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, cls (digest of the word sequence; null without words), keys (bucket keys)."""

    def run(batches):
        sketcher = Sketcher(k, percent)
        for pdf in batches:
            for a in range(0, len(pdf), 1000):
                part, out = pdf.iloc[a : a + 1000], []
                for text in part["text"]:
                    words = words_of(text)
                    if not words:
                        out.append((0, None, None))
                        continue
                    x = sketcher.shingles(words)
                    out.append((len(x), xxhash.xxh3_128_hexdigest(b" ".join(words)), sketcher.bands(x)))
                frame = pd.DataFrame(out, columns=["n_shingles", "cls", "keys"])
                frame.insert(0, "doc_id", part["doc_id"].astype("Int64").to_numpy())
                yield frame.astype({"doc_id": "Int64"})

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, n_shingles long, cls string, keys array<long>")


def verifier(texts: DataFrame, k: int, percent: int) -> Callable[[DataFrame], DataFrame]:
    """Pairs (a, b) -> (a, b, linked) by the shingle sets of whole texts (node, text)."""

    def run(batches):
        sets: dict[str, frozenset] = {}
        held = 0

        def of(text):
            nonlocal held
            found = sets.get(text)
            if found is None:
                if held > SETS:
                    sets.clear()
                    held = 0
                found = sets[text] = shingle_set(words_of(text), k)
                held += len(found)
            return found

        for pdf in batches:
            ok = []
            for x, y in zip(pdf["x"], pdf["y"]):
                p, q = of(x), of(y)
                both = len(p & q)
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pdf[["a", "b"]].assign(linked=ok)

    def verify(pairs: DataFrame) -> DataFrame:
        left, right = texts.toDF("a", "x"), texts.toDF("b", "y")
        return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long, linked boolean")

    return verify


#: Members of a key that are dealt to one task.
DEALT = 512


def with_key(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows(key, node, parts)`` joined with what ``keys`` has for each key; a key's rows are dealt to ``parts`` tasks by node."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    every = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return salted.join(every, ["key", "_salt"]).drop("_salt")


def shared_keys(members: DataFrame) -> DataFrame:
    """The ``members(key, node)`` whose key has several, with the key's ``parts``, written to shared storage."""
    parts = F.ceil(F.col("n") / DEALT).cast("int")
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", parts.alias("parts"))
    return scratch(members.join(shared, "key").select("key", "node", "parts"), "shared")


def link_by_hubs(members: DataFrame, verify: Callable[[DataFrame], DataFrame], by_blocks: Callable[[DataFrame], DataFrame], growth: int = 8, crowd: int = 64) -> DataFrame:
    """Components (node, component) of the verified pairs among ``members(key, node, parts)`` of common keys.

    ``members`` holds keys of several nodes only, see ``shared_keys``; it is deleted when it is used up.

    Each round takes hubs (the least node of each of ``many`` hashed parts of a key that hasn't been one),
    pairs them with the members that haven't been hubs and are in other components, and verifies new pairs.
    A key leaves when all its members are in one component or have been hubs.  After the first round, keys that still
    have over ``crowd`` members to try are joined to clusters, and each cluster's pairs are searched block by block (``by_blocks``), which
    returns links without emitting pairs.
    """
    spark = members.sparkSession
    rest = members.select("key", "node", "parts", F.lit(False).alias("done"), F.col("node").alias("label"))
    edges = spark.createDataFrame([], "a long, b long")
    tested = spark.createDataFrame([], "a long, b long")
    components = spark.createDataFrame([], "node long, component long")
    many = 1
    while not rest.isEmpty():
        part = F.pmod(F.xxhash64("node"), F.lit(many))
        hubs = rest.where("not done").groupBy("key", part.alias("part")).agg(F.min("node").alias("node"))
        hubs = hubs.select("key", "node")
        with_label = hubs.join(rest.select("key", "node", "label", "parts"), ["key", "node"]).select("key", "parts", F.col("node").alias("hub"), F.col("label").alias("hub_label"))
        pairs = (
            with_key(rest.where("not done"), with_label).where("node <> hub and label <> hub_label")
            .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
            .join(tested, ["a", "b"], "left_anti")
        )
        judged = scratch(verify(pairs), "judged")
        tested = tested.union(judged.where("not linked").select("a", "b"))
        new = judged.where("linked").select("a", "b")
        if not new.isEmpty():
            edges = edges.union(new)
            components = scratch(connected_components(edges), "components")
        done = rest.drop("label").join(hubs.withColumn("_hub", F.lit(True)), ["key", "node"], "left").select("key", "node", "parts", (F.col("done") | F.coalesce("_hub", F.lit(False))).alias("done"))

        def still_open(after: DataFrame, components: DataFrame) -> DataFrame:
            after = after.join(components, "node", "left").select("key", "node", "parts", "done", F.coalesce("component", "node").alias("label"))
            keys = after.groupBy("key").agg(F.max("parts").alias("parts"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("done").alias("all_done"), F.count_if(~F.col("done")).alias("todo"))
            return with_key(after, keys.where("lo < hi and not all_done").select("key", "parts", "todo"))

        left = scratch(still_open(done, components), "members")
        drop_scratch(members if many == 1 else rest)
        if many == 1:
            crowded = left.where(F.col("todo") > crowd)
            if not crowded.isEmpty():
                edges = edges.union(scratch(by_blocks(crowded.select("key", "node", "label")), "blocks"))
                components = scratch(connected_components(edges), "components")
                small = scratch(still_open(left.where(F.col("todo") <= crowd).select("key", "node", "parts", "done"), components), "members")
                drop_scratch(left)
                left = small
        rest, many = left.drop("todo"), many * growth
    return components


#: Documents of a block.
BLOCK = 256


def block_search(texts: DataFrame, k: int, percent: int) -> Callable[[DataFrame], DataFrame]:
    """Crowded ``members(key, node, label)`` -> links (a, b) that join all their components.

    Keys that share nodes are one cluster.  A cluster of n documents is dealt into n / BLOCK blocks by hash; every pair of blocks is
    one group of at most about 2 BLOCK texts, whatever n, so no task holds a cluster.  A group looks for pairs of different
    labels in an inverted index of its shingles and gives one link for each two labels that it joins.
    """

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        sketcher = Sketcher(k)
        nodes, labels, blocks = pdf["node"].tolist(), pdf["label"].tolist(), pdf["block"].tolist()
        sets = [sketcher.shingles(words_of(t)) for t in pdf["text"]]
        one = blocks.count(blocks[0]) == len(blocks)
        root: dict = {x: x for x in labels}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        values, place = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(place, kind="stable")
        starts = np.searchsorted(place[order], np.arange(len(values) + 1))
        sizes = np.array([len(s) for s in sets])
        out, at = [], 0
        for i, s in enumerate(sets):
            own = place[at : at + len(s)]
            at += len(s)
            hit = np.concatenate([owner[order[starts[p] : starts[p + 1]]] for p in own]) if len(own) else own
            both = np.bincount(hit, minlength=len(sets))
            for j in np.flatnonzero(100 * both >= percent * (sizes + sizes[i] - both)).tolist():
                if j < i and (one or blocks[i] != blocks[j]) and find(labels[i]) != find(labels[j]):
                    if len(p := shingle_set(words_of(pdf["text"].iloc[i]), k)) and 100 * len(p & (q := shingle_set(words_of(pdf["text"].iloc[j]), k))) >= percent * len(p | q):
                        root[find(labels[i])] = find(labels[j])
                        out.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    def by_blocks(crowded: DataFrame) -> DataFrame:
        star = crowded.join(crowded.groupBy("key").agg(F.min("node").alias("low")), "key").select(F.col("node").alias("a"), F.col("low").alias("b"))
        cluster = connected_components(star).withColumnRenamed("component", "cluster")
        nodes = crowded.select("node", "label").distinct().join(cluster, "node")
        n = nodes.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
        dealt = nodes.join(n, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
        other = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
        pairs = other.select("cluster", "node", "label", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        return pairs.join(texts, "node").groupBy("cluster", "i", "j").applyInPandas(search, "a long, b long")

    return by_blocks


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80, crowd: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links of ``percent`` %), kept.

    One row for each row of ``documents``.  A null or empty text, or one without words, has no shingles and is linked
    with nothing; fewer than ``k`` words are one shingle.  Rows of one doc_id are one document.  A null doc_id is in
    no component and is kept.  An empty table gives an empty result; other columns are ignored.
    """
    small_batches(documents.sparkSession)
    sk = scratch(sketches(documents, k, percent), "sketches")
    classes = sk.where("cls is not null and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("node"))
    classes = scratch(classes, "classes")
    reps = sk.where("cls is not null").join(classes, "cls").where("doc_id = node").select("node", "keys")
    members = shared_keys(reps.select("node", F.explode("keys").alias("key")))
    # a document whose rows hold several texts ties their classes together
    ties = sk.where("cls is not null").join(classes, "cls").where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    own = ties.join(classes.select(F.col("node").alias("a")).distinct(), "a", "left_semi")
    held = members.select("node").distinct()
    texts = scratch(documents.select(F.col("doc_id").cast("long").alias("node"), "text").where("text is not null").join(held, "node"), "texts")
    components = link_by_hubs(members, verifier(texts, k, percent), block_search(texts, k, percent), crowd=crowd)
    drop_scratch(texts)
    if not own.isEmpty():
        linked = components.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        components = connected_components(linked.union(own))
    found = classes.join(components, "node", "left").select("cls", F.coalesce("component", "node").alias("component_id"))
    out = sk.select("doc_id", "n_shingles", "cls").join(found, "cls", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def oracle(k: int, percent: int) -> str:
    """DuckDB SQL for ``near_duplicates`` over ``documents``: shared shingles counted for each pair, then closure."""
    shingle = " || ' ' || ".join(f"w[i + {j}]" for j in range(1, k + 1))
    return f"""
with recursive d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < {k} then [array_to_string(w, ' ')] else list_distinct(list_transform(range(len(w) - {k - 1}), lambda i: {shingle})) end s from d),
e as (select doc_id, unnest(s) h from s),
p as (select a.doc_id a, b.doc_id b, count(*) n from e a join e b on a.h = b.h and a.doc_id < b.doc_id group by all),
l as (select a, b from p join s x on x.doc_id = a join s y on y.doc_id = b where 100 * n >= {percent} * (len(x.s) + len(y.s) - n)),
u as (select a, b from l union all select b, a from l),
r as (select doc_id node, doc_id root from s union select u.b, r.root from r join u on u.a = r.node)
select doc_id, cast(len(s) as bigint) n_shingles, c component_id, doc_id = c kept from s join (select node, min(root) c from r group by node) on node = doc_id
"""
