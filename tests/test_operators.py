"""Worked cases and properties of the operators."""

import random

from pyspark.sql import functions as F

from spanlake.functions import codec
from spanlake.operators import align, asof, digest, duplex, fuzzy, intervals, junctions, sites, snv


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_nearest_site(spark):
    s = spark.createDataFrame([(1, 100), (1, 200)], "chrom_index1 bigint, site_pos1 bigint")
    q = spark.createDataFrame([(1, p) for p in (100, 149, 150, 151, 50, 250)] + [(2, 5)], "chrom_index1 bigint, pos1 bigint")
    found = {r["pos1"]: (r["site_index1"], r["site_pos1"], r["distance"]) for r in asof.nearest_site(q, s).collect()}
    assert found == {100: (1, 100, 0), 149: (1, 100, 49), 150: (-2, 200, -50), 151: (-2, 200, -49), 50: (None,) * 3, 250: (None,) * 3, 5: (None,) * 3}


def spans(spark, *items):
    return spark.createDataFrame([(1, a, b, f"n{i}") for i, (a, b) in enumerate(items)], "chrom_index1 bigint, start0 bigint, end1 bigint, name string")


def test_split_and_collapse(spark):
    assert rows(intervals.elementary_segments(spans(spark, (0, 13), (7, 21))), "start0", "end1", "n") == [(0, 7, 1), (7, 13, 2), (13, 21, 1)]
    c = intervals.collapse(spans(spark, (0, 5), (5, 9), (20, 30)))
    assert rows(c, "start0", "end1") == [(0, 9), (20, 30)]
    assert rows(intervals.collapse(c.withColumnRenamed("names", "name").drop("n")), "start0", "end1") == [(0, 9), (20, 30)]


def test_coverage_keeps_all_bases(spark):
    random.seed(3)
    items = [(a, a + random.randint(1, 40)) for a in (random.randint(0, 200) for _ in range(100))]
    runs = intervals.coverage_runs(spans(spark, *items))
    assert sum((b - a) * c for a, b, c in rows(runs, "start0", "end1", "coverage")) == sum(b - a for a, b in items)


def test_interval_operators_on_empty_input(spark):
    none = spans(spark, (0, 1)).where("false")
    assert intervals.coverage_runs(none).count() == 0
    assert intervals.collapse(none).count() == 0
    assert intervals.overlap_join(spans(spark, (0, 5)), none, 10, "left_anti").count() == 1


def test_nxx(spark):
    s = spark.createDataFrame([(1, n) for n in (5, 4, 3, 2)], "k bigint, size bigint")
    assert digest.nxx(s, ["k"]).first()["nxx"] == 4


def test_fuzzy_groups_dont_depend_on_row_order(spark):
    random.seed(1)
    items = [(codec.NODE_MASK + 1 + random.randint(1, 400), codec.NODE_MASK + 1 + random.randint(1, 400), 0, q, 0) for q in range(80)]
    chroms = spark.createDataFrame([(1, 1000)], "chrom_index1 bigint, chrom_size bigint")
    out = []
    for _ in range(2):
        random.shuffle(items)
        df = spark.createDataFrame(items, "node1 bigint, node2 bigint, jxn_offset bigint, qname bigint, aln_i bigint")
        out.append(rows(fuzzy.fuzzy_junctions(df, chroms), "qname", "i1", "i2", "i3"))
    assert out[0] == out[1]


def test_channel_and_span_duplicates(spark):
    keys = "k bigint, qname string, aln_i bigint, channel bigint, orientation bigint, outer1 bigint, outer2 bigint, jxn_seq string, best bigint"
    a = spark.createDataFrame([(1, q, 0, 7, o, 1, 2, s, 3) for q, o, s in (("a", 0, "AC"), ("b", 0, "ACG"), ("c", 1, "AC"))], keys)
    assert rows(junctions.mark_channel_duplicates(a, ["k"]), "qname", "is_duplicate") == [("a", 0), ("b", 0), ("c", 1)]
    assert rows(junctions.mark_span_duplicates(a, ["k"], "best"), "qname", "is_duplicate") == [("a", 1), ("b", 0), ("c", 1)]


def test_tag_walks():
    true = [True] * 20
    assert snv.walk(":3*ag:2", true, [30] * 20, 0, 10, 20) == [("ref", 10, 3, None, True, 0), ("base", 13, 1, "G", True, 1), ("variant", 13, 1, "G", True, 1), ("ref", 14, 2, None, True, 0)]
    ins = snv.walk(":3+tt:2", true, [30] * 20, 0, 10, 20)
    assert ins[1][:3] == ("ins", 12, 1) and ins[2][:2] == ("variant", 12) and ins[2][3:] == ("TT", True, 0)
    gone = snv.walk(":3-ac:2", true, [30] * 20, 0, 10, 20)
    assert gone[1][:3] == ("del", 13, 2) and gone[2][:2] == ("variant", 13) and gone[2][3:] == ("", True, 2)
    assert [e[0] for e in snv.walk(":3*ag", true, [30] * 20, 0, 10, 20)] == ["ref", "base"]


def test_read_mask():
    assert snv.read_mask("=3!NN?ACCGAT=1", 7, False) == [True] * 3 + [False] * 3 + [True]
    assert snv.read_mask("=3!NN?ACCGAT=1", 7, True) == [True] + [False] * 3 + [True] * 3


def test_pileup_counts(spark):
    a = spark.createDataFrame([(1, 10, 0, 0, ":3*ag:2", None, [30] * 6, 1, 5), (1, 10, 0, 0, ":3-ac:2", None, [30] * 6, 2, 7)], "chrom_index1 bigint, pos0 bigint, qry_start0 bigint, strand0 bigint, cs string, dd string, qual array<int>, sample_bit bigint, n_passes bigint")
    e = snv.events(a, 20)
    p = snv.pileup(e)
    assert rows(p, "start0", "end1", "n_ref", "n_g", "n_del", "coverage") == [(10, 13, 2, 0, 0, 2), (13, 14, 0, 1, 1, 2), (14, 15, 1, 0, 1, 2), (15, 16, 2, 0, 0, 2), (16, 17, 1, 0, 0, 1)]
    assert rows(snv.variants(e, p), "pos0", "n_ref", "alt_bases", "n", "coverage", "max_n_passes") == [(13, 1, "G", 1, 2, 5), (13, 2, "", 1, 2, 7)]


def brute_local(q, r):
    """Best local score over all gap-free and gapped paths, by plain recursion over affine states."""
    best = 0.0
    n, m = len(q), len(r)
    h = [[(0.0, 0)] * (n + 1) for _ in range(m + 1)]
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            d = h[i - 1][j - 1][0] + align.pair_score(r[i - 1], q[j - 1])
            u = h[i - 1][j][0] + (-1 if h[i - 1][j][1] == 2 else -2.501)
            le = h[i][j - 1][0] + (-1 if h[i][j - 1][1] == 3 else -2.501)
            s = max(d, u, le)
            h[i][j] = (s, 1 if s == d else 2 if s == u else 3) if s > 0 else (0.0, 0)
            best = max(best, s)
    return best


def test_duplex_differences_by_reference():
    one = lambda a, b, ref=None: duplex.merge_many([a], [[9] * len(a)], [b], [[5] * len(b)], [ref])[0]
    ref = "ACGTTGCAACGGTCA"
    assert one(ref, ref, ref) == (ref, [9] * 15, "=15", 0)
    both = ref[:7] + "G" + ref[8:]
    assert one(both, both, ref)[2:] == ("=7*GA=7", duplex.BOTH_SUBS)
    assert one(ref[:7] + "G" + ref[8:], ref, ref)[::2] == (ref, "=7<GA=7") and one(ref[:7] + "G" + ref[8:], ref[:7] + "C" + ref[8:], ref)[2:] == ("=7&GC=7", duplex.SUBS | duplex.SUBS_NEITHER)
    lacks = ref[:6] + ref[7:]
    assert one(ref, lacks, ref) == (ref, [9] * 15, "=6-C=8", duplex.INDEL) and one(lacks, ref, ref)[::2] == (ref, "=6-C=8")
    more = ref[:6] + "T" + ref[6:]
    assert one(more, ref, ref)[::2] == (ref, "=6+T=9") and one(ref, more, ref)[::2] == (ref, "=6+T=9")
    assert one(ref, lacks)[:3] == (ref[:6] + "N" + ref[7:], [9] * 6 + [0] + [9] * 8, ":6!C:8")


def test_alignment_modes():
    assert align.align("ACGTACGTAC", "TTACGTACGTACGG", "query_end") == (10.0, 0, 10, 2, 12)
    assert align.align("GGACGTACG", "TTACGTACGTTTT", "query_end")[:3] == (7.0, 2, 9)
    assert align.align("ACGTACGCC", "TTACGTACGTTTT", "query_start")[:3] == (7.0, 0, 7)
    assert align.align("ACGT", "ACGTTTTTACGT", "query_end") == (0.0, 0, 0, 0, 0)  # two ends as good
    assert align.align("ACGTACGT", "TACGTACGTT", "ends", 3)[0] == 8.0


def test_blocked_scans_match_plain_windows(spark):
    from pyspark.sql import Window

    from spanlake.operators import blocks

    random.seed(9)
    rows_ = [(c, random.randint(-400, 400), random.choice([None, 1, 5])) for c in (1, 2) for _ in range(60)]
    df = spark.createDataFrame(sorted({(c, p): v for c, p, v in rows_}.items()), "k struct<c:int,p:long>, v int").select("k.c", "k.p", "v")
    w = Window.partitionBy("c").orderBy("p")
    before, up = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("c", "p", F.sum("v").over(up).alias("s"), F.max("v").over(before).alias("m"), F.lag("v").over(w).alias("g"), F.lead("v").over(w).alias("d"), F.min("p").over(w.rowsBetween(1, Window.unboundedFollowing)).alias("n"))
    got = blocks.scan(df, ["c"], "p", ["p"], 64, s=("sum", F.col("v")), m=("max_before", F.col("v")), g=("lag", F.col("v")), d=("lead", F.col("v")), n=("min_after", F.col("p")))
    names = ("c", "p", "s", "m", "g", "d", "n")
    assert rows(got, *names) == rows(want, *names)
    groups = blocks.number_groups(df, ["c"], "p", "g", lambda x, y: x - y > 20, 64)
    flag = df.withColumn("f", F.when(F.col("p") - F.lag("p").over(w) <= 20, 0).otherwise(1)).withColumn("g", F.sum("f").over(up))
    assert rows(groups, "c", "p", "g") == rows(flag, "c", "p", "g")


def test_long_regions_take_few_bins(spark):
    spans = spark.createDataFrame([(1, 0, 3_000_000, "a"), (1, 100, 700, "b"), (1, 5_000, 5_000, "c"), (1, 2_999_000, 900_000_000, "d")], "chrom_index1 long, start0 long, end1 long, name string")
    assert intervals.levelled(spans, 512).groupBy("name").count().agg(F.max("count")).first()[0] <= intervals.STEP + 1
    points = spark.createDataFrame([(1, p) for p in (1, 101, 700, 701, 2_999_500, 3_000_001, 900_000_000, 900_000_001)], "chrom_index1 long, pos1 long")
    got = sorted((r["pos1"], r["name"]) for r in intervals.point_in_interval(points, spans).collect())
    assert got == [(1, "a"), (101, "a"), (101, "b"), (700, "a"), (700, "b"), (701, "a"), (2_999_500, "a"), (2_999_500, "d"), (3_000_001, "d"), (900_000_000, "d")]


def test_alignment_scores():
    random.seed(2)
    for _ in range(30):
        q, r = ("".join(random.choice("ACGTN") for _ in range(random.randint(1, 12))) for _ in range(2))
        if q != r:
            assert align.align(q, r)[0] == brute_local(q, r)
    assert align.align("ACGT", "ACGT") == (4.0, 0, 4, 0, 4)
    assert align.pair_score("A", "R") == 0.5 and align.pair_score("A", "N") == 0 and align.pair_score("A", "C") == -1.5


def test_adapter_trimming(spark):
    adapter = "CCTGTACTTCGTTCAGTTACGTATTGCT"
    body = "ACGATCGGATTTACCGAGGCATCATACGAGGCATTTACCGGA"
    r = spark.createDataFrame([("x", adapter + body, "I" * (len(adapter) + len(body))), ("y", body, "I" * len(body))], "qname string, seq string, qual string")
    assert rows(align.trim_adapters(r, adapter), "qname", "seq", "trim5") == [("x", body, len(adapter)), ("y", body, 0)]


def test_duplex_merge():
    assert duplex.merge_strands("ACGT", [1] * 4, "ACGT", [2] * 4) == ("ACGT", [2] * 4, ":4")
    assert duplex.merge_strands("ACGTACGT", [9] * 8, "ACGAACGT", [5] * 8, "ACGAACGT")[::2] == ("ACGAACGT", "=3<TA=4")
    assert duplex.merge_strands("ACGTACGT", [9] * 8, "ACGAACGT", [5] * 8)[::2] == ("ACGNACGT", ":3?TA:4")


def test_site_clusters(spark):
    assert sites.commit_group([(10, 0, 0), (12, 1, 5)]) == [(10, True, 5)]
    assert sites.commit_group([(10, 1, 2), (12, 1, 5)]) == [(12, False, 2), (12, False, 5)]
    assert sites.commit_group([(10, 0, 0)]) == []
    random.seed(5)
    obs = sorted({random.randint(1, 400) for _ in range(60)})
    known = sorted({random.randint(1, 400) for _ in range(15)})
    o = spark.createDataFrame([(1, p, p % 7 + 1) for p in obs], "chrom_index1 bigint, site_pos1 bigint, n_observed bigint")
    k = spark.createDataFrame([(1, p) for p in known], "chrom_index1 bigint, site_pos1 bigint")
    items = sorted([(p, 0, 0) for p in known] + [(p, 1, p % 7 + 1) for p in obs])
    clusters, want = [[items[0]]], []
    for x in items[1:]:
        clusters[-1].append(x) if x[0] - clusters[-1][-1][0] <= 5 else clusters.append([x])
    for c in clusters:
        for g in sites.split_by_gap(c, 5):
            want += sites.commit_group(g)
    assert rows(sites.match_endpoints(o, k, 5), "site_pos1", "in_silico", "n_observed") == sorted(want)


def test_digest_across_chunks(spark):
    seq = ("ACGTTGCA" * 40 + "GTAC") * 5
    s = spark.createDataFrame([("c", seq)], "chrom string, seq string")
    want = [i + 3 for i in range(len(seq)) if seq[i : i + 4] == "GTAC"]
    assert [r[2] for r in rows(digest.digest(digest.chunks(s, "chrom", 50, 8), "chrom", [("x", "GTAC", 2)], 50), "chrom", "enzyme", "site_pos1")] == want


def test_sample_merge_limit(spark):
    import pytest

    df = spark.createDataFrame([(1,)], "sample_bits bigint")
    assert rows(fuzzy.merge_sample_bits([df, df], [1, 3]), "sample_bits") == [(1,), (2,)]
    with pytest.raises(ValueError):
        fuzzy.merge_sample_bits([df, df], [40, 40])
    assert F is not None


def test_queries_without_sql_read_whole_texts(spark, tmp_path):
    from spanlake.plans import registry

    spell = str.maketrans("ACGT", "abcd")
    seq = "ACGGT" * 500 + "AGCAATACGT"  # ends in the adapter's last bases, reversed
    spark.createDataFrame([(1, seq.translate(spell))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    trimmed = registry.QUERIES["u5_adapter_trim"](spark, str(tmp_path)).first()
    assert (trimmed["trim5"], trimmed["trim3"]) == (32, 10)
    merged = registry.QUERIES["u4_duplex_merge"](spark, str(tmp_path)).first()
    assert len(merged["seq"]) == len(seq)


def test_kinetics_contexts_of_long_reads(spark):
    import time
    from collections import Counter

    dna = random.Random(5)
    reads = {f"r{n}": "".join(dna.choice("ACGT") for _ in range(n)) for n in (0, 1, 2, 3, 4, 33, 34, 35, 36, 66, 67, 1_000_000)}
    s = spark.createDataFrame([*reads.items(), ("none", None)], "qname string, seq string")
    small = s.where("length(seq) < 100").withColumn("ip", F.expr("if(length(seq) > 0, sequence(1, length(seq)), array())")).withColumn("pw", F.expr("transform(ip, x -> -x)"))
    want = sorted((q, i, x[i - 1 : i + 2], i + 1, -i - 1, i + 2) for q, x in reads.items() if len(x) < 100 for i in range(1, len(x) - 1))
    assert rows(duplex.kinetics_contexts(small).withColumn("i", F.expr("ipd_before - 1")), "qname", "i", "base_context", "ipd_before", "pulse_width", "ipd_after") == want
    began = time.monotonic()
    found = duplex.kinetics_contexts(s.withColumn("ip", F.array()).withColumn("pw", F.array())).groupBy("base_context").count()
    assert dict(rows(found, "base_context", "count")) == Counter(x[i : i + 3] for x in reads.values() for i in range(len(x) - 2))
    assert time.monotonic() - began < 60  # minutes where a context is looked for from the read's start


def test_pileup_metadata_without_reported_runs(spark):
    runs = spark.createDataFrame([(1, 0, 5, 2, 2)], "chrom_index1 bigint, start0 bigint, end1 bigint, coverage bigint, n_ref bigint")
    assert tuple(snv.pileup_metadata(runs, runs.where("start0 > 9")).first()) == (1, 0, None, None, 0)


def test_regions_of_crowded_places(spark):
    points = spark.createDataFrame([(1, 1, 10), (1, 1, 40), (2, 1, 10), (None, 1, 10), (3, None, 10), (4, 1, None)], "qname bigint, chrom_index1 bigint, pos1 bigint")
    spans = spark.createDataFrame([(1, 0, 20, "b"), (1, 5, 12, "a"), (1, 39, 40, "c"), (2, 0, 99, "d")], "chrom_index1 bigint, start0 bigint, end1 bigint, name string")
    found = intervals.regions_of_points(points, spans)
    # a point's regions are those of its own place, whatever its name
    got = sorted((str(r["qname"]), str(r["chrom_index1"]), str(r["pos1"]), r["names"], r["nearest_center"]) for r in found.collect())
    assert got == sorted([("1", "1", "10", "a,b", 0), ("1", "1", "40", "c", 1), ("2", "1", "10", "a,b", 0), ("None", "1", "10", "a,b", 0), ("3", "None", "10", "", None), ("4", "1", "None", "", None)])
    hits = intervals.point_in_interval(points, spans)
    assert sorted((str(r["qname"]), r["pos1"], r["name"], r["center_distance"]) for r in hits.collect()) == sorted(
        [("1", 10, "a", 2), ("1", 10, "b", 0), ("1", 40, "c", 1), ("2", 10, "a", 2), ("2", 10, "b", 0), ("None", 10, "a", 2), ("None", 10, "b", 0)]
    )
