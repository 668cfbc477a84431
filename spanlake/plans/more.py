"""More registered queries: aggregations, windows, sorts, set operations and the SQL-expressible user-defined logic."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import codec
from ..operators import align, digest, duplex, fuzzy, inserts, intervals, junctions, lookups, reads, reports, sites, snv
from ..sources import inputs, records
from . import core
from . import fixtures as fx
from .core import CLASSES, COV, FINAL, G, INST, J, PAIRS, big, col, final, grouped, instances, junctions_of, spans

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, ctes: str = ""):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"{fx.DUCK}{', ' + ctes if ctes else ''} {sql}"
        return f

    return add


# aggregations --------------------------------------------------------------------------------------------


@query("select chrom_index1, strand0, count(*) n from fx_aln group by all")
def a1_counters(spark, sf):
    return reports.counter(fx.alignments(spark, sf), "chrom_index1", "strand0")


ENDS = """en as (select *, max(aln_i) over (partition by qname) la, mapq % 7 c5, div_pct % 5 c3 from fx_aln),
en2 as (select chrom_index1, case when mapq % 2 = 0 then greatest(p - o * 34, 1) else p end site_pos1 from (select *, case when strand0 = 0 then -1 else 1 end o, greatest(case when strand0 = 0 then pos1 - c5 else pos1 + ref_span + c5 end, 1) p from en where aln_i = 0 and mapq >= 44 and c5 <= 5)
  union all select chrom_index1, greatest(case when strand0 = 1 then pos1 - c3 else pos1 + ref_span + c3 end, 1) from en where aln_i = la and qname % 2 = 0 and mapq >= 44 and c3 <= 5)"""


@query("select chrom_index1, site_pos1::bigint site_pos1, count(*) n_observed from en2 group by all", ENDS)
def a2_endpoint_tally(spark, sf):
    a = fx.alignments(spark, sf).withColumns({"clip5": col("mapq") % 7, "clip3": col("div_pct") % 5, "trim5": col("mapq") % 2, "informative3": col("qname") % 2 == 0})
    return reads.endpoints(a, 44, 5, 34)


@query("""select qname, aln_i, chrom_index1, case when aln_i = 0 then pos1 // 10 * 10 - strand0 when strand0 = 1 then pos1 + ref_span - 1 else pos1 end ref_pos5, case when strand0 = 1 then pos1 else pos1 + ref_span - 1 end ref_pos3,
  case when aln_i = la then pos1 // 10 * 10 + 700 - (1 - strand0) when strand0 = 1 then pos1 else pos1 + ref_span - 1 end ref_proj3, strand0, la n_jxns from en""", ENDS)
def p32_alignment_segments(spark, sf):
    a = fx.alignments(spark, sf).withColumns({"site5_pos1": F.expr("pos1 div 10 * 10"), "proj3_pos1": F.expr("pos1 div 10 * 10 + 700")})
    return reads.alignment_segments(a, True)


@query("select chrom_index1, pos1, ref_span, strand0, count(*) n from fx_aln group by all")
def a3_segment_counts(spark, sf):
    return reports.counter(fx.alignments(spark, sf), "chrom_index1", "pos1", "ref_span", "strand0")


@query("select node1, node2, jxn_offset, count(*) n, string_agg(qname, ',' order by qname, aln_i) qnames from k group by all", J)
def a4_exact_grouping(spark, sf):
    return lookups.group_exact(junctions_of(spark, sf))


@query("""select sc::bigint sc, i1::bigint i1, i2::bigint i2, i3::bigint i3, count(*) n_instances, count(distinct qname) n_reads, max(min_mapq) max_min_mapq, bit_or(sample_bits) sample_bits,
  bit_count(bit_or(sample_bits))::bigint n_samples from g6 group by 1, 2, 3, 4""", G)
def a8_fuzzy_junctions(spark, sf):
    return junctions.roll_up(grouped(spark, sf))


DEDUP = """cd as (select i.*, case when orientation = best then 0 else 1 end::bigint is_duplicate from inst i join
  (select sc, i1, i2, i3, channel, arg_max(orientation, n * 2 - orientation) best from (select sc, i1, i2, i3, channel, orientation, count(*) n from inst group by all) group by all) using (sc, i1, i2, i3, channel))"""
KEYS = ["sc", "i1", "i2", "i3"]


def channel_dedup(spark, sf):
    return junctions.mark_channel_duplicates(instances(spark, sf), KEYS)


@query("""select sc, i1, i2, i3, count(*) n_instances, count(distinct qname) n_reads, sum(1 - is_duplicate)::bigint n_dedup, max(case when failure_flag & 120 <> 0 then 1 else 0 end)::bigint any_chimeric, bit_or(failure_flag) failure_flags,
  max(min_mapq) max_min_mapq, bit_or(sample_bits) sample_bits, bit_count(bit_or(sample_bits))::bigint n_samples, (min(orientation) <> max(orientation))::bigint is_bidirectional, (count(*) > count(distinct qname))::bigint has_multi_instance_read
  from cd group by all""", f"{G}, {INST}, {DEDUP}")
def a5_final_junctions(spark, sf):
    f = channel_dedup(spark, sf).withColumn("stem5", F.lit(1)).withColumn("divergence", F.lit(0.0))
    return junctions.final_junctions(f, KEYS).drop("min_stem", "min_divergence", "instances")


@query("""select sc, i1, i2, i3, arg_min(jxn_seq, {'t': t, 'n': -n, 's': jxn_seq}) best_seq from (select sc, i1, i2, i3, t, jxn_seq, count(*) n from
  (select *, case when length(jxn_seq) = 3 and is_duplicate = 0 then 0 when length(jxn_seq) = 3 then 1 else 2 end tier from cd), range(3) r(t) where t >= tier group by all) group by all""", f"{G}, {INST}, {DEDUP}")
def a6_best_sequence(spark, sf):
    return junctions.best_sequence(channel_dedup(spark, sf), KEYS, "best_length")


@query("select sc::bigint sc, i1::bigint i1, arg_max(node1, {'n': n, 'k': -node1}) node1, max(n) n from (select sc, i1, node1, count(*) n from g6 group by all) group by all", G)
def a7_representative(spark, sf):
    return lookups.representative(grouped(spark, sf), ["sc", "i1"])


@query()
def a9_merge_final(spark, sf):
    f = final(spark, sf).select("node1", "node2", "jxn_offset", "n_instances", "n_dedup", "sample_bits")
    parts = [f.where("n_instances % 2 = 0").withColumn("source", F.lit("a")), f.where("n_instances % 2 = 1").withColumn("source", F.lit("b"))]
    return fuzzy.merge_final(fuzzy.merge_sample_bits(parts, [5, 5]), fx.chroms(spark))


@query("select * from cov", COV)
def a10_coverage_runs(spark, sf):
    return intervals.coverage_runs(spans(spark, sf))


@query("select chrom_index1, start0, end1, least(coverage, 65535)::bigint coverage from cov", COV)
def s13_bedgraph(spark, sf):
    return records.bedgraph(intervals.coverage_runs(spans(spark, sf)))


@query("select cast(qname % 5 as bigint) sample_bit, count(*) n_alns, sum(n)::bigint n_alns_before, sum(ref_span)::bigint n_bases from (select chrom_index1, pos1, ref_span, strand0, qname % 5 qname, qname % 64 c, aln_i, count(*) n from fx_aln group by all) group by 1")
def a14_deduplicated_coverage(spark, sf):
    return reads.deduplicated_coverage(fx.alignments(spark, sf).withColumn("sample_bit", col("qname") % 5).withColumn("channel", col("qname") % 64))


HIST = "hist as (select strand0, ref_span // 50 * 50 size_bin, count(*) n_observed from fx_aln group by all)"


def hist(spark, sf):
    return inserts.histogram(fx.alignments(spark, sf), ["strand0"], col("ref_span"), 50)


@query("select * from hist", HIST)
def a15_histogram(spark, sf):
    return hist(spark, sf)


@query("select strand0, size_bin, n_observed, round(n_observed / sum(n_observed) over w, 9) molar, round(n_observed * size_bin / sum(n_observed * size_bin) over w, 9) mass from hist window w as (partition by strand0)", HIST)
def a16_frequencies(spark, sf):
    f = inserts.frequencies(hist(spark, sf), ["strand0"])
    return f.withColumn("molar", F.round("molar", 9)).withColumn("mass", F.round("mass", 9))


@query("""select chrom_index1, max(ref_span) nxx from (select *, sum(m) over (partition by chrom_index1 order by ref_span desc rows unbounded preceding) c, sum(m) over (partition by chrom_index1) a
  from (select chrom_index1, ref_span, count(*) * ref_span m from fx_aln group by chrom_index1, ref_span)) where c >= a * 0.5 group by 1""")
def a17_n50(spark, sf):
    return digest.nxx(fx.alignments(spark, sf), ["chrom_index1"], 0.5, "ref_span")


FRAG = "fr as (select chrom_index1, s - 1 start0, lead(s) over (partition by chrom_index1 order by s) - 1 end1 from (select distinct chrom_index1, site_pos1 s from fx_site)), frag as (select *, end1 - start0 size from fr where end1 is not null)"


def frags(spark, sf):
    return digest.fragments(fx.sites(spark, sf).distinct(), ["chrom_index1"])


@query("select * from frag", FRAG)
def w6_fragments(spark, sf):
    return frags(spark, sf)


@query("""select chrom_index1, count(*) n, sum(ref_span)::bigint bases, min(ref_span) least, max(ref_span) most, quantile_cont(ref_span, 0.25) q25, quantile_cont(ref_span, 0.5) q50, quantile_cont(ref_span, 0.75) q75,
  count(*) filter (ref_span >= 200 and ref_span < 400) n_200, sum(case when ref_span >= 200 and ref_span < 400 then ref_span else 0 end)::bigint bases_200,
  round(count(*) filter (ref_span >= 200 and ref_span < 400) / count(*), 9) molar_200, round(sum(case when ref_span >= 200 and ref_span < 400 then ref_span else 0 end) / sum(ref_span), 9) mass_200,
  round(1e9 / (sum(ref_span) / count(*) * 615.96), 6) fmol_per_ug from fx_aln group by 1""")
def a18_fragment_statistics(spark, sf):
    f = digest.fragment_statistics(fx.alignments(spark, sf).select("chrom_index1", col("ref_span").alias("size")), ["chrom_index1"], (200,))
    return f.withColumn("molar_200", F.round("molar_200", 9)).withColumn("mass_200", F.round("mass_200", 9)).withColumn("fmol_per_ug", F.round("fmol_per_ug", 6))


@query("select chrom_index1, strand0, sum(ref_span)::bigint bases, floor(sum(ref_span) / (select sum(ref_span) from fx_aln) * 10000) / 10000 fraction from fx_aln group by all")
def a19_genome_tally(spark, sf):
    return reports.tally_fractions(fx.alignments(spark, sf), ["chrom_index1", "strand0"], "ref_span")


@query("select e::int as \"end\", abs(case when e = 1 then node1 else node2 end) // 536870912 chrom, type_bits, count(*) n, sum(n_instances)::bigint n_instances from fin, (values (1), (2)) t(e) group by all", f"{G}, {INST}, {FINAL}")
def a20_breakpoint_tally(spark, sf):
    e = junctions.genomic_ends(final(spark, sf))
    return e.groupBy("end", codec.node_chrom(col("node")).alias("chrom"), "type_bits").agg(F.count("*").alias("n"), F.sum("n_instances").alias("n_instances"))


SEG = """b as (select chrom_index1, p, sum(d) d from (select chrom_index1, start0 p, 1 d from fx_region where kind = 1 union all select chrom_index1, end1, -1 from fx_region where kind = 1) group by all),
sg0 as (select chrom_index1, p start0, lead(p) over (partition by chrom_index1 order by p) end1, sum(d) over (partition by chrom_index1 order by p rows unbounded preceding)::bigint n from b), sg as (select * from sg0 where end1 is not null)"""


@query("select * from sg where n > 0", SEG)
def a23_elementary_segments(spark, sf):
    return intervals.elementary_segments(fx.regions(spark, sf).where("kind = 1"))


@query("select * from sg", SEG)
def a23_segments_with_gaps(spark, sf):
    return intervals.elementary_segments(fx.regions(spark, sf).where("kind = 1"), gaps=True)


def _grouped_score(how, sql, cast="double"):
    def f(spark, sf):
        g = fx.regions(spark, sf).where("kind = 1").withColumn("v", col("end1") - col("start0"))
        out = intervals.group_score(intervals.elementary_segments(g), g, "v", how)
        return out.withColumn("score", F.round(col("score").cast(cast), 6)) if cast == "double" else out.withColumn("score", col("score").cast(cast))

    name = f"a21_group_{how.lower()}"
    QUERIES[name] = f
    value = f"round(({sql})::double, 6)" if cast == "double" else f"({sql})::bigint"
    ORACLES[name] = f"{fx.DUCK}, {SEG} select s.chrom_index1, s.start0, s.end1, {value} score, string_agg(distinct name, ',' order by name) names from sg s join (select *, end1 - start0 v from fx_region where kind = 1) r on r.chrom_index1 = s.chrom_index1 and s.start0 >= r.start0 and s.end1 <= r.end1 group by all"


for _how, _sql, _cast in (("COUNT", "count(v)", "bigint"), ("SUM", "sum(v)", "bigint"), ("AVERAGE", "avg(v)", "double"), ("MEDIAN", "median(v)", "double"), ("MIN", "min(v)", "bigint"), ("MAX", "max(v)", "bigint"), ("BOOLEAN", "1", "bigint")):
    _grouped_score(_how, _sql, _cast)


ISL = """iw as (select *, case when start0 <= max(end1) over (partition by chrom_index1, kind order by start0, end1 rows between unbounded preceding and 1 preceding) then 0 else 1 end nw from fx_region),
il as (select *, sum(nw) over (partition by chrom_index1, kind order by start0, end1 rows unbounded preceding) k from iw)"""


@query("select chrom_index1, kind, min(start0) start0, max(end1) end1, count(*) n, string_agg(distinct name, '::' order by name) names from il group by chrom_index1, kind, k", ISL)
def a22_w12_collapse(spark, sf):
    return intervals.collapse(fx.regions(spark, sf), ["chrom_index1", "kind"])


@query("select mapq, count(*) filter (strand0 = 0) as \"0\", count(*) filter (strand0 = 1) as \"1\" from fx_aln group by 1")
def a24_pivot(spark, sf):
    return reports.pivot_counts(fx.alignments(spark, sf), "mapq", "strand0", [0, 1])


@query("select type_bits, jxn_offset, sv_size // 1000 * 1000 bin, count(*) n from fin group by all", f"{G}, {INST}, {FINAL}")
def a25_plot_counts(spark, sf):
    return reports.counter(final(spark, sf), "type_bits", "jxn_offset", codec.bin_floor(col("sv_size"), 1000).alias("bin"))


@query("select chrom, k, round((k + 1) * 0.5625 * pow(0.25, k) * n, 9) expected from (select abs(node1) // 536870912 chrom, count(*) n from fin group by 1), range(8) t(k)", f"{G}, {INST}, {FINAL}")
def a26_random_offsets(spark, sf):
    n = final(spark, sf).groupBy(codec.node_chrom(col("node1")).alias("chrom")).agg(F.count("*").alias("n"))
    out = n.select("chrom", F.posexplode(junctions.expected_offsets(col("n"))).alias("k", "e"))
    return out.select("chrom", big(col("k")).alias("k"), F.round("e", 9).alias("expected"))


OBS = core.OBS


@query("select chrom_index1, site_pos1, bool_or(i) in_silico, sum(n)::bigint n_observed, bool_or(i) or sum(n) >= 30 is_filtering from (select chrom_index1, site_pos1, false i, n_observed n from ob union all select chrom_index1, site_pos1, true, 0 from isl) group by all", OBS)
def a27_filtering_sites(spark, sf):
    m = core.observed(spark, sf).withColumn("in_silico", F.lit(False)).unionByName(fx.sites(spark, sf).distinct().withColumn("in_silico", F.lit(True)).withColumn("n_observed", F.lit(0).cast("bigint")))
    return sites.filtering_sites(m, 30)


@query("select chrom_index1, count(*) n, round(avg(ref_span), 6) mean, round(stddev_samp(ref_span), 6) sd, median(ref_span) median, min(ref_span) least, max(ref_span) most from fx_aln group by 1")
def a28_describe(spark, sf):
    d = reports.describe(fx.alignments(spark, sf), ["chrom_index1"], "ref_span")
    return d.withColumn("mean", F.round("mean", 6)).withColumn("sd", F.round("sd", 6))


@query("select chrom_index1, arg_max(bin, n * 100000 - bin) as \"mode\" from (select chrom_index1, ref_span // 100 * 100 bin, count(*) n from fx_aln group by all) group by 1")
def a28_density_mode(spark, sf):
    return reports.histogram_mode(fx.alignments(spark, sf), ["chrom_index1"], col("ref_span"), 100)


@query("select qname, aln_i from (select *, quantile_cont(ref_span, 0.05) over w lo, quantile_cont(ref_span, 0.95) over w hi from fx_aln window w as (partition by chrom_index1)) where ref_span >= lo and ref_span <= hi")
def a28_trimmed(spark, sf):
    return reports.trim_outliers(fx.alignments(spark, sf), ["chrom_index1"], "ref_span").select("qname", "aln_i")


@query(f"select c, count(*) n_alns, sum(ref_span)::bigint n_bases, round(sum(ref_span) / count(*), 6) per_aln from (select *, {core.ENDS.format('mapq')} c from fx_aln) group by 1")
def a29_target_summary(spark, sf):
    a = fx.alignments(spark, sf).withColumn("c", F.expr(core.ENDS.format("mapq")))
    return a.groupBy("c").agg(F.count("*").alias("n_alns"), F.sum("ref_span").alias("n_bases"), F.round(F.sum("ref_span") / F.count("*"), 6).alias("per_aln"))


@query("""select kind, count(distinct q) n, round(100 * count(distinct q) / sum(count(distinct q)) over (), 2) percent from
  (select qname q, case when mapq = 60 then 'merged' when count(*) over (partition by qname) > 1 then 'paired' else 'orphan' end kind from fx_aln) group by 1""")
def a30_merge_summary(spark, sf):
    return reports.merge_summary(fx.alignments(spark, sf).withColumn("fm", F.when(col("mapq") == 60, "1,2")))


@query("select offset_type, coverage_type, count(*) n, count(*) filter (n_dedup = 1) n_singleton, count(*) filter (n_dedup >= 3) n_validated from cls group by all", f"{G}, {INST}, {FINAL}, {CLASSES}")
def a31_final_reports(spark, sf):
    return reports.final_reports(junctions.add_classes(final(spark, sf)))


@query("""select (a.b + c.b) // 100 * 100 size_bin, round(sum(a.p * c.p), 9) p from (select size_bin b, n_observed / sum(n_observed) over () p from hist where strand0 = 0) a,
  (select size_bin b, n_observed / sum(n_observed) over () p from hist where strand0 = 0) c group by 1""", HIST)
def a33_artifact_model(spark, sf):
    return inserts.artifact_model(hist(spark, sf).where("strand0 = 0"), 100).withColumn("p", F.round("p", 9))


# windows -------------------------------------------------------------------------------------------------


@query("select qname, pos1, ref_span, row_number() over (partition by qname order by pos1, ref_span, mapq, strand0, chrom_index1, div_pct, jxn_offset) - 1 aln_i from (select * exclude (aln_i) from fx_aln)")
def w1_alignment_order(spark, sf):
    a = fx.alignments(spark, sf).drop("aln_i")
    return reads.order_alignments(a, "pos1", ("ref_span", "mapq", "strand0", "chrom_index1", "div_pct", "jxn_offset")).select("qname", "pos1", "ref_span", "aln_i")


@query("select qname, aln_i, node1, node2, jxn_offset, min_mapq, was_flipped from k", J)
def w2_adjacent_junctions(spark, sf):
    return junctions_of(spark, sf).drop("sample_bits")


@query("select cast(chrom_index1 as bigint) c, min(pos1) lo, max(pos1) hi, count(*) n from (select *, sum(nw) over (partition by chrom_index1 order by pos1, qname, aln_i rows unbounded preceding) g from (select *, case when pos1 - lag(pos1) over (partition by chrom_index1 order by pos1, qname, aln_i) <= 20 then 0 else 1 end nw from fx_aln)) group by chrom_index1, g")
def w3_gap_groups(spark, sf):
    g = fuzzy.gap_groups(fx.alignments(spark, sf), ["chrom_index1"], col("pos1"), 20, "g")
    return g.groupBy(col("chrom_index1").alias("c"), "g").agg(F.min("pos1").alias("lo"), F.max("pos1").alias("hi"), F.count("*").alias("n")).drop("g")


@query("select qname, r::bigint run, min(strand0) strand0, count(*) n from (select *, sum(nw) over (partition by qname order by aln_i rows unbounded preceding) r from (select *, case when strand0 = lag(strand0) over (partition by qname order by aln_i) then 0 else 1 end nw from fx_aln)) group by qname, r")
def w4_run_lengths(spark, sf):
    r = fuzzy.run_ids(fx.alignments(spark, sf), ["qname"], ["aln_i"], "strand0")
    return r.groupBy("qname", "run").agg(F.min("strand0").alias("strand0"), F.count("*").alias("n"))


@query("select chrom_index1, chrom_size, coalesce(sum(chrom_size) over (order by chrom_index1 rows between unbounded preceding and 1 preceding), 0)::bigint as \"offset\" from fx_chrom")
def w5_prefix_sums(spark, sf):
    return reports.cumulative_offsets(fx.chroms(spark))


@query("select qname, count(*) n_alns, arg_min(chrom_index1, aln_i) chrom_index1_first, arg_min(pos1, aln_i) pos1_first, arg_min(strand0, aln_i) strand0_first, arg_max(chrom_index1, aln_i) chrom_index1_last, arg_max(pos1, aln_i) pos1_last, arg_max(strand0, aln_i) strand0_last from fx_aln group by 1")
def w8_first_and_last(spark, sf):
    return reads.first_and_last(fx.alignments(spark, sf))


@query("select qname, aln_i, 1 + sum(case when aln_i > 0 and mapq >= 50 then 1 else 0 end) over (partition by qname order by aln_i rows unbounded preceding)::bigint block from fx_aln")
def w9_block_numbers(spark, sf):
    return reads.block_numbers(fx.alignments(spark, sf).withColumn("passes", F.when(col("aln_i") > 0, col("mapq") >= 50)), "passes").select("qname", "aln_i", "block")


W14 = """(select qname, case when abs(n5) > abs(n3) then -n3 else n5 end outer1, case when abs(n5) > abs(n3) then -n5 else n3 end outer2, (abs(n5) > abs(n3))::bigint was_flipped
  from (select qname, arg_min(node, aln_i) n5, case when qname % 2 = 0 then -arg_max(node, aln_i) else arg_max(node, aln_i) end n3 from (select *, {N} node from fx_aln) group by 1))"""


@query("select * from " + W14.replace("{N}", core.NODE))
def w14_outer_nodes(spark, sf):
    n = codec.pack_node(col("chrom_index1"), col("pos1"), col("strand0"))
    r = fx.alignments(spark, sf).withColumn("n", n).groupBy("qname").agg(F.min_by("n", "aln_i").alias("node5"), F.max_by("n", "aln_i").alias("node3"))
    return inserts.outer_nodes(r.withColumn("paired_node", F.when(col("qname") % 2 == 0, col("node3")))).select("qname", "outer1", "outer2", "was_flipped")


@query("select qname, aln_i, coalesce(lag(t) over w, 0) | coalesce(t, 0) jxn_types from (select *, case when c2 is null then null when chrom_index1 <> c2 then 8 when strand0 <> s2 then 4 when p2 > pos1 then 1 else 2 end::bigint t from p) window w as (partition by qname order by aln_i)", PAIRS)
def w16_flank_types(spark, sf):
    w = Window.partitionBy("qname").orderBy("aln_i")
    a = fx.alignments(spark, sf)
    for c in ("chrom_index1", "pos1", "strand0"):
        a = a.withColumn(f"n_{c}", F.lead(c).over(w))
    t = F.when(col("n_chrom_index1").isNull(), None).when(col("chrom_index1") != col("n_chrom_index1"), 8).when(col("strand0") != col("n_strand0"), 4).when(col("n_pos1") > col("pos1"), 1).otherwise(2)
    return reads.flank_types(a.withColumn("jxn_type", big(t))).select("qname", "aln_i", big(col("jxn_types")).alias("jxn_types"))


# sorts, limits, sets -------------------------------------------------------------------------------------


@query("select row_number() over (order by node1, node2, qname, aln_i)::bigint r, node1, node2 from k", J)
def t1_s14_sorted_export(spark, sf):
    # the rank only shows the order to a comparison that ignores it: partition counts are added to ranks within partitions
    j = junctions_of(spark, sf).select("node1", "node2", "qname", "aln_i")
    from ..operators.ranking import rank_rows

    return rank_rows(j, ["node1", "node2", "qname", "aln_i"]).select(col("r"), "node1", "node2")


@query("select qname, aln_i, chrom_index1 from fx_aln qualify row_number() over (partition by chrom_index1 order by qname, aln_i) <= 100")
def t2_s20_first_rows(spark, sf):
    return reports.first_rows(fx.alignments(spark, sf), ["chrom_index1"], ["qname", "aln_i"], 100).select("qname", "aln_i", "chrom_index1")


@query("select qname from (select distinct qname from fx_aln) order by md5(cast(qname as varchar)), qname limit 200")
def t3_down_sample(spark, sf):
    return reports.down_sample(fx.alignments(spark, sf).select("qname").distinct(), "qname", 200)


@query("select row_number() over (order by nxx desc, mapq) rank, mapq, nxx from (select mapq, max(ref_span) nxx from (select *, sum(m) over (partition by mapq order by ref_span desc rows unbounded preceding) c, sum(m) over (partition by mapq) a from (select mapq, ref_span, count(*) * ref_span m from fx_aln group by mapq, ref_span)) where c >= a * 0.5 group by 1)")
def t4_order_by_n50(spark, sf):
    n = digest.nxx(fx.alignments(spark, sf), ["mapq"], 0.5, "ref_span")
    return lookups.ranked(n, "nxx", "mapq")


@query("select qname, arg_max(pos1, mapq * 100 - aln_i) best, arg_min(pos1, mapq * 100 + aln_i) worst from fx_aln group by 1")
def t6_arg_max(spark, sf):
    return lookups.best_and_worst(fx.alignments(spark, sf), "qname", "pos1", "mapq", "aln_i")


@query("select chrom_index1, pos1 p from fx_aln union select chrom_index1, site_pos1 from fx_site")
def u_distinct_positions(spark, sf):
    return fx.alignments(spark, sf).select("chrom_index1", col("pos1").alias("p")).union(fx.sites(spark, sf)).distinct()


@query("select src, count(*) n from (select 'a' src from fx_aln union all select 's' from fx_site union all select 'r' from fx_region) group by 1")
def u_all_tables(spark, sf):
    one = lambda f, s: f(spark, sf).select(F.lit(s).alias("src"))
    return reports.counter(one(fx.alignments, "a").unionByName(one(fx.sites, "s")).unionByName(one(fx.regions, "r")), "src")


@query("select chrom_index1, pos1 // 10 p from fx_aln intersect select chrom_index1, site_pos1 // 10 from fx_site")
def i_intersection(spark, sf):
    return fx.alignments(spark, sf).select("chrom_index1", F.expr("pos1 div 10").alias("p")).intersect(fx.sites(spark, sf).selectExpr("chrom_index1", "site_pos1 div 10 as p"))


@query("select g, chrom_index1 || '_' || g chrom, count(*) n from fx_aln, (values ('hs1'), ('mm39')) t(g) where g = 'hs1' or strand0 = 1 group by all")
def c_composite_genome(spark, sf):
    a = fx.alignments(spark, sf).withColumn("chrom", col("chrom_index1"))
    both = reports.composite({"hs1": a, "mm39": a.where("strand0 = 1")}).withColumn("g", codec.genome_of(col("chrom")))
    return reports.counter(both, "g", "chrom")


@query("""select chrom_index1, coalesce(b, 0) start0, start0 end1 from (select chrom_index1, start0, max(end1) over (partition by chrom_index1 order by start0, end1 rows between unbounded preceding and 1 preceding) b
  from (select chrom_index1, start0, end1 from fx_region where kind = 1 union all select chrom_index1, chrom_size, chrom_size from fx_chrom)) where coalesce(b, 0) < start0""")
def e_complement(spark, sf):
    return intervals.complement(fx.regions(spark, sf).where("kind = 1"), fx.chroms(spark))


@query("select qname, case when strand0 = 1 then (1::bigint << (qname % 5)::int) << 5 else 1::bigint << (qname % 5)::int end sample_bits from fx_aln")
def m_shifted_samples(spark, sf):
    a = fx.alignments(spark, sf).withColumn("sample_bits", F.expr("shiftleft(1L, cast(qname % 5 as int))")).select("qname", "strand0", "sample_bits")
    return fuzzy.merge_sample_bits([a.where("strand0 = 0"), a.where("strand0 = 1")], [5, 5]).select("qname", "sample_bits")


@query("select 1::bigint << (i - 1)::int sample_bit, 's' || i sample_name from range(1, 6) t(i)")
def s16_s18_sample_table(spark, sf):
    return inputs.sample_table(spark, [f"/data/s{i}.bam" for i in range(1, 6)])


@query("select 'chr' || case when i = 4 then 'X' when i = 5 then 'M' else i::varchar end chrom, i * 1000 chrom_size, i chrom_index1 from range(1, 6) t(i)")
def s9_chrom_order(spark, sf):
    rows = [("chrM", 5000), ("chr2", 2000), ("chrX", 4000), ("chr1", 1000), ("chr3", 3000), ("chrUn_1", 9)]
    df = spark.createDataFrame([(c, n, i) for i, (c, n) in enumerate(rows)], "chrom string, chrom_size bigint, _at bigint")
    return records.order_chroms(df)


@query("select qname, aln_i, pos1 from fx_aln where chrom_index1 = 2 and pos1 between 3000 and 5000")
def s12_range_retrieval(spark, sf):
    return fx.alignments(spark, sf).where((col("chrom_index1") == 2) & col("pos1").between(3000, 5000)).select("qname", "aln_i", "pos1")


# user-defined logic --------------------------------------------------------------------------------------


@query("select sc, i1, i2, i3, qname, aln_i, is_duplicate from cd", f"{G}, {INST}, {DEDUP}")
def u6_channel_duplicates(spark, sf):
    return channel_dedup(spark, sf).select(*KEYS, "qname", "aln_i", "is_duplicate")


@query("""select sc, i1, i2, i3, qname, aln_i, case when qname = first(qname) over (partition by sc, i1, i2, i3, outer1, outer2 order by case when length(jxn_seq) = 3 then 0 else 1 end, qname, aln_i) then 0 else 1 end::bigint is_duplicate from inst""", f"{G}, {INST}")
def u7_span_duplicates(spark, sf):
    return junctions.mark_span_duplicates(instances(spark, sf), KEYS, "best_length").select(*KEYS, "qname", "aln_i", "is_duplicate")


@query("select qname, string_agg(chrom_index1, ',' order by aln_i) chroms, string_agg(pos1, ',' order by aln_i) pos1s from fx_aln group by 1")
def u9_read_paths(spark, sf):
    p = reads.read_paths(fx.alignments(spark, sf))
    return p.select("qname", F.array_join(col("chrom_index1s").cast("array<string>"), ",").alias("chroms"), F.array_join(col("pos1s").cast("array<string>"), ",").alias("pos1s"))


@query()
def u3_w11_match_endpoints(spark, sf):
    return sites.match_endpoints(core.observed(spark, sf), fx.sites(spark, sf).distinct(), 12)


@query("select doc_id, 'GTAC' enzyme, i + 2 site_pos1 from fx_seq, unnest(range(1, length(seq) - 2)) t(i) where substr(seq, i, 4) = 'GTAC'")
def u8_f10_digest(spark, sf):
    return digest.digest(digest.chunks(fx.sequences(spark, sf), "doc_id", 500, 16), "doc_id", [("GTAC", "GTAC", 2)], 500)


def tagged(spark, sf):
    """Alignments with made-up cs and dd tags: a match, a change that depends on the row, a match."""
    change = "case qname % 4 when 0 then '*ag' when 1 then '+tt' when 2 then '-acg' else '*ct+a' end"
    a = fx.alignments(spark, sf).withColumn("cs", F.expr(f"concat(':', 5 + aln_i % 3, {change}, ':', 7)")).withColumn("dd", F.expr("if(qname % 3 = 0, concat('=', 4, '?AC', '=', 3), cast(null as string))"))
    return a.select("chrom_index1", (col("pos1") - 1).alias("pos0"), F.lit(0).alias("qry_start0"), "strand0", "cs", "dd", F.expr("array_repeat(30, 24)").alias("qual"), F.expr("shiftleft(1L, cast(qname % 5 as int))").alias("sample_bit"), col("mapq").alias("n_passes"))


@query()
def u2_a11_a12_pileup(spark, sf):
    return snv.pileup(snv.events(tagged(spark, sf), 20))


@query()
def u2_a13_variants(spark, sf):
    e = snv.events(tagged(spark, sf), 20)
    return snv.variants(e, snv.pileup(e))


@query("select qname, aln_i from fx_aln where mapq >= 50 and qname % 3 = 0 and div_pct >= 3")
def p18_p19_snv_filters(spark, sf):
    a = fx.alignments(spark, sf).withColumns({"cs": F.lit(":5"), "qual": F.expr("array(30, 31)"), "dd": F.expr("if(qname % 3 = 0, '=2', null)"), "ec": col("div_pct") + 0.5})
    return snv.error_corrected(snv.usable_for_snvs(a, "PacBioStrand"), 3).select("qname", "aln_i")


@query()
def u1_p8_adapter_insertions(spark, sf):
    pieces = F.posexplode(F.regexp_extract_all("seq", F.lit("[ACGT]{24}"), F.lit(0))).alias("piece", "ins")
    s = fx.sequences(spark, sf).select("doc_id", pieces)
    return align.has_adapter(s, "ins", "ACGTACGTTGCA", 10, 40, 7.0).select("doc_id", "piece", "has_adapter")


@query()
def u5_adapter_trim(spark, sf):
    s = fx.sequences(spark, sf).where("length(seq) >= 100").select(col("doc_id").cast("string").alias("qname"), F.concat(F.lit("TTAACCTGTACTTCGTTCAGTTACGTATTGCT"), "seq").alias("seq"))
    return align.trim_adapters(s.withColumn("qual", F.expr("repeat('I', length(seq))")), "CCTGTACTTCGTTCAGTTACGTATTGCT").select("qname", "trim5", "trim3", "how5")


@query()
def u4_duplex_merge(spark, sf):
    s = fx.sequences(spark, sf).where("length(seq) >= 60").select("doc_id", "seq").withColumn("qual", F.expr("array_repeat(30, length(seq))"))
    fwd = s.selectExpr("'m' as movie", "doc_id as zmw", "0 as strand", "true as usable", "seq", "qual")
    rev = s.select(F.lit("m").alias("movie"), col("doc_id").alias("zmw"), F.lit(1).alias("strand"), F.lit(True).alias("usable"), codec.reverse_complement(F.expr("overlay(seq placing 'T' from 20 for 1)")).alias("seq"), "qual")
    return duplex.merge_pairs(duplex.pair_strands(fwd.unionByName(rev))).select("zmw", "seq", "dd")


@query("select substr(seq, i, 3) base_context, count(*) n from fx_seq, unnest(range(1, length(seq) - 1)) t(i) group by 1")
def u10_kinetics_contexts(spark, sf):
    s = fx.sequences(spark, sf).select(col("doc_id").alias("qname"), "seq").withColumn("ip", F.expr("array_repeat(1, length(seq))")).withColumn("pw", col("ip"))
    return reports.counter(duplex.kinetics_contexts(s), "base_context")
