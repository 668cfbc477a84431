"""Registered queries of the engine's own operators over the fixture views, each with its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec, flags
from ..operators import asof, digest, fuzzy, inserts, intervals, junctions, lookups, reads, reports, sites
from ..sources import records
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
col = F.col


def query(sql: str | None = None, ctes: str = ""):
    """Register a query under its function's name; ``sql`` follows the fixture CTEs (and ``ctes``)."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"{fx.DUCK}{', ' + ctes if ctes else ''} {sql}"
        return f

    return add


def big(c: Column | bool) -> Column:
    return c.cast("bigint")


# shared fixtures -----------------------------------------------------------------------------------------

NODE = "(chrom_index1 * 536870912 + pos1) * (case when strand0 = 1 then -1 else 1 end)"
CHR = "(abs({0}) // 536870912)"
J = f"""o as (select *, {NODE} node from fx_aln),
j as (select qname, aln_i, node a, lead(node) over w b, jxn_offset, least(mapq, lead(mapq) over w) min_mapq, cast((1::bigint << (qname % 5)::int) as bigint) sample_bits from o window w as (partition by qname order by aln_i)),
k as (select qname, aln_i, least(a, b) node1, greatest(a, b) node2, jxn_offset, min_mapq, sample_bits, case when a > b then 1 else 0 end::bigint was_flipped from j where b is not null)"""
G = J + """,
g as (select *, sign(node1) * (abs(node1) // 536870912) sc, case when abs(abs(node1) - abs(lag(node1) over (partition by sign(node1), abs(node1) // 536870912 order by node1, node2, qname, aln_i))) <= 20 then 0 else 1 end b1 from k),
g1 as (select *, sum(b1) over (partition by sc order by node1, node2, qname, aln_i rows unbounded preceding) i1 from g),
g2 as (select *, case when abs(abs(node2) - abs(lag(node2) over (partition by sc, i1 order by node2, node1, qname, aln_i))) <= 20 then 0 else 1 end b2 from g1),
g3 as (select *, sum(b2) over (partition by sc, i1 order by node2, node1, qname, aln_i rows unbounded preceding) i2 from g2),
g4 as (select *, (case when node1 < 0 then (30000 + (abs(node1) // 536870912) * 1000) - (abs(node1) % 536870912) + 1 else abs(node1) % 536870912 end)
  + (case when node2 < 0 then abs(node2) % 536870912 else (30000 + (abs(node2) // 536870912) * 1000) - (abs(node2) % 536870912) + 1 end) + jxn_offset vcl from g3),
g5 as (select *, case when vcl - lag(vcl) over (partition by sc, i1, i2 order by vcl, node1, node2, qname, aln_i) <= 5 then 0 else 1 end b3 from g4),
g6 as (select *, sum(b3) over (partition by sc, i1, i2 order by vcl, node1, node2, qname, aln_i rows unbounded preceding) i3 from g5)"""


def junctions_of(spark: SparkSession, sf: str) -> DataFrame:
    return reads.ordered_junctions(fx.alignments(spark, sf)).withColumn("sample_bits", F.expr("shiftleft(1L, cast(qname % 5 as int))"))


def grouped(spark: SparkSession, sf: str) -> DataFrame:
    return fuzzy.fuzzy_junctions(junctions_of(spark, sf), fx.chroms(spark)).withColumns({c: big(col(c)) for c in ("i1", "i2", "i3")})


INST = """inst as (select cast(sc as bigint) sc, cast(i1 as bigint) i1, cast(i2 as bigint) i2, cast(i3 as bigint) i3, qname, aln_i, was_flipped orientation, cast(qname % 64 as bigint) channel,
  cast(qname % 7 as bigint) outer1, cast(qname % 11 as bigint) outer2, repeat('ACGT'[1 + cast(qname % 4 as int)], cast(abs(jxn_offset) as int)) jxn_seq, cast(3 as bigint) best_length,
  cast(case when min_mapq < 50 then 8 when jxn_offset > 3 then 64 when jxn_offset < -3 then 4 else 0 end as bigint) failure_flag, min_mapq, sample_bits, node1, node2, jxn_offset from g6)"""


def instances(spark: SparkSession, sf: str) -> DataFrame:
    return grouped(spark, sf).selectExpr(
        "sc", "i1", "i2", "i3", "qname", "aln_i", "was_flipped as orientation", "qname % 64 as channel", "qname % 7 as outer1", "qname % 11 as outer2",
        "repeat(substring('ACGT', int(1 + qname % 4), 1), int(abs(jxn_offset))) as jxn_seq", "3L as best_length",
        "cast(case when min_mapq < 50 then 8 when jxn_offset > 3 then 64 when jxn_offset < -3 then 4 else 0 end as bigint) as failure_flag", "min_mapq", "sample_bits", "node1", "node2", "jxn_offset",
    )


# functions -----------------------------------------------------------------------------------------------


@query(f"select qname, aln_i, node, abs(node) // 536870912 chrom, abs(node) % 536870912 pos, case when node < 0 then 1 else 0 end::bigint strand, -node flipped from (select *, {NODE} node from fx_aln)")
def f1_signed_nodes(spark, sf):
    a = fx.alignments(spark, sf).withColumn("node", codec.pack_node(col("chrom_index1"), col("pos1"), col("strand0")))
    n = col("node")
    return a.select("qname", "aln_i", "node", codec.node_chrom(n).alias("chrom"), codec.node_pos(n).alias("pos"), codec.node_strand(n).alias("strand"), codec.flip_node(n).alias("flipped"))


CIGAR = "concat(cast(pos1 % 7 as varchar), 'S', cast(ref_span as varchar), 'M', cast(mapq % 5 + 1 as varchar), 'I', cast(div_pct + 1 as varchar), 'D9M', cast(pos1 % 3 as varchar), 'H')"


@query(f"""select qname, aln_i, cigar, pos1 % 7 left_clip, pos1 % 3 right_clip, ref_span + div_pct + 10 span, ref_span + mapq % 5 + 10 aligned,
  case when strand0 = 1 then pos1 % 3 else pos1 % 7 end start0, case when strand0 = 1 then pos1 % 3 else pos1 % 7 end + ref_span + mapq % 5 + 10 end1,
  concat(pos1 % 3, 'H9M', div_pct + 1, 'D', mapq % 5 + 1, 'I', ref_span, 'M', pos1 % 7, 'S') reversed from (select *, {CIGAR} cigar from fx_aln)""")
def f2_cigar(spark, sf):
    a = fx.alignments(spark, sf).withColumn("cigar", F.expr(CIGAR.replace("varchar", "string")))
    c, s = col("cigar"), col("strand0")
    return a.select(
        "qname", "aln_i", "cigar", codec.left_clip(c).alias("left_clip"), codec.right_clip(c).alias("right_clip"), codec.ref_span(c).alias("span"), codec.aligned_size(c).alias("aligned"),
        codec.query_start0(c, s).alias("start0"), codec.query_end1(c, s).alias("end1"), codec.reverse_cigar(c).alias("reversed"),
    )


@query("select doc_id, reverse(translate(seq, 'ACGT', 'TGCA')) rc from fx_seq")
def f4_reverse_complement(spark, sf):
    return fx.sequences(spark, sf).select("doc_id", codec.reverse_complement(col("seq")).alias("rc"))


QUAL = "q as (select doc_id, list_transform(string_split(seq, ''), lambda c: ascii(c) - 33) q from fx_seq where seq <> '')"


@query("select doc_id, floor(list_sum(q) * 1000 / len(q)) / 1000 mean, list_sort(q)[len(q) // 2 + 1]::bigint median from q", QUAL)
def f5_f6_quality(spark, sf):
    q = fx.sequences(spark, sf).where("seq <> ''").select("doc_id", codec.phred(col("seq")).alias("q"))
    return q.select("doc_id", (F.floor(codec.mean_quality(col("q")) * 1000) / 1000).alias("mean"), big(codec.median_quality(col("q"))).alias("median"))


@query("select doc_id, list_transform(q, lambda x: case when x >= 40 then 40 when x >= 34 then 34 else 20 end)::varchar[] levels from q", QUAL)
def f7_quantized_quality(spark, sf):
    q = fx.sequences(spark, sf).where("seq <> ''").select("doc_id", codec.phred(col("seq")).alias("q"))
    return q.select("doc_id", codec.quantize_quality(col("q"), [20, 34, 40]).cast("array<string>").alias("levels"))


@query("select qname, aln_i, case when b < 64 then b when b < 128 then 64 + (b - 64) * 2 when b < 192 then 192 + (b - 128) * 4 else 448 + (b - 192) * 8 end frames from (select *, pos1 % 256 b from fx_aln)")
def f8_codec_v1(spark, sf):
    return fx.alignments(spark, sf).select("qname", "aln_i", codec.codec_v1(col("pos1") % 256).alias("frames"))


@query("select doc_id, len(regexp_extract_all(seq, 'C[CT][AG]G'))::bigint n from fx_seq")
def f9_iupac_sites(spark, sf):
    return fx.sequences(spark, sf).select("doc_id", digest.site_count(col("seq"), codec.iupac_class("CYRG")).alias("n"))


@query("select doc_id, len(regexp_extract_all(seq, 'GTAC'))::bigint n from fx_seq")
def f10_site_counts(spark, sf):
    return fx.sequences(spark, sf).select("doc_id", digest.site_count(col("seq"), "GTAC").alias("n"))


@query("select qname, aln_i, case when mapq % 4 = 0 then 0 else 6 - 2 * (div_pct % 4) end::bigint c5, trunc(ref_span * 5 / (1 + div_pct / 100.0::double))::bigint lo, trunc(ref_span * 5 / (1 + div_pct / 100.0::double))::bigint * 2 hi from fx_aln")
def f11_f17_sizes(spark, sf):
    lo, hi = codec.allowed_sizes(col("ref_span") * 5, col("div_pct") / 100)
    c5 = codec.correction5(F.lit(6), col("div_pct") % 4, col("mapq") % 4 == 0)
    return fx.alignments(spark, sf).select("qname", "aln_i", big(c5).alias("c5"), big(lo).alias("lo"), big(hi).alias("hi"))


@query("select qname, ',' || string_agg(mapq, ',' order by aln_i) || ',' flanked, string_agg(mapq, ',' order by aln_i) || ',' terminated, count(*) n, sum(mapq)::bigint total from fx_aln group by qname")
def f12_list_codecs(spark, sf):
    m = reads.read_paths(fx.alignments(spark, sf)).select("qname", codec.to_flanked(col("mapqs")).alias("flanked"), codec.to_terminated(col("mapqs")).alias("terminated"))
    back = codec.from_list_string(col("flanked"), "bigint")
    return m.select("*", big(F.size(codec.from_list_string(col("terminated")))).alias("n"), F.aggregate(back, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("select aln_i, trunc((pos1 - 9000) / 250.0)::bigint * 250 bin, count(*) n from fx_aln group by all")
def f13_bins(spark, sf):
    return fx.alignments(spark, sf).groupBy("aln_i", codec.bin_floor(col("pos1") - 9000, 250).alias("bin")).agg(F.count("*").alias("n"))


@query("select qname, 'm' || qname % 3 movie, qname zmw, case when aln_i % 2 = 0 then 'fwd' else 'rev' end strand, aln_i channel, mapq trim5, div_pct trim3 from fx_aln")
def f14_read_names(spark, sf):
    a = fx.alignments(spark, sf).withColumn("ccs", F.expr("concat('m', qname % 3, '/', qname, '/ccs/', if(aln_i % 2 = 0, 'fwd', 'rev'))")).withColumn("old", F.concat_ws(":", F.lit("r"), "aln_i", "mapq", "div_pct"))
    n, o = codec.parse_ccs_name(col("ccs")), codec.parse_legacy_name(col("old"))
    return a.select("qname", n["movie"].alias("movie"), n["zmw"].alias("zmw"), n["strand"].alias("strand"), o["channel"].alias("channel"), o["trim5"].alias("trim5"), o["trim3"].alias("trim3"))


@query("select qname, aln_i, 'x fm:Z:' || mapq || ',' || div_pct tag from fx_aln")
def f15_merge_tags(spark, sf):
    return fx.alignments(spark, sf).select("qname", "aln_i", codec.merge_tag(F.concat(F.lit("x merged_"), "mapq", F.lit("_"), "div_pct")).alias("tag"))


@query("select case when strand0 = 1 then 'mm39' else 'hs1' end genome, count(*) n from fx_aln group by 1")
def f16_genome_suffix(spark, sf):
    chrom = F.concat(F.lit("chr"), "chrom_index1", F.lit("_"), F.when(col("strand0") == 1, "mm39").otherwise("hs1"))
    return reports.counter(fx.alignments(spark, sf).withColumn("genome", codec.genome_of(chrom)), "genome")


@query("select qname, bit_count(m)::bigint n, (m & 5) m5 from (select qname, bit_or(1::bigint << (mapq % 32)::int) m from fx_aln group by qname)")
def f18_bits(spark, sf):
    m = fx.alignments(spark, sf).groupBy("qname").agg(F.bit_or(F.expr("shiftleft(1L, cast(mapq % 32 as int))")).alias("m"))
    return m.select("qname", big(F.bit_count("m")).alias("n"), col("m").bitwiseAND(F.lit(5).cast("bigint")).alias("m5"))


@query("select qname, aln_i, case 1 << (pos1 % 4)::int when 1 then 'deletion' when 2 then 'duplication' when 4 then 'inversion' else case when strand0 = 1 then 'intergenome' else 'translocation' end end t from fx_aln")
def f19_junction_types(spark, sf):
    bits = F.expr("shiftleft(1, cast(pos1 % 4 as int))")
    return fx.alignments(spark, sf).select("qname", "aln_i", codec.junction_type(bits, col("strand0") == 1).alias("t"))


@query("select qname, aln_i, vcl::bigint vcl from g4", G)
def f20_variant_chrom_length(spark, sf):
    return grouped(spark, sf).select("qname", "aln_i", "vcl")


@query("select distinct case when kind = 0 then 'hs1' when kind = 1 then 'mm39' else 'other' end g from fx_region")
def f21_genome_names(spark, sf):
    name = F.expr("case kind when 0 then 'CHM13' when 1 then 'GRCm39' else 'other' end")
    return fx.regions(spark, sf).select(codec.genome_name(name).alias("g")).distinct()


@query("select doc_id, substr(seq, greatest(doc_id % 100 - 10, 0)::int + 1, (least(doc_id % 100, 10) + 3 + 10)::int) s from fx_seq")
def f23_junction_sequence(spark, sf):
    return fx.sequences(spark, sf).select("doc_id", codec.junction_sequence(col("seq"), col("doc_id") % 100, F.lit(-3), 10).alias("s"))


# predicates ----------------------------------------------------------------------------------------------


@query("select case when mapq < 44 then 'unmapped' when chrom_index1 = 5 then 'noncanonical' when div_pct > 6 then 'off_target' else 'usable' end outcome, count(*) n from fx_aln where aln_i = 0 group by 1")
def p1_read_outcome(spark, sf):
    o = flags.read_outcome(col("mapq") < 44, col("chrom_index1") == 5, col("div_pct") > 6)
    return reports.counter(fx.alignments(spark, sf).where("aln_i = 0").withColumn("outcome", o), "outcome")


@query("""select qname, aln_i, case when mapq < 50 then 1 when div_pct > 5 then 2 when n > 1 and ref_span < 100 then 4 when n > 1 and jxn_offset + 30 < 28 then 8 else 0 end::bigint flag
  from (select *, count(*) over (partition by qname) n from fx_aln)""")
def p2_alignment_failure(spark, sf):
    from pyspark.sql import Window

    a = fx.alignments(spark, sf).withColumn("n", F.count("*").over(Window.partitionBy("qname")))
    f = flags.alignment_failure(col("mapq"), col("div_pct"), col("n") > 1, col("ref_span"), col("jxn_offset") + 30, 50, 5, 100, 28)
    return a.select("qname", "aln_i", big(f).alias("flag"))


TRAV = """select a.qname, a.aln_i i, b.aln_i j, a.chrom_index1 = b.chrom_index1 and a.strand0 = b.strand0 and abs({0}) < 2000 fails
  from fx_aln a join fx_aln b on a.qname = b.qname and a.aln_i < b.aln_i"""
REFD = "(case when a.strand0 = 1 then a.pos1 - b.pos1 else b.pos1 - a.pos1 end)"
WRAP = f"((({REFD}) % 4294967296 + 4294967296) % 4294967296 - (b.aln_i - a.aln_i) * 300)"


def traversal(spark, sf, mode):
    return reads.pair_failures(fx.alignments(spark, sf).withColumn("query_start0", col("aln_i") * 300), 2000, mode)


@query(TRAV.format(WRAP))
def j10_p3_traversal_pairs(spark, sf):
    return traversal(spark, sf, "wrap")


@query(TRAV.format(f"({REFD} - (b.aln_i - a.aln_i) * 300)"))
def p3_traversal_signed(spark, sf):
    return traversal(spark, sf, "signed")


@query(f"select distinct qname, unnest(range(i + 1, j + 1)) aln_i from ({TRAV.format(WRAP)}) where fails")
def j10_failed_junctions(spark, sf):
    return reads.failed_junctions(traversal(spark, sf, "wrap"))


PAIRS = "p as (select *, lead(chrom_index1) over w c2, lead(pos1) over w p2, lead(strand0) over w s2, lead(ref_span) over w r2, lead(mapq) over w m2 from fx_aln window w as (partition by qname order by aln_i))"
FOLD = "(chrom_index1 = c2 and strand0 <> s2 and pos1 <= p2 + r2 - 1 and p2 <= pos1 + ref_span - 1)"


def pairs_with_flags(spark, sf):
    p = reads.adjacent_pairs(fx.alignments(spark, sf))
    fold = flags.is_foldback(col("chrom_index1"), col("pos1"), col("pos1") + col("ref_span") - 1, col("strand0"), col("next_chrom_index1"), col("next_pos1"), col("next_pos1") + col("next_ref_span") - 1, col("next_strand0"))
    same = (col("chrom_index1") == col("next_chrom_index1")) & (F.abs(col("pos1") - col("next_pos1")) < 500)
    return p.withColumn("foldback", fold).withColumn("flag", big(flags.junction_failure(same, col("next_chrom_index1") == 5, fold, col("jxn_offset") > 3, col("jxn_offset") == 3)))


JFLAG = f"case when chrom_index1 = c2 and abs(pos1 - p2) < 500 then 1 when c2 = 5 then 2 when {FOLD} then 4 when jxn_offset > 3 then 8 when jxn_offset = 3 then 16 else 0 end"


@query(f"select qname, aln_i, {JFLAG}::bigint flag, {JFLAG} & 7 <> 0 pre_chimeric, {JFLAG} & 120 <> 0 chimeric from p where c2 is not null", PAIRS)
def p4_p16_junction_failure(spark, sf):
    return pairs_with_flags(spark, sf).select("qname", "aln_i", "flag", flags.is_pre_chimeric(col("flag")).alias("pre_chimeric"), flags.is_chimeric(col("flag")).alias("chimeric"))


@query(f"select qname, aln_i from p where c2 is not null and {FOLD}", PAIRS)
def p5_foldbacks(spark, sf):
    return pairs_with_flags(spark, sf).where("foldback").select("qname", "aln_i")


@query("""select doc_id, coalesce(len(list_filter(range(1, len(q) - 3), lambda i: list_sum(q[i:i + 4]) < 40 * 5)) > 0, false) as low_window, list_sort(q)[len(q) // 2 + 1] < 38 low_median
  from (select doc_id, q from q where len(q) >= 40)""", QUAL)
def p6_p7_insertion_quality(spark, sf):
    q = fx.sequences(spark, sf).where("length(seq) >= 40").select("doc_id", codec.phred(col("seq")).alias("q"))
    return q.select("doc_id", flags.low_window(col("q"), 5, 40, F.size("q"), 20).alias("low_window"), flags.low_median(col("q"), 5, 38, F.size("q")).alias("low_median"))


@query("select qname, aln_i, case when mapq >= 50 then seq else null end s from (select *, 'ACGT' seq from fx_aln)")
def p9_dropped_columns(spark, sf):
    return fx.alignments(spark, sf).select("qname", "aln_i", lookups.kept_where(F.lit("ACGT"), col("mapq") >= 50).alias("s"))


@query("select case when mapq < 42 then 1 when div_pct = 8 then 2 when jxn_offset = 5 then 4 when pos1 % 10 > 7 then 8 when ref_span > 900 then 16 else 0 end::bigint flag, count(*) n from fx_aln where aln_i = 0 group by 1")
def p10_read_failure(spark, sf):
    f = flags.read_failure(col("mapq") < 42, col("div_pct") == 8, col("jxn_offset") == 5, col("pos1") % 10 > 7, col("ref_span") > 900)
    return reports.counter(fx.alignments(spark, sf).where("aln_i = 0").withColumn("flag", big(f)), "flag")


@query("select qname, aln_i, case when div_pct = 0 then 3 else ((mapq % 2) << 1) | (pos1 % 2) end::bigint status from fx_aln")
def p11_end_to_end(spark, sf):
    return fx.alignments(spark, sf).select("qname", "aln_i", big(flags.end_to_end(col("pos1") % 2, col("mapq") % 2, col("div_pct") == 0)).alias("status"))


@query("select qname, aln_i, jxn_offset + (case when strand0 = 0 then -1 else 1 end) * (case when div_pct > 6 then 0 else mapq % 5 end) d from fx_aln")
def p12_clip_adjusted_distance(spark, sf):
    return fx.alignments(spark, sf).select("qname", "aln_i", asof.clip_adjusted_distance(col("jxn_offset"), col("strand0"), F.lit(True), col("mapq") % 5, col("div_pct") > 6).alias("d"))


@query("""select qname, aln_i, case when s >= 400 and s <= 800 then s else -s end size from (select *, case when mapq % 2 = 1 then 1 when ref_span > 1 then ref_span - div_pct else 0 end s from fx_aln)""")
def p13_insert_size(spark, sf):
    n = F.lit(0).cast("bigint")
    s = inserts.insert_size(F.lit(2), col("mapq") % 2 == 1, n, n, col("ref_span"), col("div_pct"), n, 400, 800, True)
    return fx.alignments(spark, sf).select("qname", "aln_i", s.alias("size"))


STEM = """st as (select *, aln_i * 300 qs, aln_i * 300 + ref_span qe, qname % 3 = 0 e2e from fx_aln),
st2 as (select *, qe - min_by(qs, aln_i) over w s5, max_by(qe, aln_i) over w - qs s3 from st window w as (partition by qname)),
st3 as (select *, case when s5 <= 700 then s5 else -s5 end stem5, case when e2e then case when s3 <= 700 then s3 else -s3 end else -1 end stem3 from st2)"""


def stems(spark, sf):
    a = fx.alignments(spark, sf).withColumns({"query_start0": col("aln_i") * 300, "query_end1": col("aln_i") * 300 + col("ref_span"), "is_end_to_end": col("qname") % 3 == 0})
    return inserts.stem_lengths(a, 700)


@query("select qname, aln_i, stem5, stem3 from st3", STEM)
def p14_stem_lengths(spark, sf):
    return stems(spark, sf).select("qname", "aln_i", "stem5", big(col("stem3")).alias("stem3"))


@query("select qname, aln_i, ((case when stem5 > 0 or stem3 > 0 then 0 else 64 end) | (case when abs(jxn_offset) <= 2 or abs(jxn_offset - 1) <= 2 then 32 else 0 end))::bigint flag from st3", STEM)
def p15_stem_and_site(spark, sf):
    return stems(spark, sf).select("qname", "aln_i", big(flags.stem_site_failure(col("stem5"), col("stem3"), col("jxn_offset"), col("jxn_offset") - 1, 2)).alias("flag"))


@query("select qname, aln_i from fx_aln a where exists (select 1 from fx_aln b where b.qname = a.qname group by b.qname having max(b.div_pct) <= 6 and bool_and(b.chrom_index1 <= 4))")
def p17_usable_for_svs(spark, sf):
    a = fx.alignments(spark, sf).withColumn("read_failure", F.when(col("div_pct") > 6, 1).otherwise(0))
    return reads.usable_for_svs(a, 4).select("qname", "aln_i")


@query("select case when mapq < 44 then 'fail_bits' when div_pct < 3 then 'passes' when ref_span < 250 then 'short' when ref_span > 900 then 'long' when jxn_offset < 0 then 'quality' else 'usable' end o, count(*) n from fx_aln group by 1")
def p20_strand_usability(spark, sf):
    o = flags.strand_usability(F.when(col("mapq") < 44, 1).otherwise(0), col("div_pct"), col("ref_span"), col("jxn_offset"), 3, 250, 900, 0)
    return reports.counter(fx.alignments(spark, sf).withColumn("o", o), "o")


@query("select doc_id from q where len(q) >= 100 and list_sum(q) / len(q) >= 38 and len(list_filter(q, lambda x: x < 35)) / len(q) <= 0.4", QUAL)
def p21_read_quality(spark, sf):
    q = fx.sequences(spark, sf).where("seq <> ''").select("doc_id", codec.phred(col("seq")).alias("q"))
    return q.where(flags.passes_read_quality(col("q"), 38, 35, 0.4, 100)).select("doc_id")


@query("""select qname, len(list_filter(f, lambda x: x & 6 = 0)) > 0 any_pass, len(list_filter(f, lambda x: x & 6 <> 0)) = 0 all_pass, len(list_filter(f, lambda x: x & 6 = 6)) > 0 any_fail, len(list_filter(f, lambda x: x & 6 <> 6)) = 0 all_fail
  from (select qname, list(mapq) f from fx_aln group by qname)""")
def p22_list_filters(spark, sf):
    f = fx.alignments(spark, sf).groupBy("qname").agg(F.collect_list("mapq").alias("f"))
    return f.select("qname", *(flags.list_filter(col("f"), 6, h).alias(h) for h in ("any_pass", "all_pass", "any_fail", "all_fail")))


FINAL = """fin as (select sc, i1, i2, i3, count(*) n_instances, count(*) - (count(*) // 2) n_dedup, min(node1) node1, max(node2) node2, min(jxn_offset) jxn_offset, bit_or(sample_bits) sample_bits,
  bit_count(bit_or(sample_bits))::bigint n_samples, case when abs(min(node1)) // 536870912 = abs(max(node2)) // 536870912 then 1 else 8 end type_bits,
  case when abs(min(node1)) // 536870912 = abs(max(node2)) // 536870912 then abs(abs(max(node2)) % 536870912 - abs(min(node1)) % 536870912) else 0 end sv_size,
  case when min(min_mapq) % 7 = 0 then 1 else 0 end is_intergenomic from inst group by all)"""


def final(spark, sf):
    f = instances(spark, sf).groupBy("sc", "i1", "i2", "i3").agg(
        F.count("*").alias("n_instances"), F.min("node1").alias("node1"), F.max("node2").alias("node2"), F.min("jxn_offset").alias("jxn_offset"), F.bit_or("sample_bits").alias("sample_bits"), F.min("min_mapq").alias("_q")
    )
    same = codec.node_chrom(col("node1")) == codec.node_chrom(col("node2"))
    return f.withColumns({
        "n_dedup": F.expr("n_instances - n_instances div 2"), "n_samples": big(F.bit_count("sample_bits")), "type_bits": F.when(same, 1).otherwise(8),
        "sv_size": F.when(same, F.abs(codec.node_pos(col("node2")) - codec.node_pos(col("node1")))).otherwise(0), "is_intergenomic": F.when(col("_q") % 7 == 0, 1).otherwise(0),
    }).drop("_q")


@query("select sc, i1, i2, i3 from fin where n_samples >= 2 and n_samples <= 4 and not (sv_size = 0 and type_bits <> 8)", f"{G}, {INST}, {FINAL}")
def p23_p24_filter_chain(spark, sf):
    return junctions.filter_chain(final(spark, sf), min_samples=2, max_samples=4, drop_zero_size=True).select("sc", "i1", "i2", "i3")


CLASSES = """cls as (select *, case when is_intergenomic = 1 then 'intergenome' when n_dedup = 1 and (type_bits = 8 or sv_size > 1000000) then 'artifact' when n_dedup >= 3 then 'validated' when n_dedup = 2 then 'unexpected2' else 'unexpected1' end jxn_class,
  case when n_dedup >= 3 then 'validated' when n_dedup = 2 then 'unexpected2' else 'unexpected1' end jxn_stratum,
  case when jxn_offset > 0 then 'insertion' when jxn_offset < 0 then 'microhomology' else 'blunt' end offset_type,
  case when n_dedup = 1 then 'singleton' when n_instances = 2 then 'two instances' else '>=3 instances' end coverage_type from fin)"""


@query("select sc, i1, i2, i3, jxn_class, jxn_stratum, offset_type, coverage_type from cls", f"{G}, {INST}, {FINAL}, {CLASSES}")
def p25_p26_classes(spark, sf):
    return junctions.add_classes(final(spark, sf)).select("sc", "i1", "i2", "i3", "jxn_class", "jxn_stratum", "offset_type", "coverage_type")


@query("select case when d = 0 then 'snv' when d > 0 then 'insertion' else 'deletion' end c, count(*) n from (select length(repeat('A', (mapq % 3)::int)) - div_pct % 3 d from fx_aln) group by 1")
def p27_variant_class(spark, sf):
    c = flags.variant_class(col("div_pct") % 3, F.expr("repeat('A', cast(mapq % 3 as int))"))
    return reports.counter(fx.alignments(spark, sf).withColumn("c", c), "c")


@query("select sc, i1, i2, i3 from fin where (n_instances = 1 or n_instances >= 3) and (type_bits = 8 or sv_size > 1000)", f"{G}, {INST}, {FINAL}")
def p28_tally_inclusion(spark, sf):
    return lookups.tallied(final(spark, sf)).select("sc", "i1", "i2", "i3")


ENDS = "case when {0} % 3 = 0 then 'T' when {0} % 3 = 1 then 'A' else '-' end"


@query(f"select case when a || b in ('TA', 'AT') then 'TA' when a || b in ('T-', '-T') then 'T-' when a || b in ('A-', '-A') then 'A-' else a || b end c, count(*) n from (select {ENDS.format('mapq')} a, {ENDS.format('div_pct')} b from fx_aln) group by 1")
def p29_target_class(spark, sf):
    return reports.counter(fx.alignments(spark, sf).withColumn("c", flags.target_class(F.expr(ENDS.format("mapq")), F.expr(ENDS.format("div_pct")))), "c")


COV = """e as (select chrom_index1 c, pos1 - 1 p, 1 d from fx_aln union all select chrom_index1, pos1 - 1 + ref_span, -1 from fx_aln),
ev as (select c, p, sum(d) d from e group by c, p),
r as (select c chrom_index1, p start0, lead(p) over (partition by c order by p) end1, sum(d) over (partition by c order by p rows unbounded preceding)::bigint coverage from ev where d <> 0),
cov as (select * from r where coverage > 0)"""


def spans(spark, sf):
    return fx.alignments(spark, sf).withColumn("start0", col("pos1") - 1).withColumn("end1", col("pos1") - 1 + col("ref_span"))


@query("select chrom_index1, greatest(start0, 5000)::bigint start0, least(end1, 7000)::bigint end1, coverage from cov where end1 > 5000 and start0 < 7000", COV)
def p30_window_clip(spark, sf):
    out = intervals.clip_window(intervals.coverage_runs(spans(spark, sf)), 5000, 7000)
    return out.withColumn("start0", big(col("start0"))).withColumn("end1", big(col("end1")))


# joins ---------------------------------------------------------------------------------------------------

NEAR = """qs as (select chrom_index1 c, pos1 p, qname, aln_i, strand0 from fx_aln), ds as (select distinct chrom_index1 c, site_pos1 s from fx_site),
rk as (select c, s, row_number() over (partition by c order by s) k from ds),
lo as (select q.*, r.s lo, r.k lk from qs q asof left join rk r on q.c = r.c and q.p >= r.s),
hi as (select q.*, r.s hi, r.k hk from lo q asof left join rk r on q.c = r.c and q.p <= r.s),
nr as (select c chrom_index1, p pos1, qname, aln_i, strand0, case when lo is null or hi is null then null when lo = p or p - lo < hi - p then lo else hi end site_pos1,
  case when lo is null or hi is null then null when lo = p or p - lo < hi - p then lk else -hk end site_index1 from hi)"""


def nearest(spark, sf):
    return asof.nearest_site(fx.alignments(spark, sf).select("chrom_index1", "pos1", "qname", "aln_i", "strand0"), fx.sites(spark, sf))


@query("select qname, aln_i, site_pos1, site_index1, pos1 - site_pos1 distance from nr", NEAR)
def j1_nearest_site(spark, sf):
    return nearest(spark, sf).select("qname", "aln_i", "site_pos1", "site_index1", "distance")


@query("""select qname, aln_i, proj_index1, s proj_pos1 from (select *, case when strand0 = 1 and site_index1 < 0 and abs(pos1 - site_pos1) > 2 and abs(site_index1) > 1 then abs(site_index1) - 1
  when strand0 = 0 and site_index1 > 0 and abs(pos1 - site_pos1) > 2 and site_index1 < (select count(*) from rk where c = chrom_index1) then site_index1 + 1 else abs(site_index1) end proj_index1 from nr) left join rk on c = chrom_index1 and k = proj_index1""", NEAR)
def w13_projected_site(spark, sf):
    return asof.project_site(nearest(spark, sf), fx.sites(spark, sf), 2).select("qname", "aln_i", "proj_index1", "proj_pos1")


HIT = "h as (select a.qname, a.aln_i, g.name, a.pos1 - (g.start0 + (g.end1 - g.start0) // 2) d from fx_aln a join fx_region g on a.chrom_index1 = g.chrom_index1 and a.pos1 - 1 >= g.start0 and a.pos1 - 1 < g.end1 where g.kind = 0)"


@query("select qname, aln_i, name, d center_distance from h", HIT)
def j2_point_in_region(spark, sf):
    return intervals.point_in_interval(fx.alignments(spark, sf), fx.regions(spark, sf).where("kind = 0").drop("kind")).select("qname", "aln_i", "name", "center_distance")


@query("select a.qname, a.aln_i, coalesce(string_agg(distinct name, ',' order by name), '') names, min(abs(d)) nearest_center from fx_aln a left join h using (qname, aln_i) group by all", HIT)
def j2_regions_of_points(spark, sf):
    return intervals.regions_of_points(fx.alignments(spark, sf).select("qname", "aln_i", "chrom_index1", "pos1"), fx.regions(spark, sf).where("kind = 0").drop("kind")).select("qname", "aln_i", "names", "nearest_center")


@query("select name from fx_region a where kind = 0 and exists (select 1 from fx_region b where kind = 2 and a.chrom_index1 = b.chrom_index1 and a.start0 < b.end1 and b.start0 < a.end1)")
def j3_overlap_semi(spark, sf):
    g = fx.regions(spark, sf)
    return intervals.overlap_join(g.where("kind = 0"), g.where("kind = 2"), 512).select("name")


@query("select name from fx_region a where kind = 0 and not exists (select 1 from fx_region b where kind = 2 and a.chrom_index1 = b.chrom_index1 and a.start0 < b.end1 and b.start0 < a.end1)")
def j3_overlap_anti(spark, sf):
    g = fx.regions(spark, sf)
    return intervals.overlap_join(g.where("kind = 0"), g.where("kind = 2"), 512, "left_anti").select("name")


OBS = "ob as (select chrom_index1, pos1 site_pos1, count(*) n_observed from fx_aln group by all), isl as (select distinct chrom_index1, site_pos1 from fx_site)"


def observed(spark, sf):
    return fx.alignments(spark, sf).groupBy("chrom_index1", col("pos1").alias("site_pos1")).agg(F.count("*").alias("n_observed"))


@query("select chrom_index1, site_pos1, i.site_pos1 is not null in_silico, coalesce(n_observed, 0) n_observed from ob full join isl i using (chrom_index1, site_pos1)", OBS)
def j4_merge_site_tables(spark, sf):
    return sites.merge_site_tables(observed(spark, sf), fx.sites(spark, sf))


@query("select b size_bin, count(*) n, coalesce(max(m), 0) m from (select ref_span // 100 * 100 b from fx_aln where strand0 = 0) left join (select ref_span // 100 * 100 b, count(*) m from fx_aln where strand0 = 1 and mapq > 50 group by 1) using (b) group by 1")
def j5_left_merge(spark, sf):
    a = fx.alignments(spark, sf).withColumn("size_bin", codec.bin_floor(col("ref_span"), 100))
    left = a.where("strand0 = 0").groupBy("size_bin").agg(F.count("*").alias("n"))
    return lookups.left_merge(left, a.where("strand0 = 1 and mapq > 50").groupBy("size_bin").agg(F.count("*").alias("m")), ["size_bin"])


@query("""select qname // 2 zmw, case when count(distinct qname % 2) = 2 then 'pair' else 'orphan' end outcome from (select distinct qname from fx_aln) group by 1""")
def j6_strand_pairs(spark, sf):
    from ..operators.duplex import pair_strands

    s = fx.alignments(spark, sf).select("qname").distinct().selectExpr("'m' as movie", "qname div 2 as zmw", "int(qname % 2) as strand", "true as usable", "'A' as seq", "array(30) as qual")
    return pair_strands(s).select("zmw", "outcome")


@query(f"select (qname // 2) || '/' || (qname % 2 + 1) qname, node5, o paired_node from (select *, case when qname % 2 = 0 then max(node5) filter (qname % 2 = 1) over (partition by qname // 2) else max(node5) filter (qname % 2 = 0) over (partition by qname // 2) end o from (select qname, {NODE} node5 from fx_aln where aln_i = 0))")
def j7_mate_nodes(spark, sf):
    n = codec.pack_node(col("chrom_index1"), col("pos1"), col("strand0"))
    return reads.mate_nodes(fx.alignments(spark, sf).where("aln_i = 0").select(F.expr("concat(qname div 2, '/', qname % 2 + 1)").alias("qname"), n.alias("node5")))


@query("select chrom_index1, pos1, sum(n)::bigint n_observed from (select chrom_index1, pos1, count(*) n from fx_aln where aln_i = 0 group by all union all select chrom_index1, pos1, count(*) from fx_aln where aln_i > 0 group by all) group by all")
def j8_segment_union(spark, sf):
    a = fx.alignments(spark, sf)
    c = lambda w: a.where(w).groupBy("chrom_index1", "pos1").agg(F.count("*").alias("n"))
    return lookups.summed_union([c("aln_i = 0"), c("aln_i > 0")], ["chrom_index1", "pos1"], "n", "n_observed")


@query("select s.chrom_index1, s.site_pos1, coalesce(max(coverage), 0) coverage from isl s left join cov r on r.chrom_index1 = s.chrom_index1 and s.site_pos1 - 1 >= r.start0 and s.site_pos1 - 1 < r.end1 group by all", f"{OBS}, {COV}")
def j9_breakpoint_coverage(spark, sf):
    points = fx.sites(spark, sf).distinct().withColumn("pos1", col("site_pos1"))
    return intervals.depth_at(points, intervals.coverage_runs(spans(spark, sf))).select("chrom_index1", "site_pos1", "coverage")


@query("select o.chrom_index1, o.site_pos1, arg_min(s.site_pos1, abs(o.site_pos1 - s.site_pos1) * 1000000 + s.site_pos1) in_silico_pos1, min(abs(o.site_pos1 - s.site_pos1)) distance from ob o join isl s on o.chrom_index1 = s.chrom_index1 and abs(o.site_pos1 - s.site_pos1) <= 20 group by all", OBS)
def j11_best_in_silico(spark, sf):
    return sites.best_in_silico(observed(spark, sf).select("chrom_index1", "site_pos1"), fx.sites(spark, sf).distinct(), 20)


@query("select node1, node2, sample_bits, string_agg(distinct 's' || i, ',' order by 's' || i) sample_names from (select distinct node1, node2, sample_bits from fin), range(5) t(i) where sample_bits & (1::bigint << i::int) > 0 group by all", f"{G}, {INST}, {FINAL}")
def j12_samples_of_mask(spark, sf):
    names = spark.range(5).selectExpr("shiftleft(1L, int(id)) as sample_bit", "concat('s', id) as sample_name")
    return junctions.samples_of(final(spark, sf).select("node1", "node2", "sample_bits").distinct(), names)


@query("select qname, aln_i, chrom_size from fx_aln join fx_chrom using (chrom_index1)")
def j13_chrom_lookup(spark, sf):
    return lookups.with_chrom_sizes(fx.alignments(spark, sf), fx.chroms(spark)).select("qname", "aln_i", "chrom_size")


@query("select qname, aln_i from fx_aln where qname in (select qname from fx_aln where mapq = 40)")
def j14_key_set_semi(spark, sf):
    a = fx.alignments(spark, sf)
    return lookups.rows_of_keys(a, a.where("mapq = 40"), "qname").select("qname", "aln_i")


@query("select distinct sc::bigint sc, i1::bigint i1, i2::bigint i2, i3::bigint i3, qname, n from g6 join (select qname, count(*) n from fx_aln group by qname) using (qname)", G)
def j15_junction_read_paths(spark, sf):
    paths = reads.read_paths(fx.alignments(spark, sf)).select("qname", big(F.size("pos1s")).alias("n"))
    return lookups.reads_of_groups(grouped(spark, sf), paths, ["sc", "i1", "i2", "i3"]).select("sc", "i1", "i2", "i3", "qname", "n")


@query("select distinct node1, node2 from k where abs(node1) between 536870912 * 2 + 1000 and 536870912 * 2 + 3000 or abs(node2) between 536870912 * 2 + 1000 and 536870912 * 2 + 3000", J)
def j16_either_end(spark, sf):
    lo, hi = (2 << 29) + 1000, (2 << 29) + 3000
    return lookups.touching(junctions_of(spark, sf), lo, hi).select("node1", "node2").distinct()


@query("select coalesce(a.k, b.k) k, a.n, b.m from (select mapq k, count(*) n from fx_aln where mapq < 52 group by 1) a full join (select mapq k, count(*) m from fx_aln where mapq > 48 and strand0 = 1 group by 1) b on a.k = b.k")
def j17_full_merge(spark, sf):
    a = fx.alignments(spark, sf).withColumnRenamed("mapq", "k")
    return digest.enzyme_summary(a.where("k < 52").groupBy("k").agg(F.count("*").alias("n")), a.where("k > 48 and strand0 = 1").groupBy("k").agg(F.count("*").alias("m")), "k")


@query("select qname, aln_i, chrom_index1 <= 4 and c2 <= 4 allowed from p where c2 is not null", PAIRS)
def j18_end_pairs(spark, sf):
    return reads.adjacent_pairs(fx.alignments(spark, sf)).select("qname", "aln_i", ((col("chrom_index1") <= 4) & (col("next_chrom_index1") <= 4)).alias("allowed"))
