"""Registered queries of summaries, tallies, filters and formats, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codec, flags
from ..operators import digest, inserts, intervals, junctions, reports, snv
from . import fixtures as fx
from . import more
from .core import COV, FINAL, G, INST, ORACLES, QUERIES, big, col, final, query, spans  # noqa: F401

CLASS = "case {0} % 6 when 0 then '--' when 1 then 'TT' when 2 then 'TA' when 3 then 'T-' when 4 then 'AA' else 'A-' end"


@query("select qname, aln_i, ((ref_span // 20) << 9) | ((mapq % 6) << 6) | ((div_pct % 6) << 3) | (pos1 % 6) packed from fx_aln")
def p29_packed_target(spark, sf):
    code = flags.packed_target(F.expr("ref_span div 20"), *(F.expr(CLASS.format(c)) for c in ("mapq", "div_pct", "pos1")))
    return fx.alignments(spark, sf).select("qname", "aln_i", big(code).alias("packed"))


LABELS = "f2 as (select *, n_instances % 2 any_chimeric, case when type_bits = 8 then 'translocation' else 'deletion' end jxn_type from fin)"


def labelled(spark, sf):
    f = final(spark, sf).withColumn("any_chimeric", col("n_instances") % 2).withColumn("jxn_type", F.when(col("type_bits") == 8, "translocation").otherwise("deletion"))
    return junctions.add_classes(f)


@query("select sc, i1, i2, i3, case when any_chimeric = 0 then 'had no chimeric' else 'had >=1 chimeric' end chimericity, case when is_intergenomic = 0 then 'single genome' else 'intergenomic' end genomicity from f2", f"{G}, {INST}, {FINAL}, {LABELS}")
def p26_labels(spark, sf):
    return labelled(spark, sf).select(big(col("sc")).alias("sc"), "i1", "i2", "i3", "chimericity", "genomicity")


@query("""select report, key, count(*) n from (
  select 'offset' report, case when jxn_offset > 0 then 'insertion' when jxn_offset < 0 then 'microhomology' else 'blunt' end key from f2 union all select 'type', jxn_type from f2
  union all select 'chimericity', c from f3 union all select 'singletons', c from f3 where n_dedup = 1 union all select 'validated', c from f3 where n_dedup >= 3
  union all select 'genomicity', case when is_intergenomic = 0 then 'single genome' else 'intergenomic' end from f2
  union all select 'count', case when n_dedup = 1 then 'singleton' when n_instances = 2 then 'two instances' else '>=3 instances' end from f2) group by all""",
  f"{G}, {INST}, {FINAL}, {LABELS}, f3 as (select n_dedup, case when any_chimeric = 0 then 'had no chimeric' else 'had >=1 chimeric' end c from f2)")
def a31_final_counters(spark, sf):
    return reports.final_counters(labelled(spark, sf))


ENDS = """ends as (select *, case when sc % 2 = 0 then 'c1_hs1' else 'c1' end chrom1, case when i1 % 3 = 0 then 'c2_mm39' else 'c2' end chrom2, i1 % 5 coverage1, i2 % 7 coverage2, i3 % 2 is_excluded, n_instances % 2 is_duplex,
  case when i1 % 2 = 0 then '' else 'g1' end target1, case when i2 % 2 = 0 then 'g2' else null end target2, case when i1 % 3 = 0 then ',' else ',g1,x,' end genes1, case when i2 % 3 = 1 then ',' else ',x,g2,' end genes2,
  case when type_bits = 8 then 'translocation' else 'deletion' end jxn_type, n_instances n_observed, case when i1 % 2 = 0 then '1,0' else '1' end allowed_sizes, case when i2 % 2 = 0 then '0' else '1' end passed_stems,
  case when i3 % 2 = 0 then '0,4' else '16' end aln_flags, '0' jxn_flags from {0})"""


def ends(spark, sf):
    f = final(spark, sf).withColumns({c: big(col(c)) for c in ("sc", "i1", "i2", "i3")})
    return spark.sql(f"with {ENDS.format('{f}')} select * from ends", f=f)


@query("""select sc, i1, i2, i3 from ends where (coverage1 >= 2 or coverage2 >= 2) and (chrom1 like '%\\_hs1' escape '\\' or chrom2 like '%\\_hs1' escape '\\') and is_excluded = 0 and is_duplex = 1""", f"{G}, {INST}, {FINAL}, {ENDS.format('fin')}")
def p23_filters(spark, sf):
    return junctions.filter_chain(ends(spark, sf), min_coverage=2, genome="hs1", exclude=True, duplex="duplex").select("sc", "i1", "i2", "i3")


TALLIED = """kept as (select * from ends where (n_observed = 1 or n_observed >= 3) and (jxn_type = 'translocation' or sv_size > 1000)),
two as (select *, chrom1 chrom, coalesce(target1, '') target, genes1 genes from kept union all select *, chrom2, coalesce(target2, ''), genes2 from kept),
keyed as (select case when chrom like '%\\_%' escape '\\' then split_part(chrom, '_', 2) else 'hs1' end genome, target = '' and genes = ',' is_gap, target <> '' on_target, genes <> ',' in_gene,
  target <> '' and genes like '%,' || target || ',%' in_target_gene, case when target = '' then 'NA' else target end target_gene, jxn_type, jxn_type <> 'translocation' and sv_size < 1000000 is_local_sv,
  is_intergenomic <> 0 is_intergenome, n_observed <> 1 is_validated, allowed_sizes like '%1%' has_allowed_size, allowed_sizes like '%0%' has_disallowed_size, passed_stems like '%1%' has_passed_stem, passed_stems like '%0%' has_unpassed_stem,
  aln_flags like '%0%' has_passed_alns, regexp_matches(aln_flags, '[1-9]') has_unpassed_alns, true has_passed_jxn, false has_unpassed_jxn from two)"""


@query("select *, floor(n_bkpts / sum(n_bkpts) over (partition by genome) * 10000) / 10000 frac_genome, floor(n_bkpts / sum(n_bkpts) over () * 10000) / 10000 frac_all from (select *, count(*) n_bkpts from keyed group by all)", f"{G}, {INST}, {FINAL}, {ENDS.format('fin')}, {TALLIED}")
def a20_breakpoint_keys(spark, sf):
    return junctions.breakpoint_tally(ends(spark, sf), "hs1")


@query("""select count(*) n_junctions, count(*) filter (n_observed >= 3) n_three_or_more, count(*) filter (n_observed = 1 and jxn_type = 'translocation') n_single_translocations, count(*) filter (is_intergenomic <> 0) n_intergenome,
  count(*) filter (a or b) n_on_target_1, count(*) filter (a and b) n_on_target_2, count(*) filter (c or d) n_in_gene_1, count(*) filter (c and d) n_in_gene_2, count(*) filter ((a or b) and (c or d)) n_target_gene_1, count(*) filter (a and b and c and d) n_target_gene_2
  from (select *, target1 <> '' a, coalesce(target2, '') <> '' b, genes1 <> ',' c, genes2 <> ',' d from ends)""", f"{G}, {INST}, {FINAL}, {ENDS.format('fin')}")
def a20_tally_summary(spark, sf):
    return junctions.tally_summary(ends(spark, sf))


@query("""select class, n_alns, n_seq_bases, n_proj_bases, floor(n_alns / size * 1000 + 0.5) / 1000 aln_density, floor(n_seq_bases / size * 100 + 0.5) / 100 seq_coverage, floor(n_proj_bases / size * 100 + 0.5) / 100 proj_coverage,
  floor(n_seq_bases / n_alns * 100 + 0.5) / 100 avg_aln, floor(n_proj_bases / n_alns * 100 + 0.5) / 100 avg_insert, floor(n_seq_bases / n_proj_bases * 1000 + 0.5) / 1000 frac_sequenced
  from (select case mapq % 3 when 0 then 'on' when 1 then 'near' else 'off' end class, count(*) n_alns, sum(ref_span)::bigint n_seq_bases, sum(abs(ref_span + div_pct * 3) + 1)::bigint n_proj_bases from fx_aln group by 1)
  join (values ('on', 50000.0::double), ('near', 20000.0::double), ('off', 300000.0::double)) v(class, size) using (class)""")
def a29_target_densities(spark, sf):
    a = fx.alignments(spark, sf).selectExpr("case mapq % 3 when 0 then 'on' when 1 then 'near' else 'off' end as class", "pos1 as start1", "pos1 + ref_span - 1 as end1", "pos1 as site_first", "pos1 + ref_span + div_pct * 3 as site_last")
    return reports.target_summary(a, {"on": 50_000, "near": 20_000, "off": 300_000})


_name = lambda p: str(p).replace(".", "_")
SUMMARY = (
    "select mapq, a.n_sites, a.total_gb, a.least, a.most, "
    + ", ".join(f"a.q_{_name(p)}, b.nxx_{_name(p)}" for p in digest.PERCENTS) + ", " + ", ".join(f"a.molar_{s}, a.mass_{s}, a.n_{s}" for s in digest.LEAST_SIZES)
    + " from (select mapq, count(*) n_sites, round(sum(ref_span) / 1e9, 2) total_gb, min(ref_span) least, max(ref_span) most, "
    + ", ".join(f"quantile_cont(ref_span, {p / 100}) q_{_name(p)}" for p in digest.PERCENTS) + ", "
    + ", ".join(f"count(*) filter (ref_span >= {s} and ref_span < {2 * s}) / count(*) molar_{s}, coalesce(sum(ref_span) filter (ref_span >= {s} and ref_span < {2 * s}), 0) / sum(ref_span) mass_{s}, count(*) filter (ref_span >= {s} and ref_span < {2 * s}) n_{s}" for s in digest.LEAST_SIZES)
    + " from fx_aln group by mapq) a join (select mapq, " + ", ".join(f"max(ref_span) filter (c >= t * (1 - {p / 100}::double)) nxx_{_name(p)}" for p in digest.PERCENTS)
    + " from (select mapq, ref_span, sum(m) over (partition by mapq order by ref_span desc rows unbounded preceding) c, sum(m) over (partition by mapq) t from (select mapq, ref_span, sum(ref_span) m from fx_aln group by all)) group by mapq) b using (mapq)"
)


@query(SUMMARY)
def a18_fragment_summary(spark, sf):
    return digest.fragment_summary(fx.alignments(spark, sf).withColumn("size", col("ref_span")), ["mapq"])


@query("""select size_bin::bigint size_bin, floor(sum(p) * 1e7 + 0.5)::bigint p from (select (a.s + b.s) // 20 * 20 size_bin, a.p * b.p p from piece a, piece b) group by 1 having sum(p) > 1e-9""",
  """h as (select ref_span // 20 * 20 size_bin, count(*)::double n from fx_aln group by 1), h2 as (select size_bin x, n / (select sum(n) from h where size_bin >= 20) p from h where size_bin >= 20),
piece as (select s, sum(p / (x - 19)) p from h2, unnest(range(10, x - 9)) t(s) group by s)""")  # fmt: skip
def a33_middle_model(spark, sf):
    m = inserts.middle_model(inserts.histogram(fx.alignments(spark, sf), [], col("ref_span"), 20), 20)
    return m.where("p > 1e-9").select("size_bin", F.floor(col("p") * 1e7 + 0.5).alias("p"))


RUNS = COV + """, runs as (select *, coverage - start0 % 2 n_ref from cov),
rep as (select * from runs r where not exists (select 1 from fx_region g where g.kind = 1 and g.chrom_index1 = r.chrom_index1 and g.start0 < r.end1 and r.start0 < g.end1) and exists (select 1 from fx_region g where g.kind <> 1 and g.chrom_index1 = r.chrom_index1 and g.start0 < r.end1 and r.start0 < g.end1))"""


def runs_of(spark, sf):
    r = intervals.coverage_runs(spans(spark, sf)).withColumn("n_ref", col("coverage") - col("start0") % 2)
    g = fx.regions(spark, sf)
    return r, snv.reported_runs(r, g.where("kind = 1"), g.where("kind <> 1"))


@query("select chrom_index1, start0, end1, coverage, n_ref from rep", RUNS)
def a12_reported_runs(spark, sf):
    return runs_of(spark, sf)[1].select("chrom_index1", "start0", "end1", "coverage", "n_ref")


@query("""select (select count(*) from runs) n_chunks, count(*) n_reported_chunks, sum(end1 - start0)::bigint n_reported_bases, sum((end1 - start0) * coverage)::bigint reported_coverage, coalesce(sum(end1 - start0) filter (coverage > n_ref), 0)::bigint n_variant_bases from rep""", RUNS)
def a12_pileup_metadata(spark, sf):
    return snv.pileup_metadata(*runs_of(spark, sf))


@query("""select case when l - f + 1 < 60 then floor((f + l) / 2 - 30 + 0.5)::bigint else f end as first, case when l - f + 1 < 60 then ceil((f + l) / 2 + 30 - 0.5)::bigint else l end as last, coverage n_ref, 0 n_del, 1 n_ins, 0 n_a, 0 n_c, 0 n_g, 0 n_t
  from (select *, greatest(start0 + 1, 5000) f, least(end1, 7000) l from cov where end1 >= 5000 and start0 + 1 <= 7000)""", COV)
def p30_pileup_track(spark, sf):
    zero = {c: F.lit(0) for c in ("n_a", "n_c", "n_g", "n_t", "n_n", "n_del_allowed", "n_del", "n_ins")}
    r = intervals.coverage_runs(spans(spark, sf)).withColumn("n_ref", col("coverage")).withColumns(zero).withColumn("n_ins_allowed", F.lit(1))
    return intervals.pileup_track(r, 5000, 7000, False, 20.0)


PAIRED = "concat({0}, {1})"


@query("""select a, b, case when a = 'N' or b = 'N' then 'N' when a = b then a else (select code from (values ('AG', 'R'), ('CT', 'Y'), ('CG', 'S'), ('AT', 'W'), ('GT', 'K'), ('AC', 'M')) v(bases, code)
  where (a <> b and contains(bases, a) and contains(bases, b)) or (a = code and contains(bases, b)) or (b = code and contains(bases, a))) end code
  from (select distinct substr('ACGTRYSWKMN', (mapq % 11 + 1)::int, 1) a, substr('ACGTRYSWKMN', (pos1 % 11 + 1)::int, 1) b from fx_aln)""")
def f9_pair_codes(spark, sf):
    p = fx.alignments(spark, sf).selectExpr("substring('ACGTRYSWKMN', int(mapq % 11 + 1), 1) as a", "substring('ACGTRYSWKMN', int(pos1 % 11 + 1), 1) as b").distinct()
    return p.select("a", "b", codec.paired_code(col("a"), col("b")).alias("code"))


@query("""select x, format('{:,}', x) commas, case when x < 1000 then x::varchar else regexp_replace(format('{:.2f}', floor((x + g / 2.0::double) / g) * g / s), '\\.?0+$', '') || u end short,
  case when t then 9.25 else round(log10(x), 6) end log_size, floor(x / 7.0::double * 1000 + 0.5) / 1000 rounded
  from (select *, 10 ** (floor(log10(x)) - 2) g, case when x < 1000000 then 1e3 when x < 1000000000 then 1e6 else 1e9 end s, case when x < 1000000 then 'K' when x < 1000000000 then 'M' else 'B' end u from (select distinct pos1 * ref_span * (1 + mapq * 997) x, div_pct = 3 t from fx_aln))""")
def f13_formats(spark, sf):
    x = fx.alignments(spark, sf).selectExpr("pos1 * ref_span * (1 + mapq * 997) as x", "div_pct = 3 as t").distinct()
    return x.select(
        "x", codec.commify(col("x")).alias("commas"), codec.compress_integer(col("x")).alias("short"), F.round(codec.log10_size(col("x"), col("t")), 6).alias("log_size"), codec.round_count(col("x") / 7.0).alias("rounded")
    )


@query("""select sc, i1, i2, i3, min_stem, min_divergence, instances from (select sc, i1, i2, i3, min(abs(qname % 13 - 6))::bigint min_stem, min(qname % 9)::double min_divergence,
  string_agg(qname || ':' || aln_i || ':' || failure_flag || ':' || min_mapq, ',' order by qname, aln_i, failure_flag, min_mapq) instances from cd group by all)""", f"{G}, {INST}, {more.DEDUP}")
def a5_final_lists(spark, sf):
    f = more.channel_dedup(spark, sf).withColumn("stem5", F.expr("qname % 13 - 6")).withColumn("divergence", F.expr("cast(qname % 9 as double)"))
    item = lambda x: F.concat_ws(":", *(x[c].cast("string") for c in ("qname", "aln_i", "failure_flag", "min_mapq")))
    return junctions.final_junctions(f, more.KEYS).select(*more.KEYS, "min_stem", "min_divergence", F.array_join(F.transform("instances", item), ",").alias("instances"))
