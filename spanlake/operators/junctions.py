"""Junction instances, their duplicates, and the final junction roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import flags
from .fuzzy import GROUP


def roll_up(grouped: DataFrame, keys: list[str] = GROUP) -> DataFrame:
    """Counts, distinct reads, best quality, sample mask and number of samples of each group."""
    return grouped.groupBy(*keys).agg(
        F.count("*").alias("n_instances"), F.count_distinct("qname").alias("n_reads"), F.max("min_mapq").alias("max_min_mapq"),
        F.bit_or("sample_bits").alias("sample_bits"), F.bit_count(F.bit_or("sample_bits")).cast("bigint").alias("n_samples"),
    )


def final_junctions(instances: DataFrame, keys: list[str]) -> DataFrame:
    """The full roll-up, with lists.

    ``instances``: keys, qname, aln_i, is_duplicate, failure_flag, orientation, stem5, min_mapq, divergence, sample_bits.
    """
    order = F.struct("qname", "aln_i", "failure_flag", "min_mapq")
    return instances.groupBy(*keys).agg(
        F.count("*").alias("n_instances"), F.count_distinct("qname").alias("n_reads"), F.count_if(F.col("is_duplicate") == 0).alias("n_dedup"),
        F.max(flags.is_chimeric(F.col("failure_flag")).cast("bigint")).alias("any_chimeric"), F.bit_or("failure_flag").alias("failure_flags"),
        F.min(F.abs("stem5")).alias("min_stem"), F.max("min_mapq").alias("max_min_mapq"), F.min("divergence").alias("min_divergence"),
        F.bit_or("sample_bits").alias("sample_bits"), F.bit_count(F.bit_or("sample_bits")).cast("bigint").alias("n_samples"),
        (F.min("orientation") != F.max("orientation")).cast("bigint").alias("is_bidirectional"),
        (F.count("*") > F.count_distinct("qname")).cast("bigint").alias("has_multi_instance_read"),
        F.array_sort(F.collect_list(order)).alias("instances"),
    )


def mark_channel_duplicates(instances: DataFrame, keys: list[str]) -> DataFrame:
    """Within a junction and channel, instances of the rarer orientation are duplicates (a tie keeps the lower one)."""
    n = instances.groupBy(*keys, "channel", "orientation").agg(F.count("*").alias("_n"))
    best = n.groupBy(*keys, "channel").agg(F.max_by("orientation", F.struct("_n", -F.col("orientation"))).alias("_best"))
    return instances.join(best, [*keys, "channel"]).withColumn("is_duplicate", (F.col("orientation") != F.col("_best")).cast("bigint")).drop("_best")


def mark_span_duplicates(instances: DataFrame, keys: list[str], best_length: str) -> DataFrame:
    """Within a junction and pair of outer nodes only one read's instances aren't duplicates.

    It is the first read (by qname, aln_i) with an instance whose sequence has the best length, else the first one.
    """
    w = Window.partitionBy(*keys, "outer1", "outer2").orderBy((F.char_length("jxn_seq") != F.col(best_length)).cast("int"), "qname", "aln_i")
    return instances.withColumn("_q", F.first("qname").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("is_duplicate", (F.col("qname") != F.col("_q")).cast("bigint")).drop("_q")


def best_sequence(instances: DataFrame, keys: list[str], best_length: str) -> DataFrame:
    """Most frequent junction sequence by tier: unduplicated of the best length, of the best length, any; ties to the least."""
    fits = F.char_length("jxn_seq") == F.col(best_length)
    tier = F.when(fits & (F.col("is_duplicate") == 0), 0).when(fits, 1).otherwise(2)
    tiers = instances.select(*keys, "jxn_seq", F.explode(F.filter(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda t: t >= F.col("_tier"))).alias("t")) if "_tier" in instances.columns else (
        instances.withColumn("_tier", tier).select(*keys, "jxn_seq", F.explode(F.sequence(F.col("_tier"), F.lit(2))).alias("t"))
    )
    n = tiers.groupBy(*keys, "t", "jxn_seq").agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg(F.min_by("jxn_seq", F.struct("t", -F.col("n"), "jxn_seq")).alias("best_seq"))


def add_classes(final: DataFrame) -> DataFrame:
    """Class, stratum and report labels of each final junction."""
    return final.withColumns({
        "jxn_class": flags.junction_class(F.col("is_intergenomic") == 1, F.col("n_dedup"), F.col("type_bits"), F.col("sv_size")),
        "jxn_stratum": flags.junction_stratum(F.col("n_dedup")),
        "offset_type": flags.offset_label(F.col("jxn_offset")),
        "coverage_type": flags.coverage_label(F.col("n_dedup"), F.col("n_instances")),
        "genomicity": flags.genomicity_label(F.col("is_intergenomic")),
    } | ({"chimericity": flags.chimericity_label(F.col("any_chimeric"))} if "any_chimeric" in final.columns else {}))


def filter_chain(
    final: DataFrame, min_coverage: int = 1, genome: str | None = None, exclude: bool = False, min_samples: int = 0, max_samples: int = 0,
    duplex: str = "any", list_filters: dict[str, tuple[str, int]] | None = None, drop_zero_size: bool = False,
) -> DataFrame:
    """Composable junction filters; each is off at its default."""
    out = final
    if min_coverage > 1:
        out = out.where((F.col("coverage1") >= min_coverage) | (F.col("coverage2") >= min_coverage))
    if genome:
        out = out.where((F.substring_index("chrom1", "_", -1) == genome) | (F.substring_index("chrom2", "_", -1) == genome))
    if exclude:
        out = out.where("is_excluded = 0")
    if min_samples:
        out = out.where(F.col("n_samples") >= min_samples)
    if max_samples:
        out = out.where(F.col("n_samples") <= max_samples)
    if duplex != "any":
        out = out.where(F.col("is_duplex") == (1 if duplex == "duplex" else 0))
    for column, (how, bits) in (list_filters or {}).items():
        out = out.where(flags.list_filter(F.col(column), bits, how))
    return out.where("not (sv_size = 0 and type_bits <> 8)") if drop_zero_size else out


def genomic_ends(final: DataFrame) -> DataFrame:
    """Two rows for each junction, one for each breakpoint."""
    return final.select("*", F.explode(F.array(F.struct(F.lit(1).alias("end"), F.col("node1").alias("node")), F.struct(F.lit(2).alias("end"), F.col("node2").alias("node")))).alias("e")).select("*", "e.end", "e.node").drop("e")


def samples_of(final: DataFrame, samples: DataFrame) -> DataFrame:
    """Junctions with the names of the samples in their mask; ``samples`` has 63 rows at most."""
    s = F.broadcast(samples.limit(63))  # a mask has no more bits
    hit = final.select("node1", "node2", "sample_bits").join(s, F.col("sample_bits").bitwiseAND(F.col("sample_bit")) > 0)
    return hit.groupBy("node1", "node2", "sample_bits").agg(F.array_join(F.sort_array(F.collect_set("sample_name")), ",").alias("sample_names"))


def expected_offsets(n: Column) -> Column:
    """Fixed probabilities of 0 to 7 shared bases at random breakpoints, times ``n``: P(k) = (k + 1) (3/4)**2 (1/4)**k."""
    return F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: (k + 1) * 0.5625 * F.pow(F.lit(0.25), k) * n)


#: Keys of the breakpoint tally.
TALLY = [
    "genome", "is_gap", "on_target", "in_gene", "in_target_gene", "target_gene", "jxn_type", "is_local_sv", "is_intergenome", "is_validated",
    "has_allowed_size", "has_disallowed_size", "has_passed_stem", "has_unpassed_stem", "has_passed_alns", "has_unpassed_alns", "has_passed_jxn", "has_unpassed_jxn",
]


def breakpoint_tally(final: DataFrame, genome: str) -> DataFrame:
    """Breakpoints by the 18 keys of ``TALLY``, with their shares of their genome's and of all, cut to 4 digits.

    Junctions seen twice, and all but translocations of up to 1000 bases, aren't tallied.  ``final``: chrom1, chrom2 (with the genome's
    suffix in composite ones), target1, target2 (null or empty: none), genes1, genes2 (``,a,b,``; ``,``: none), jxn_type, sv_size,
    is_intergenomic, n_observed, and the lists allowed_sizes, passed_stems, aln_flags, jxn_flags as comma-joined text.
    """
    trans = F.col("jxn_type") == "translocation"
    kept = final.where(((F.col("n_observed") == 1) | (F.col("n_observed") >= 3)) & (trans | (F.col("sv_size") > 1000)))
    chrom, target, genes = F.col("e.chrom"), F.coalesce("e.target", F.lit("")), F.col("e.genes")
    ends = F.explode(F.array(*(F.struct(*(F.col(f"{c}{i}").alias(c) for c in ("chrom", "target", "genes"))) for i in (1, 2)))).alias("e")
    has = lambda c, digits: F.col(c).rlike(f"[{digits}]")
    suffix = F.get(F.split(chrom, "_"), F.lit(1))
    keys = {
        "genome": F.coalesce(suffix, F.lit(genome)), "is_gap": (target == "") & (genes == ","), "on_target": target != "", "in_gene": genes != ",",
        "in_target_gene": (target != "") & F.contains(genes, F.concat(F.lit(","), target, F.lit(","))), "target_gene": F.when(target == "", "NA").otherwise(target), "jxn_type": F.col("jxn_type"),
        "is_local_sv": ~trans & (F.col("sv_size") < 1_000_000), "is_intergenome": F.col("is_intergenomic") != 0, "is_validated": F.col("n_observed") != 1,
        "has_allowed_size": has("allowed_sizes", "1"), "has_disallowed_size": has("allowed_sizes", "0"), "has_passed_stem": has("passed_stems", "1"), "has_unpassed_stem": has("passed_stems", "0"),
        "has_passed_alns": has("aln_flags", "0"), "has_unpassed_alns": has("aln_flags", "1-9"), "has_passed_jxn": has("jxn_flags", "0"), "has_unpassed_jxn": has("jxn_flags", "1-9"),
    }
    n = kept.select("*", ends).select(*(c.alias(k) for k, c in keys.items())).groupBy(*TALLY).agg(F.count("*").alias("n_bkpts"))
    share = lambda *by: F.floor(F.col("n_bkpts") / F.sum("n_bkpts").over(Window.partitionBy(*by)) * 10_000) / 10_000
    return n.withColumn("frac_genome", share("genome")).withColumn("frac_all", share(F.lit(1)))


def tally_summary(final: DataFrame) -> DataFrame:
    """One row of counts: junctions, validated ones, single translocations, between genomes, and by targets and genes of either or both ends."""
    on = [F.coalesce(F.col(f"target{i}"), F.lit("")) != "" for i in (1, 2)]
    gene = [F.col(f"genes{i}") != "," for i in (1, 2)]
    counts = {
        "n_junctions": F.lit(True), "n_three_or_more": F.col("n_observed") >= 3, "n_single_translocations": (F.col("n_observed") == 1) & (F.col("jxn_type") == "translocation"), "n_intergenome": F.col("is_intergenomic") != 0,
        "n_on_target_1": on[0] | on[1], "n_on_target_2": on[0] & on[1], "n_in_gene_1": gene[0] | gene[1], "n_in_gene_2": gene[0] & gene[1],
        "n_target_gene_1": (on[0] | on[1]) & (gene[0] | gene[1]), "n_target_gene_2": on[0] & on[1] & gene[0] & gene[1],
    }
    return final.agg(*(F.count_if(c).alias(n) for n, c in counts.items()))
