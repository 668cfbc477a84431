"""Operators over the ordered alignments of each read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import flags
from ..functions.codec import pack_node

LOOK_BACK = (Window.unboundedPreceding, Window.currentRow)


def along_read():
    return Window.partitionBy("qname").orderBy("aln_i")


def order_alignments(alignments: DataFrame, by: str = "query_start0", ties: tuple[str, ...] = ()) -> DataFrame:
    """Add ``aln_i``, the place of each alignment on its read."""
    return alignments.withColumn("aln_i", (F.row_number().over(Window.partitionBy("qname").orderBy(by, *ties)) - 1).cast("bigint"))


def adjacent_pairs(alignments: DataFrame, columns: tuple[str, ...] = ("chrom_index1", "pos1", "strand0", "ref_span", "mapq")) -> DataFrame:
    """Each alignment with the next one of its read as ``next_*``: the read's junctions."""
    out = alignments
    for c in columns:
        out = out.withColumn(f"next_{c}", F.lead(c).over(along_read()))
    return out.where(F.col("next_" + columns[0]).isNotNull())


def ordered_junctions(alignments: DataFrame) -> DataFrame:
    """Junctions of all reads: qname, aln_i, node1 <= node2, jxn_offset, min_mapq, was_flipped."""
    node = pack_node(F.col("chrom_index1"), F.col("pos1"), F.col("strand0"))
    a = alignments.withColumn("_a", node)
    a = a.withColumn("_b", F.lead("_a").over(along_read())).withColumn("_q", F.lead("mapq").over(along_read())).where("_b is not null")
    return a.select(
        "qname", "aln_i", F.least("_a", "_b").alias("node1"), F.greatest("_a", "_b").alias("node2"), "jxn_offset",
        F.least("mapq", "_q").alias("min_mapq"), F.when(F.col("_a") > F.col("_b"), 1).otherwise(0).cast("bigint").alias("was_flipped"),
    )


def first_and_last(alignments: DataFrame) -> DataFrame:
    """One row for each read: its outer alignments and their number."""
    place = F.struct("aln_i", "chrom_index1", "pos1", "strand0")
    return (
        alignments.groupBy("qname").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count("*").alias("n_alns"))
        .select("qname", "n_alns", *(F.col(f"{s}.{c}").alias(f"{c}_{e}") for s, e in (("a", "first"), ("b", "last")) for c in ("chrom_index1", "pos1", "strand0")))
    )


def block_numbers(alignments: DataFrame, passes: str) -> DataFrame:
    """``block``: 1, and 1 more after each junction that passes; ``passes`` is null on a read's first alignment."""
    return alignments.withColumn("block", F.lit(1) + F.sum(F.coalesce(F.col(passes).cast("bigint"), F.lit(0))).over(along_read().rowsBetween(*LOOK_BACK)))


def flank_types(alignments: DataFrame, kind: str = "jxn_type") -> DataFrame:
    """``jxn_types``: types of the junctions on either side of an alignment, OR-ed (``kind``: of the one after it)."""
    before = F.coalesce(F.lag(kind).over(along_read()), F.lit(0))
    return alignments.withColumn("jxn_types", before.bitwiseOR(F.coalesce(F.col(kind), F.lit(0))))


def pair_failures(alignments: DataFrame, least: int, mode: str = "wrap") -> DataFrame:
    """All pairs i < j of a read's alignments that fail the traversal test: qname, i, j."""
    a, b = alignments.alias("a"), alignments.alias("b")
    pairs = a.join(b, (F.col("a.qname") == F.col("b.qname")) & (F.col("a.aln_i") < F.col("b.aln_i")))
    fails = flags.traversal_fails(
        F.col("a.chrom_index1"), F.col("a.strand0"), F.col("b.chrom_index1"), F.col("b.strand0"),
        F.when(F.col("a.strand0") == 1, F.col("a.pos1") - F.col("b.pos1")).otherwise(F.col("b.pos1") - F.col("a.pos1")), F.col("b.query_start0") - F.col("a.query_start0"), least, mode,
    )
    return pairs.select(F.col("a.qname").alias("qname"), F.col("a.aln_i").alias("i"), F.col("b.aln_i").alias("j"), fails.alias("fails"))


def failed_junctions(pairs: DataFrame) -> DataFrame:
    """Junctions (before alignment ``aln_i``) that a failing pair (i, j) spans: i + 1 to j."""
    return pairs.where("fails").select("qname", F.explode(F.sequence(F.col("i") + 1, F.col("j"))).alias("aln_i")).distinct()


def mate_nodes(reads: DataFrame) -> DataFrame:
    """Mates (qname with /1 or /2) exchange their outer 5' nodes: ``paired_node``; null without a mate."""
    base, mate = F.regexp_replace("qname", "/[12]$", ""), F.regexp_extract("qname", "/([12])$", 1)
    w = Window.partitionBy("_base")
    other = F.when(F.col("_mate") == "1", F.max(F.when(F.col("_mate") == "2", F.col("node5"))).over(w)).when(F.col("_mate") == "2", F.max(F.when(F.col("_mate") == "1", F.col("node5"))).over(w))
    return reads.withColumn("_base", base).withColumn("_mate", mate).withColumn("paired_node", other).drop("_base", "_mate")


def read_paths(alignments: DataFrame) -> DataFrame:
    """One row for each read with its alignments' values as ordered lists."""
    items = F.array_sort(F.collect_list(F.struct("aln_i", "chrom_index1", "pos1", "strand0", "mapq")))
    return alignments.groupBy("qname").agg(items.alias("a")).select(
        "qname", *(F.col("a").getField(c).alias(f"{c}s") for c in ("chrom_index1", "pos1", "strand0", "mapq"))
    )


def usable_for_svs(alignments: DataFrame, most_chrom: int, failed: str = "read_failure") -> DataFrame:
    """Alignments of reads without a failure whose alignments are all on canonical chromosomes."""
    fine = alignments.groupBy("qname").agg(F.max(failed).alias("_f"), F.bool_and((F.col("chrom_index1") >= 1) & (F.col("chrom_index1") <= most_chrom)).alias("_c"))
    return alignments.join(fine.where("_f = 0 and _c").select("qname"), "qname", "left_semi")


def deduplicated_coverage(alignments: DataFrame) -> DataFrame:
    """Alignments and bases by sample, each (span, sample, channel, aln_i) counted once."""
    once = alignments.groupBy("chrom_index1", "pos1", "ref_span", "strand0", "sample_bit", "channel", "aln_i").agg(F.count("*").alias("n"))
    return once.groupBy("sample_bit").agg(F.count("*").alias("n_alns"), F.sum("n").alias("n_alns_before"), F.sum("ref_span").alias("n_bases"))


def endpoints(alignments: DataFrame, min_mapq: int = 0, clip_tolerance: int = 1_000_000, ont_adapter: int | None = None) -> DataFrame:
    """Tally of site positions that read ends suggest: chrom_index1, site_pos1 (1 at least), n_observed.

    Every read gives its first alignment's 5' end, and its last one's 3' end where ``informative3`` holds.  A site is the first
    base after the cut, so ends on the right side of an alignment count one further.  Clipped bases (clip5, clip3) move the
    end outward; low mapq or more clipping than tolerated drops it.  With ``ont_adapter``, a 5' end whose adapter wasn't trimmed
    (``trim5`` 0) moves back by that many bases.
    """
    w = Window.partitionBy("qname")
    rows = alignments.withColumn("_last", F.max("aln_i").over(w))
    right = F.col("pos1") + F.col("ref_span")
    forward = F.col("strand0") == 0

    def side(end: int, where) -> DataFrame:
        leftward = forward if end == 5 else ~forward
        outward = F.when(leftward, -1).otherwise(1)
        clip = F.col(f"clip{end}")
        pos = F.greatest(F.when(leftward, F.col("pos1")).otherwise(right) + outward * clip, F.lit(1).cast("bigint"))
        if ont_adapter and end == 5:
            pos = F.when(F.col("trim5") == 0, F.greatest(pos - outward * ont_adapter, F.lit(1).cast("bigint"))).otherwise(pos)
        return rows.where(where & (F.col("mapq") >= min_mapq) & (clip <= clip_tolerance)).select("chrom_index1", pos.cast("bigint").alias("site_pos1"))

    both = side(5, F.col("aln_i") == 0).unionByName(side(3, (F.col("aln_i") == F.col("_last")) & F.col("informative3")))
    return both.groupBy("chrom_index1", "site_pos1").agg(F.count("*").alias("n_observed"))


def alignment_segments(alignments: DataFrame, expecting_sites: bool = False) -> DataFrame:
    """Fragment segments: 5' and 3' positions, projected 3' position, number of junctions of the read.

    With restriction sites at read ends (``site5_pos1``, ``proj3_pos1``) the outer positions are the sites', less 1 where the
    site's first base lies beyond the fragment.
    """
    last = F.max("aln_i").over(Window.partitionBy("qname"))
    right = F.col("pos1") + F.col("ref_span") - 1
    reverse = F.col("strand0") == 1
    pos5, pos3 = F.when(reverse, right).otherwise(F.col("pos1")), F.when(reverse, F.col("pos1")).otherwise(right)
    rows = alignments.withColumn("n_jxns", last)
    proj3 = pos3
    if expecting_sites:
        pos5 = F.when(F.col("aln_i") == 0, F.col("site5_pos1") - F.col("strand0")).otherwise(pos5)
        proj3 = F.when(F.col("aln_i") == F.col("n_jxns"), F.col("proj3_pos1") - (1 - F.col("strand0"))).otherwise(pos3)
    return rows.select("qname", "aln_i", "chrom_index1", pos5.alias("ref_pos5"), pos3.alias("ref_pos3"), proj3.alias("ref_proj3"), "strand0", "n_jxns")
