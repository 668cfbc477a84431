"""Flags, cascades and labels as column functions.  In a cascade the first failure is the only one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of junction failures.
TRAVERSAL, NONCANONICAL, FOLDBACK, LOW_QUALITY, ADAPTER, SITE_MATCH, STEM_LENGTH = 1, 2, 4, 8, 16, 32, 64
PRE_CHIMERIC, CHIMERIC = TRAVERSAL | NONCANONICAL | FOLDBACK, LOW_QUALITY | ADAPTER | SITE_MATCH | STEM_LENGTH


def cascade(*tests: tuple[Column, object], default=0) -> Column:
    out = None
    for test, value in tests:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(default)


def read_outcome(unmapped: Column, noncanonical: Column, off_target: Column) -> Column:
    return cascade((unmapped, "unmapped"), (noncanonical, "noncanonical"), (off_target, "off_target"), default="usable")


def alignment_failure(mapq: Column, divergence: Column, has_junction: Column, span: Column, quality: Column, min_mapq, max_divergence, min_span, min_quality) -> Column:
    """mapq 1, divergence 2; in reads with a junction also span 4 and quality 8 (only if a least quality is set)."""
    low_quality = has_junction & (quality < min_quality) if min_quality > 0 else F.lit(False)
    return cascade((mapq < min_mapq, 1), (divergence > max_divergence, 2), (has_junction & (span < min_span), 4), (low_quality, 8))


def traversal_fails(chrom1, strand1, chrom2, strand2, ref_delta: Column, query_delta: Column, least: int, mode: str = "wrap") -> Column:
    """The pair advances as much on the reference as on the read: no junction.

    ``wrap`` takes both advances modulo 2**32, as unsigned arithmetic does; ``signed`` doesn't.
    """
    if mode == "wrap":
        ref_delta, query_delta = (F.pmod(x, F.lit(1 << 32)) for x in (ref_delta, query_delta))
    elif mode != "signed":
        raise ValueError(f"traversal mode {mode!r}")
    return (chrom1 == chrom2) & (strand1 == strand2) & (F.abs(ref_delta - query_delta) < least)


def is_foldback(chrom1, start1, end1, strand1, chrom2, start2, end2, strand2) -> Column:
    return (chrom1 == chrom2) & (strand1 != strand2) & (start1 <= end2) & (start2 <= end1)


def junction_failure(traversal: Column, noncanonical: Column, foldback: Column, low_quality: Column, adapter: Column) -> Column:
    return cascade((traversal, TRAVERSAL), (noncanonical, NONCANONICAL), (foldback, FOLDBACK), (low_quality, LOW_QUALITY), (adapter, ADAPTER))


def low_window(q: Column, window: int, least: int, offset: Column, min_adapter: int) -> Column:
    """A window of inserted qualities whose sum is below ``least`` each; for long enough insertions only."""
    sums = F.transform(F.sequence(F.lit(1), F.size(q) - window + 1), lambda i: F.aggregate(F.slice(q, i, window), F.lit(0), lambda a, x: a + x))
    return F.when((offset >= min_adapter) & (offset > window) & (F.size(q) >= window), F.exists(sums, lambda s: s < least * window)).otherwise(False)


def low_median(q: Column, window: int, least: int, offset: Column) -> Column:
    return F.when((offset > window) & (F.size(q) > 0), F.get(F.sort_array(q), F.floor(F.size(q) / 2).cast("int")) < least).otherwise(False)


def read_failure(unmapped, off_target, no_site, clipped, far_site) -> Column:
    return cascade((unmapped, 1), (off_target, 2), (no_site, 4), (clipped, 8), (far_site, 16))


def end_to_end(read_ends: Column, insert_ends: Column, on_site3: Column) -> Column:
    """insert << 1 | read; a 3' end on a site makes both."""
    return F.when(on_site3, 3).otherwise(F.shiftleft(insert_ends.cast("int"), 1).bitwiseOR(read_ends.cast("int")))


def stem_site_failure(stem5: Column, stem3: Column, distance3: Column, distance5: Column, reject: int) -> Column:
    """Flags to add: 64 if neither stem passes, 32 if either breakpoint is within ``reject`` of a site."""
    stem = F.when((stem5 > 0) | (stem3 > 0), 0).otherwise(STEM_LENGTH)
    site = F.when((F.abs(distance3) <= reject) | (F.abs(distance5) <= reject), SITE_MATCH).otherwise(0)
    return stem.bitwiseOR(site)


def is_pre_chimeric(flag: Column) -> Column:
    return flag.bitwiseAND(PRE_CHIMERIC) != 0


def is_chimeric(flag: Column) -> Column:
    return flag.bitwiseAND(CHIMERIC) != 0


def strand_usability(fail_bits: Column, passes: Column, length: Column, median: Column, min_passes=3, min_length=250, max_length=25_000, min_median=35) -> Column:
    return cascade((fail_bits != 0, "fail_bits"), (passes < min_passes, "passes"), (length < min_length, "short"), (length > max_length, "long"), (median < min_median, "quality"), default="usable")


def passes_read_quality(q: Column, average: float, low: int, most_low: float, least_length: int) -> Column:
    n = F.size(q)
    mean = F.aggregate(q, F.lit(0), lambda a, x: a + x) / n
    return (n >= least_length) & (mean >= average) & (F.size(F.filter(q, lambda x: x < low)) / n <= most_low)


def list_filter(flags: Column, bits: int, how: str) -> Column:
    """``any_pass``, ``all_pass``: no bit is set; ``any_fail``, ``all_fail``: every bit is."""
    test = {"pass": lambda x: x.bitwiseAND(bits) == 0, "fail": lambda x: x.bitwiseAND(bits) == bits}[how.partition("_")[2]]
    return (F.exists if how.startswith("any") else F.forall)(flags, test)


def junction_class(intergenomic: Column, n_dedup: Column, type_bits: Column, size: Column) -> Column:
    return cascade(
        (intergenomic, "intergenome"), ((n_dedup == 1) & ((type_bits == 8) | (size > 1_000_000)), "artifact"),
        (n_dedup >= 3, "validated"), (n_dedup == 2, "unexpected2"), default="unexpected1",
    )


def junction_stratum(n_dedup: Column) -> Column:
    return cascade((n_dedup >= 3, "validated"), (n_dedup == 2, "unexpected2"), default="unexpected1")


def offset_label(offset: Column) -> Column:
    return cascade((offset > 0, "insertion"), (offset < 0, "microhomology"), default="blunt")


def chimericity_label(any_chimeric: Column) -> Column:
    return F.when(any_chimeric == 0, "had no chimeric").otherwise("had >=1 chimeric")


def genomicity_label(intergenomic: Column) -> Column:
    return F.when(intergenomic == 0, "single genome").otherwise("intergenomic")


def coverage_label(n_dedup: Column, n: Column) -> Column:
    """The second test reads the count before deduplication, as the reports do."""
    return cascade((n_dedup == 1, "singleton"), (n == 2, "two instances"), default=">=3 instances")


def variant_class(n_ref: Column, alt: Column) -> Column:
    d = F.coalesce(F.char_length(alt), F.lit(0)) - n_ref
    return cascade((d == 0, "snv"), (d > 0, "insertion"), default="deletion")


def target_class(end5: Column, end3: Column) -> Column:
    """Class of two ends, each T (target), A (adjacent) or - (neither)."""
    pair = F.concat(end5, end3)
    return F.when(pair.isin("TA", "AT"), "TA").when(pair.isin("T-", "-T"), "T-").when(pair.isin("A-", "-A"), "A-").otherwise(pair)


#: Number of each target class.
TARGET_NUMBERS = {"--": 0, "TT": 1, "TA": 2, "T-": 3, "AA": 4, "A-": 5}


def target_number(name: Column) -> Column:
    """Number of a target class."""
    return F.element_at(F.create_map(*(F.lit(x) for pair in TARGET_NUMBERS.items() for x in pair)), name)


def packed_target(target_index: Column, class5: Column, class3: Column, own: Column) -> Column:
    """Target of an alignment and the classes of its read's 5' and 3' alignments and its own, in one number."""
    return F.shiftleft(target_index, 9) + F.shiftleft(target_number(class5), 6) + F.shiftleft(target_number(class3), 3) + target_number(own)
