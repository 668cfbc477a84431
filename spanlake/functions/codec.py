"""Encodings as column functions: signed nodes, CIGAR, sequences, qualities, list strings, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NODE_BITS = 29
NODE_MASK = (1 << NODE_BITS) - 1

#: Genome names and the names they are filed under.
GENOME_NAMES = {"CHM13": "hs1", "GRCh38": "hg38", "GRCm39": "mm39"}
#: Junction types by bit.
JUNCTION_BITS = {"proper": 0, "deletion": 1, "duplication": 2, "inversion": 4, "translocation": 8}
JUNCTION_LABELS = {"deletion": "del", "duplication": "dup", "inversion": "inv", "translocation": "trans", "intergenome": "int-gen"}


def pack_node(chrom_index1: Column, pos1: Column, strand0: Column) -> Column:
    """Signed node: (chromosome << 29 | position), negative on the reverse strand."""
    node = F.shiftleft(chrom_index1.cast("bigint"), NODE_BITS) + pos1
    return F.when(strand0 == 1, -node).otherwise(node)


def node_chrom(node: Column) -> Column:
    return F.shiftright(F.abs(node), NODE_BITS)


def node_pos(node: Column) -> Column:
    return F.abs(node).bitwiseAND(F.lit(NODE_MASK).cast("bigint"))


def node_strand(node: Column) -> Column:
    return F.when(node < 0, 1).otherwise(0).cast("bigint")


def flip_node(node: Column) -> Column:
    """The same place on the other strand."""
    return -node


# CIGAR ---------------------------------------------------------------------------------------------------


def cigar_ops(cigar: Column) -> Column:
    """array<struct<n, op>> in the order of the string."""
    return F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1)), lambda x: F.struct(F.regexp_extract(x, r"^\d+", 0).cast("bigint").alias("n"), F.substring(x, -1, 1).alias("op")))


def _sum_ops(cigar: Column, ops: str) -> Column:
    return F.aggregate(cigar_ops(cigar), F.lit(0).cast("bigint"), lambda a, x: a + F.when(F.instr(F.lit(ops), x["op"]) > 0, x["n"]).otherwise(0))


def left_clip(cigar: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(cigar, r"^(\d+)[SH]", 1), F.lit("")).cast("bigint"), F.lit(0).cast("bigint"))


def right_clip(cigar: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(cigar, r"(\d+)[SH]$", 1), F.lit("")).cast("bigint"), F.lit(0).cast("bigint"))


def ref_span(cigar: Column) -> Column:
    """Reference bases that the alignment covers."""
    return _sum_ops(cigar, "MDN=X")


def aligned_size(cigar: Column) -> Column:
    """Query bases that are aligned (insertions included, clips not)."""
    return _sum_ops(cigar, "MI=X")


def query_start0(cigar: Column, strand0: Column) -> Column:
    """Start on the read in the order of sequencing."""
    return F.when(strand0 == 1, right_clip(cigar)).otherwise(left_clip(cigar))


def query_end1(cigar: Column, strand0: Column) -> Column:
    return query_start0(cigar, strand0) + aligned_size(cigar)


def reverse_cigar(cigar: Column) -> Column:
    return F.array_join(F.reverse(F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))), "")


# sequences and qualities ---------------------------------------------------------------------------------


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), "ACGTacgtRYKMBVDHrykmbvdh", "TGCAtgcaYRMKVBHDyrmkvbhd")


def phred(qual: Column) -> Column:
    """array<int> of qualities from their text (offset 33)."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def mean_quality(q: Column) -> Column:
    return F.aggregate(q, F.lit(0), lambda a, x: a + x) / F.size(q)


def median_quality(q: Column) -> Column:
    """Upper median."""
    return F.get(F.sort_array(q), F.floor(F.size(q) / 2).cast("int"))


def quantize_quality(q: Column, levels: list[int]) -> Column:
    """Each quality lowered to the highest of ``levels`` that isn't above it (else the lowest)."""
    def one(x):
        out = F.lit(min(levels))
        for level in sorted(levels):
            out = F.when(x >= level, level).otherwise(out)
        return out

    return F.transform(q, one)


def codec_v1(byte: Column) -> Column:
    """Kinetics byte -> frames: four segments of growing step (1, 2, 4, 8)."""
    return F.when(byte < 64, byte).when(byte < 128, 64 + (byte - 64) * 2).when(byte < 192, 192 + (byte - 128) * 4).otherwise(448 + (byte - 192) * 8)


def iupac_class(pattern: str) -> str:
    """Regular expression of a degenerate sequence."""
    codes = {"R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
    return "".join(f"[{codes[c]}]" if c in codes else c for c in pattern.upper())


# list strings --------------------------------------------------------------------------------------------


def to_flanked(a: Column) -> Column:
    """``,a,b,``"""
    return F.concat(F.lit(","), F.array_join(a.cast("array<string>"), ","), F.lit(","))


def to_terminated(a: Column) -> Column:
    """``a,b,``; empty for an empty list."""
    return F.when(F.size(a) > 0, F.concat(F.array_join(a.cast("array<string>"), ","), F.lit(","))).otherwise("")


def from_list_string(s: Column, kind: str = "string") -> Column:
    """Either list encoding -> array."""
    inner = F.regexp_replace(s, "^,|,$", "")
    return F.when(inner == "", F.array().cast(f"array<{kind}>")).otherwise(F.split(inner, ",").cast(f"array<{kind}>"))


# names and numbers ---------------------------------------------------------------------------------------


def parse_ccs_name(qname: Column) -> dict[str, Column]:
    """``movie/zmw/ccs[/strand]``."""
    parts = F.split(qname, "/")
    return {"movie": F.get(parts, F.lit(0)), "zmw": F.get(parts, F.lit(1)).cast("bigint"), "strand": F.get(parts, F.lit(3))}


def parse_legacy_name(qname: Column) -> dict[str, Column]:
    """``name:channel:trim5:trim3``."""
    parts = F.split(qname, ":")
    return {"name": F.get(parts, F.lit(0)), "channel": F.get(parts, F.lit(1)).cast("bigint"), "trim5": F.get(parts, F.lit(2)).cast("bigint"), "trim3": F.get(parts, F.lit(3)).cast("bigint")}


def merge_tag(comment: Column) -> Column:
    """``merged_a_b`` -> ``fm:Z:a,b``."""
    return F.regexp_replace(comment, r"merged_(\d+)_(\d+)", "fm:Z:$1,$2")


def genome_of(chrom: Column) -> Column:
    """Suffix of a composite genome's chromosome."""
    return F.substring_index(chrom, "_", -1)


def genome_name(name: Column) -> Column:
    out = name
    for k, v in GENOME_NAMES.items():
        out = F.when(name == k, v).otherwise(out)
    return out


def correction5(site_length: Column, offset: Column, blunt: Column) -> Column:
    """Bases between the two cut positions of a site; 0 for a blunt cutter."""
    return F.when(blunt, 0).otherwise(site_length - 2 * offset)


def allowed_sizes(min_selected: Column, cv: Column) -> tuple[Column, Column]:
    """(least, most) insert size of a size-selected library: least truncated, most twice it."""
    low = (min_selected / (1 + cv)).cast("int")
    return low, low * 2


def bin_floor(x: Column, size: int | float) -> Column:
    """Bin of ``x``, truncated toward zero, by its lower edge."""
    return (x / size).cast("bigint") * size


def junction_type(bits: Column, intergenomic: Column | None = None) -> Column:
    out = F.lit(None).cast("string")
    for name, bit in JUNCTION_BITS.items():
        out = F.when(bits == bit, name).otherwise(out)
    return out if intergenomic is None else F.when((bits == 8) & intergenomic, "intergenome").otherwise(out)


def chrom_stem(pos1: Column, rightward: Column, chrom_size: Column) -> Column:
    """Length of the chromosome on the kept side of a breakpoint."""
    return F.when(rightward, F.greatest(chrom_size - pos1, F.lit(0)) + 1).otherwise(pos1)


def variant_chrom_length(node1: Column, size1: Column, node2: Column, size2: Column, offset: Column) -> Column:
    """Length of the rearranged chromosome that a junction makes."""
    return chrom_stem(node_pos(node1), node1 < 0, size1) + chrom_stem(node_pos(node2), node2 >= 0, size2) + offset


def junction_sequence(seq: Column, end1: Column, offset: Column, flank: int) -> Column:
    """Bases around a junction: ``flank`` before, the inserted (or shared) bases in the middle, ``flank`` after."""
    left = F.greatest(end1 - flank, F.lit(0))
    return F.substring(seq, (left + 1).cast("int"), (end1 - left + F.abs(offset) + flank).cast("int"))


def query_on_reference(cigar: Column, seq: Column) -> Column:
    """The read's bases by reference position: ``-`` where they are deleted, ``+`` left of an insertion; clips are left out."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("q"))

    def step(a: Column, x: Column) -> Column:
        n, op, out, q = x["n"].cast("int"), x["op"], a["out"], a["q"]
        bases = F.substring(seq, (q + 1).cast("int"), n)
        grown = F.when(op.isin("D", "N"), F.concat(out, F.repeat(F.lit("-"), n))).when(op == "I", F.when(out == "", out).otherwise(F.concat(F.substring(out, F.lit(1), F.char_length(out) - 1), F.lit("+"))))
        grown = grown.when(op.isin("S", "H", "P"), out).otherwise(F.concat(out, bases))
        return F.struct(grown.alias("out"), (q + F.when(op.isin("D", "N", "H", "P"), 0).otherwise(n)).cast("bigint").alias("q"))

    return F.aggregate(cigar_ops(cigar), start, step, lambda a: a["out"])


#: Code of two different bases.
PAIR_CODES = {"AG": "R", "CT": "Y", "CG": "S", "AT": "W", "GT": "K", "AC": "M"}


def paired_code(a: Column, b: Column) -> Column:
    """IUPAC code of two paired bases or codes: the base both are, the code of two bases, a code that holds the other base, else N.

    A pair of two codes, or of a code and a base that it doesn't hold, has none (null).
    """
    out = F.when((a == "N") | (b == "N"), "N").when((a == b) & a.isin(*"ACGTRYSWKM"), a)
    for bases, code in PAIR_CODES.items():
        x, y = bases
        out = out.when(((a == x) & (b == y)) | ((a == y) & (b == x)), code)
        out = out.when(((a == code) & b.isin(x, y)) | ((b == code) & a.isin(x, y)), code)
    return out


def log10_size(size: Column, is_translocation: Column, at: float = 9.25) -> Column:
    """Size for a plot on a log scale; translocations have a fixed place."""
    return F.when(is_translocation, F.lit(at)).otherwise(F.log10(size))


def compress_integer(x: Column) -> Column:
    """Three significant digits (of whole numbers, half up) with K, M or B."""
    scale = F.pow(F.lit(10.0), F.floor(F.log10(x)) - 2).cast("bigint")
    kept = F.floor((x + scale / 2) / scale) * scale
    short = lambda unit: F.regexp_replace(F.format_string("%.2f", kept / unit), r"\.?0+$", "")
    return (
        F.when(x < 1000, x.cast("bigint").cast("string")).when(x < 1_000_000, F.concat(short(1e3), F.lit("K")))
        .when(x < 1_000_000_000, F.concat(short(1e6), F.lit("M"))).otherwise(F.concat(short(1e9), F.lit("B")))
    )


def commify(x: Column) -> Column:
    return F.format_number(x, 0)


def round_count(x: Column, scalar: int = 1000) -> Column:
    """Rounded half up at 1 / ``scalar``."""
    return F.floor(x * scalar + 0.5) / scalar
