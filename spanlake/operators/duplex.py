"""Duplex reads: both strands of a molecule paired and merged, and kinetics by base context."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codec import reverse_complement
from .wavefront import global_paths


def pair_strands(strands: DataFrame) -> DataFrame:
    """One row for each (movie, zmw): fields of strand 0 and 1 as ``fwd`` and ``rev``, and ``outcome``.

    Outcomes: merged-able pairs are ``pair``; a strand without its partner is an ``orphan``; two unusable ones
    are ``both_unusable``.  Needs movie, zmw, strand, usable, seq, qual.
    """
    item = F.struct("seq", "qual", "usable")
    out = strands.groupBy("movie", "zmw").agg(F.max(F.when(F.col("strand") == 0, item)).alias("fwd"), F.max(F.when(F.col("strand") == 1, item)).alias("rev"))
    ok = lambda c: F.coalesce(F.col(f"{c}.usable"), F.lit(False))
    outcome = F.when(F.col("fwd").isNull() | F.col("rev").isNull(), "orphan").when(ok("fwd") & ok("rev"), "pair").when(ok("fwd") | ok("rev"), "one_usable").otherwise("both_unusable")
    return out.withColumn("outcome", outcome)


#: Bits of the differences between strands.
CLIP, UNALIGNED, BOTH_INDEL, INDEL, INDEL_NEITHER, BOTH_SUBS, SUBS, SUBS_NEITHER = (1 << i for i in range(8))
MASKED = "N"


def merge_strands(a: str, qa: list[int], b: str, qb: list[int], ref: str | None = None) -> tuple[str, list[int], str]:
    """(sequence, qualities, dd tag) of one pair; see ``merge_many``."""
    return merge_many([a], [qa], [b], [qb], [ref])[0][:3]


def merge_many(a: list[str], qa: list, b: list[str], qb: list, refs: list[str | None]) -> list[tuple[str, list[int], str, int]]:
    """(sequence, qualities, dd tag, bits of differences) of pairs of strands in one orientation, aligned together."""
    paths = global_paths(a, b)
    known = [k for k, r in enumerate(refs) if r]
    on_ref = dict(zip(known, global_paths([refs[k] for k in known], [a[k] for k in known])))
    return [merged(a[k], qa[k], b[k], qb[k], refs[k], path, on_ref.get(k)) for k, path in enumerate(paths)]


def merged(a: str, qa: list[int], b: str, qb: list[int], ref: str | None, path: tuple, ref_path: tuple | None) -> tuple[str, list[int], str, int]:
    """Two aligned strands as one, with the reference as judge where there is one.

    Equal bases stay, with the higher quality: ``:`` without a reference, ``=`` and ``*`` where they are and aren't its bases, ``^`` where it has none.
    A substitution takes the reference's base if one strand has it (``>`` the first, ``<`` the second); an indel takes the reference's side: ``-`` keeps
    a base that one strand lacks, ``+`` drops one that the other has no place for.  Anything else is masked: ``?`` and ``!`` without a reference,
    ``&`` and ``#`` where neither strand has its bases.
    """
    at_ref, skipped, last = {}, {}, -1
    if ref_path:
        for r, i in zip(*(x.tolist() for x in ref_path)):
            if i < 0:
                skipped.setdefault(last, []).append(ref[r])  # reference bases that strand a lacks, by the place before
                continue
            last = i
            if r >= 0:
                at_ref[i] = ref[r]
    seq, qual, ops, bits, before = [], [], [], 0, -1

    def add(op: str, value: str | int, base: str = "", q: int = 0):
        if base:
            seq.append(base)
            qual.append(q)
        if op in ":=^" and ops and ops[-1][0] == op:
            ops[-1] = (op, ops[-1][1] + 1)
        else:
            ops.append((op, value))

    for i, j in zip(*(x.tolist() for x in path)):
        before = i if i >= 0 else before
        if i >= 0 and j >= 0 and a[i] == b[j]:
            r, best = at_ref.get(i), max(qa[i], qb[j])
            if not ref:
                add(":", 1, a[i], best)
            elif r is None:
                bits |= UNALIGNED
                add("^", 1, a[i], best)
            elif r == a[i]:
                add("=", 1, a[i], best)
            else:
                bits |= BOTH_SUBS
                add("*", a[i] + r, a[i], best)
        elif i >= 0 and j >= 0:
            r, both = at_ref.get(i), a[i] + b[j]
            bits |= SUBS
            if r == a[i]:
                add(">", both, a[i], qa[i])
            elif r is not None and r == b[j]:
                add("<", both, b[j], qb[j])
            else:
                bits |= SUBS_NEITHER if r is not None else 0
                add("?" if r is None else "&", both, MASKED)
        else:
            bits |= INDEL
            base, q = (a[i], qa[i]) if j < 0 else (b[j], qb[j])
            lacking = skipped.get(before, []) if j >= 0 else []
            if not ref:
                add("!", base, MASKED)
            elif at_ref.get(i) == base if j < 0 else lacking[:1] == [base]:
                add("-", base, base, q)
                lacking[:1] = []
            elif (i not in at_ref) if j < 0 else not lacking:
                add("+", base)
            else:
                bits |= INDEL_NEITHER
                add("#", base, MASKED)
    return "".join(seq), qual, "".join(f"{o}{v}" for o, v in ops), bits


def merge_pairs(pairs: DataFrame) -> DataFrame:
    """Merge ``pairs`` of outcome ``pair`` (others are dropped): movie, zmw, seq, qual, dt (bits of differences), dd.  ``ref`` is optional."""
    rows = pairs.where("outcome = 'pair'").select(
        "movie", "zmw", F.col("fwd.seq").alias("a"), F.col("fwd.qual").alias("qa"), reverse_complement(F.col("rev.seq")).alias("b"), F.reverse("rev.qual").alias("qb"),
        (F.col("ref") if "ref" in pairs.columns else F.lit(None).cast("string")).alias("ref"),
    )

    def run(batches):
        for pdf in batches:
            out = merge_many(pdf["a"].tolist(), [list(q) for q in pdf["qa"]], pdf["b"].tolist(), [list(q) for q in pdf["qb"]], [r if isinstance(r, str) else None for r in pdf["ref"]])
            yield pd.DataFrame({"movie": pdf["movie"], "zmw": pdf["zmw"], "seq": [o[0] for o in out], "qual": [o[1] for o in out], "dt": [o[3] for o in out], "dd": [o[2] for o in out]})

    return rows.mapInPandas(run, "movie string, zmw bigint, seq string, qual array<int>, dt int, dd string")


#: Bases of a piece.  Places in a string are counted from its start, so contexts are cut from short pieces.
PIECE = 32


def kinetics_contexts(reads: DataFrame) -> DataFrame:
    """Three-base contexts with their kinetics: base_context, ipd_before, pulse_width, ipd_after.

    ``reads(qname, seq, ip, pw)``; the first and last base have no context, so reads of under three have none.
    """
    pieces = F.regexp_extract_all("seq", F.lit(f"(?s)(?=(.{{3,{PIECE + 2}}})).{{1,{PIECE}}}"), F.lit(1))
    rows = reads.select("qname", "ip", "pw", F.posexplode(pieces).alias("_k", "_piece"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.char_length("_piece") - 2)).alias("_j")).withColumn("i", F.col("_k") * PIECE + F.col("_j"))
    return rows.select(
        "qname", "i", F.expr("substring(_piece, _j, 3)").alias("base_context"), F.get("ip", F.col("i")).alias("ipd_before"),
        F.get("pw", F.col("i")).alias("pulse_width"), F.get("ip", F.col("i") + 1).alias("ipd_after"),
    )


def capped(contexts: DataFrame, n: int = 1_000_000) -> DataFrame:
    """The first ``n`` rows of each context, in order of read and place."""
    w = Window.partitionBy("base_context").orderBy("qname", "i")
    return contexts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")
