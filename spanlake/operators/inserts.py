"""Insert and stem sizes, their histograms and distributions, outer nodes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codec import node_chrom, node_pos


def insert_size(n_alns, is_pair, node5, paired_node, seq_length, trimmed, aligned, low: int, high: int, selected: bool) -> Column:
    """Signed insert size of a read: negative unless it lies in [low, high] (size-selected libraries only).

    An unmerged pair's size is the distance of its outer nodes if both mates lie on one chromosome and opposite
    strands, not over 4 times ``high``, and the read has no junction; else it is unknown (0, or 1 if size-selected).
    """
    unknown = F.lit(int(selected)).cast("bigint")
    span = F.abs(node_pos(paired_node) - node_pos(node5))
    paired = F.when((n_alns == 1) & (node_chrom(node5) == node_chrom(paired_node)) & ((node5 < 0) != (paired_node < 0)) & (span <= 4 * high), span).otherwise(unknown)
    size = F.when(is_pair, paired).when(seq_length > 1, seq_length - trimmed).otherwise(aligned)
    return F.when((size >= low) & (size <= high), size).otherwise(-size) if selected else size


def stem_lengths(alignments: DataFrame, low: int, selected: bool = True) -> DataFrame:
    """Add ``stem5`` and ``stem3``: read bases from an outer end to the alignment's inner end; negative beyond ``low``.

    Needs query_start0, query_end1 and is_end_to_end; a read that doesn't reach the insert's end has stem3 -1.
    """
    w = Window.partitionBy("qname")
    first = F.min_by("query_start0", "aln_i").over(w)
    last = F.max_by("query_end1", "aln_i").over(w)
    signed = (lambda x: F.when(x <= low, x).otherwise(-x)) if selected else (lambda x: x)
    return alignments.withColumn("stem5", signed(F.col("query_end1") - first)).withColumn("stem3", F.when(F.col("is_end_to_end"), signed(last - F.col("query_start0"))).otherwise(-1))


def histogram(df: DataFrame, keys: list[str], value: Column, size: int) -> DataFrame:
    """Counts by bin; bins are truncated toward zero."""
    return df.groupBy(*keys, ((value / size).cast("bigint") * size).alias("size_bin")).agg(F.count("*").alias("n_observed"))


def frequencies(counts: DataFrame, keys: list[str], least: int = 50) -> DataFrame:
    """Molar and mass frequency of each bin; groups of fewer than ``least`` reads go."""
    w = Window.partitionBy(*keys)
    total, mass = F.sum("n_observed").over(w), F.sum(F.col("n_observed") * F.col("size_bin")).over(w)
    out = counts.withColumn("_t", total).where(F.col("_t") >= least)
    return out.withColumn("molar", F.col("n_observed") / F.col("_t")).withColumn("mass", F.col("n_observed") * F.col("size_bin") / mass).drop("_t")


def artifact_model(counts: DataFrame, bin_size: int) -> DataFrame:
    """Distribution of the summed sizes of two independent fragments, from a size histogram: size_bin, p.

    One convolution, exact; sums below 0 go.  The histogram has a row for each size bin, whatever the reads, and goes to one task.
    """
    def run(batches):
        rows = pd.concat(list(batches))
        if not len(rows):
            return
        low = int(rows["size_bin"].min())
        p = np.bincount(rows["size_bin"] - low, rows["n_observed"] / rows["n_observed"].sum())
        total = np.convolve(p, p)
        at = np.flatnonzero(total > 0)
        size = at + 2 * low
        out = pd.DataFrame({"size_bin": size // bin_size * bin_size, "p": total[at]})[size >= 0]
        yield out.groupby("size_bin", as_index=False)["p"].sum()

    return counts.select("size_bin", "n_observed").coalesce(1).mapInPandas(run, "size_bin bigint, p double")


def outer_nodes(reads: DataFrame) -> DataFrame:
    """Canonical pair of a read's outer nodes: least first, both flipped if they are swapped; ``was_flipped``."""
    n3 = F.when(F.col("paired_node").isNotNull(), -F.col("paired_node")).otherwise(F.col("node3"))
    swap = F.abs(F.col("node5")) > F.abs(n3)
    return reads.withColumn("outer1", F.when(swap, -n3).otherwise(F.col("node5"))).withColumn("outer2", F.when(swap, -F.col("node5")).otherwise(n3)).withColumn("was_flipped", swap.cast("bigint"))


def middle_model(counts: DataFrame, bin_size: int, least: int = 10) -> DataFrame:
    """Distribution of the summed sizes of two pieces, each drawn evenly from ``least`` to X - ``least`` bases of a fragment of X: size_bin, p.

    Exact: the piece's distribution comes from running sums over the sizes, and the sum of two from one convolution.  The histogram has a
    row for each size bin, whatever the reads, and goes to one task.
    """
    def run(batches):
        rows = pd.concat(list(batches))
        rows = rows[rows["size_bin"] >= 2 * least]
        if not len(rows):
            return
        p = rows["n_observed"] / rows["n_observed"].sum()
        edge = np.zeros(int(rows["size_bin"].max()) + 2)
        for size, share in zip(rows["size_bin"], p / (rows["size_bin"] - 2 * least + 1)):
            edge[least] += share
            edge[int(size) - least + 1] -= share
        piece = np.cumsum(edge)
        total = np.convolve(piece, piece)
        binned = np.add.reduceat(total, np.arange(0, len(total), bin_size))
        at = np.flatnonzero(binned > 1e-15)
        yield pd.DataFrame({"size_bin": at * bin_size, "p": binned[at]})

    return counts.select("size_bin", "n_observed").coalesce(1).mapInPandas(run, "size_bin bigint, p double")
