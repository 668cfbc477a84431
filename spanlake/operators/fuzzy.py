"""Grouping by gap tolerance, and the fuzzy grouping of junctions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codec import node_chrom, variant_chrom_length
from .blocks import number_groups

LOOK_BACK = (Window.unboundedPreceding, Window.currentRow)


def apart_on_one_strand(a: Column, b: Column) -> Column:
    """Distance of two signed nodes' places."""
    return F.abs(F.abs(a) - F.abs(b))


def gap_groups(df: DataFrame, by: list[str], value: Column, gap: int, out: str, apart: Callable[[Column, Column], Column] = lambda a, b: a - b) -> DataFrame:
    """Single linkage in one dimension: ``out`` numbers the groups of values of which none is more than ``gap`` from the one before.

    Numbers are found on the distinct values, in blocks of them, and joined back, so that neither a
    crowded value nor a long chromosome makes a large task.  Null values are one group of their own, 0.
    """
    rows = df.withColumn("_value", value)
    values = rows.select(*by, "_value").where("_value is not null").distinct()
    numbered = number_groups(values, by, "_value", out, lambda v, before: apart(v, before) > gap)
    return rows.join(numbered, [*by, "_value"], "left").withColumn(out, F.coalesce(out, F.lit(0))).select(*(c for c in df.columns if c != out), out)


def local_groups(df: DataFrame, by: list[str], value: Column, gap: int, out: str, apart: Callable[[Column, Column], Column] = lambda a, b: a - b) -> DataFrame:
    """``gap_groups`` within groups that are small places already, in one window."""
    w = Window.partitionBy(*by).orderBy("_value")
    new = F.when(apart(F.col("_value"), F.lag("_value").over(w)) <= gap, 0).otherwise(1)
    return df.withColumn("_value", value).withColumn("_new", new).withColumn(out, F.sum("_new").over(w.rowsBetween(*LOOK_BACK))).drop("_new", "_value")


def run_ids(df: DataFrame, by: list, order: list, value: str, out: str = "run") -> DataFrame:
    """Number runs of equal consecutive values."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_new", F.when(F.col(value).eqNullSafe(F.lag(value).over(w)), 0).otherwise(1)).withColumn(out, F.sum("_new").over(w.rowsBetween(*LOOK_BACK))).drop("_new")


def fuzzy_junctions(junctions: DataFrame, chroms: DataFrame, distance: int = 20, length: int = 5) -> DataFrame:
    """Group ``junctions(node1, node2, jxn_offset, ...)`` in three nested passes: ``sc``, ``i1``, ``i2``, ``i3``.

    Pass 1: node 1 within a strand and chromosome, gaps up to ``distance``.  Pass 2: node 2 within those groups.
    Pass 3: length of the rearranged chromosome within those, gaps up to ``length``.  Opposite strands are
    never chained.
    """
    sc = F.signum("node1").cast("bigint") * node_chrom(F.col("node1"))
    out = junctions.withColumn("sc", sc)
    out = gap_groups(out, ["sc"], F.col("node1"), distance, "i1", apart_on_one_strand)
    out = local_groups(out, ["sc", "i1"], F.col("node2"), distance, "i2", apart_on_one_strand)
    sizes = F.broadcast(chroms)  # one row for each chromosome of a genome
    one = sizes.select(F.col("chrom_index1").alias("_c1"), F.col("chrom_size").alias("_s1"))
    two = sizes.select(F.col("chrom_index1").alias("_c2"), F.col("chrom_size").alias("_s2"))
    out = out.join(one, node_chrom(F.col("node1")) == F.col("_c1")).join(two, node_chrom(F.col("node2")) == F.col("_c2"))
    out = out.withColumn("vcl", variant_chrom_length(F.col("node1"), F.col("_s1"), F.col("node2"), F.col("_s2"), F.col("jxn_offset"))).drop("_c1", "_s1", "_c2", "_s2")
    return local_groups(out, ["sc", "i1", "i2"], F.col("vcl"), length, "i3")


GROUP = ["sc", "i1", "i2", "i3"]


def merge_final(junctions: DataFrame, chroms: DataFrame, distance: int = 20, length: int = 5) -> DataFrame:
    """Merge final junctions of several libraries: sums, ORs, list concatenation; the best by n_dedup stands for all.

    ``junctions(node1, node2, jxn_offset, n_instances, n_dedup, sample_bits, source)``.
    """
    g = fuzzy_junctions(junctions, chroms, distance, length)
    best = F.max_by(F.struct("node1", "node2", "jxn_offset"), F.struct("n_dedup", -F.col("node1"), -F.col("node2"), -F.col("jxn_offset")))
    return g.groupBy(*GROUP).agg(
        best.alias("b"), F.sum("n_instances").alias("n_instances"), F.sum("n_dedup").alias("n_dedup"), F.bit_or("sample_bits").alias("sample_bits"),
        F.array_join(F.sort_array(F.collect_list("source")), ",").alias("sources"),
    ).select("b.*", "n_instances", "n_dedup", "sample_bits", F.bit_count("sample_bits").cast("bigint").alias("n_samples"), "sources")


def merge_sample_bits(libraries: list[DataFrame], bits: list[int]) -> DataFrame:
    """Union of libraries with each one's ``sample_bits`` shifted beyond those before it; 63 samples at most."""
    if sum(bits) > 63:
        raise ValueError("more than 63 samples")
    out, shift = None, 0
    for df, n in zip(libraries, bits):
        df = df.withColumn("sample_bits", F.shiftleft(F.col("sample_bits").cast("bigint"), shift))
        out, shift = df if out is None else out.unionByName(df), shift + n
    return out
