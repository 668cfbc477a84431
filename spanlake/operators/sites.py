"""Restriction sites: observed endpoints matched with in-silico sites by position tolerance."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fuzzy import gap_groups


def filtering_sites(matched: DataFrame, evidence: int = 3) -> DataFrame:
    """chrom_index1, site_pos1, in_silico, n_observed, is_filtering (in silico, or observed often enough)."""
    out = matched.groupBy("chrom_index1", "site_pos1").agg(F.bool_or("in_silico").alias("in_silico"), F.sum("n_observed").alias("n_observed"))
    return out.withColumn("is_filtering", F.col("in_silico") | (F.col("n_observed") >= evidence))


def merge_site_tables(observed: DataFrame, in_silico: DataFrame) -> DataFrame:
    """Full outer merge by (chromosome, position); what is missing is not in silico, or observed 0 times."""
    a = observed.select("chrom_index1", "site_pos1", "n_observed")
    b = in_silico.select("chrom_index1", "site_pos1", F.lit(True).alias("in_silico")).distinct()
    return a.join(b, ["chrom_index1", "site_pos1"], "full").select("chrom_index1", "site_pos1", F.coalesce("in_silico", F.lit(False)).alias("in_silico"), F.coalesce("n_observed", F.lit(0).cast("bigint")).alias("n_observed"))


def split_by_gap(positions: list[tuple[int, int, int]], distance: int) -> list[list[tuple[int, int, int]]]:
    """Split ordered (pos, kind, n) at the largest gap (the first of equals) until no part is wider than ``distance``."""
    if positions[-1][0] - positions[0][0] <= distance:
        return [positions]
    gaps = [b[0] - a[0] for a, b in zip(positions, positions[1:])]
    cut = gaps.index(max(gaps)) + 1
    return split_by_gap(positions[:cut], distance) + split_by_gap(positions[cut:], distance)


def commit_group(group: list[tuple[int, int, int]]) -> list[tuple[int, bool, int]]:
    """Sites of one cluster of (pos, kind, n); kind 0 is in silico, 1 observed.

    No in-silico site: all observed take the most observed position.  Otherwise each observed position takes its
    nearest in-silico site (the lower of two equals).  In-silico sites alone give nothing.
    """
    known = [p for p, kind, _ in group if kind == 0]
    seen = [(p, n) for p, kind, n in group if kind == 1]
    if not seen:
        return []
    if not known:
        best = max(seen, key=lambda s: (s[1], -s[0]))[0]
        return [(best, False, n) for _, n in seen]
    return [(min(known, key=lambda k: (abs(k - p), k)), True, n) for p, n in seen]


def match_endpoints(observed: DataFrame, in_silico: DataFrame, distance: int) -> DataFrame:
    """Observed endpoints (chrom_index1, site_pos1, n_observed) assigned to sites: chrom_index1, site_pos1, in_silico, n_observed.

    Clusters come from a window over positions.  Clusters no wider than ``distance`` are resolved by expressions;
    only wider ones, which are few, go to Python, one cluster at a time.
    """
    rows = in_silico.select("chrom_index1", F.col("site_pos1").alias("pos"), F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("n")).distinct().unionByName(
        observed.select("chrom_index1", F.col("site_pos1").alias("pos"), F.lit(1).alias("kind"), F.col("n_observed").alias("n"))
    )
    rows = gap_groups(rows, ["chrom_index1"], F.col("pos"), distance, "cluster")
    wide_by = rows.groupBy("chrom_index1", "cluster").agg((F.max("pos") - F.min("pos")).alias("width"))
    rows = rows.join(wide_by, ["chrom_index1", "cluster"])
    narrow = rows.where(F.col("width") <= distance)
    known = narrow.where("kind = 0").select("chrom_index1", "cluster", F.col("pos").alias("site"))
    seen = narrow.where("kind = 1").withColumn("_id", F.struct("pos", "n"))
    best = seen.groupBy("chrom_index1", "cluster").agg(F.max_by("pos", F.struct("n", -F.col("pos"))).alias("_best"))
    near = seen.join(known, ["chrom_index1", "cluster"], "left").groupBy("chrom_index1", "cluster", "pos", "n").agg(F.min(F.when(F.col("site").isNotNull(), F.struct(F.abs(F.col("site") - F.col("pos")), "site"))).alias("_s"))
    easy = near.join(best, ["chrom_index1", "cluster"]).select("chrom_index1", F.coalesce(F.col("_s.site"), F.col("_best")).alias("site_pos1"), F.col("_s").isNotNull().alias("in_silico"), F.col("n").alias("n_observed"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        items = sorted(zip(pdf["pos"].tolist(), pdf["kind"].tolist(), pdf["n"].tolist()))
        out = [s for g in split_by_gap(items, distance) for s in commit_group(g)]
        return pd.DataFrame({"chrom_index1": [pdf["chrom_index1"].iloc[0]] * len(out), "site_pos1": [s[0] for s in out], "in_silico": [s[1] for s in out], "n_observed": [s[2] for s in out]})

    wide = rows.where(F.col("width") > distance).groupBy("chrom_index1", "cluster").applyInPandas(run, "chrom_index1 bigint, site_pos1 bigint, in_silico boolean, n_observed bigint")
    return easy.unionByName(wide)


def best_in_silico(observed: DataFrame, in_silico: DataFrame, distance: int, bin_width: int | None = None) -> DataFrame:
    """For each observed position the nearest in-silico site within ``distance``."""
    width = bin_width or max(distance, 1)
    a = observed.withColumn("_b", F.explode(F.sequence(F.floor((F.col("site_pos1") - distance) / width), F.floor((F.col("site_pos1") + distance) / width))))
    b = in_silico.select("chrom_index1", F.col("site_pos1").alias("in_silico_pos1"), F.floor(F.col("site_pos1") / width).alias("_b"))
    gap = F.abs(F.col("site_pos1") - F.col("in_silico_pos1"))
    return a.join(b, ["chrom_index1", "_b"]).where(gap <= distance).groupBy("chrom_index1", "site_pos1").agg(F.min_by("in_silico_pos1", F.struct(gap, "in_silico_pos1")).alias("in_silico_pos1"), F.min(gap).alias("distance"))
