"""Two-sided nearest-site (as-of) join and projection to the neighbouring site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import scan


def with_rank(places: DataFrame, by: str, pos: str, out: str) -> DataFrame:
    """``places`` (distinct by ``by`` and ``pos``) with their 1-based rank ``out``."""
    return scan(places, [by], pos, [pos], **{out: ("sum", F.lit(1).cast("bigint"))})


def nearest_site(queries: DataFrame, sites: DataFrame, by: str = "chrom_index1", pos: str = "pos1", site: str = "site_pos1") -> DataFrame:
    """Add to each query the nearest site of its chromosome: ``site_pos1``, ``site_index1`` and ``distance`` (pos - site).

    A tie goes to the next site.  The index is the site's 1-based rank, negative if the site lies after the query.  Queries before the
    first or after the last site get nulls.  Sites and the distinct places of the queries are merged in one scan by blocks of
    positions; a place that many queries share is looked up once.
    """
    ranked = with_rank(sites.select(F.col(by), F.col(site).cast("bigint").alias("_site")).distinct(), by, "_site", "_rank")
    places = queries.select(by, F.col(pos).cast("bigint").alias("_p")).where(F.col("_p").isNotNull()).distinct()
    rows = places.withColumn("_q", F.lit(1)).unionByName(ranked.select(by, F.col("_site").alias("_p"), F.lit(0).alias("_q"), F.struct("_site", "_rank").alias("_s")), allowMissingColumns=True)
    # sites rise along a chromosome, so the last one so far is the largest one
    found = scan(rows, [by], "_p", ["_p", "_q"], _before=("max_before", F.col("_s")), _after=("min_after", F.col("_s"))).where("_q = 1")
    lo, hi, p = F.col("_before._site"), F.col("_after._site"), F.col("_p")
    first = (lo == p) | (p - lo < hi - p)
    known = lo.isNotNull() & (hi.isNotNull() | (lo == p))
    best = F.when(known, F.when(first, F.col("_before")).otherwise(F.col("_after")))
    found = found.select(F.col(by).alias("_by"), "_p", best.alias("_best"))
    joined = queries.join(found, (F.col(by) == F.col("_by")) & (F.col(pos).cast("bigint") == F.col("_p")), "left")
    best, p = F.col("_best"), F.col(pos).cast("bigint")
    sign = F.when(best["_site"] > p, -1).otherwise(1)
    return joined.select(*(queries[c] for c in queries.columns), best["_site"].alias("site_pos1"), (best["_rank"] * sign).alias("site_index1"), (p - best["_site"]).alias("distance"))


def project_site(matched: DataFrame, sites: DataFrame, reject: int, by: str = "chrom_index1", strand: str = "strand0") -> DataFrame:
    """Add ``proj_index1`` and ``proj_pos1``: the site at which a fragment's 3' end is expected.

    On the reverse strand a site after the end and beyond ``reject`` gives way to the one before; on the forward strand a
    site before it gives way to the next; chromosome ends stop that.
    """
    ranked = with_rank(sites.select(by, F.col("site_pos1").cast("bigint").alias("proj_pos1")).distinct(), by, "proj_pos1", "proj_index1")
    counts = ranked.groupBy(by).agg(F.count("*").alias("_n"))
    i, far = F.col("site_index1"), F.abs("distance") > reject
    index = F.when((F.col(strand) == 1) & (i < 0) & far & (F.abs(i) > 1), F.abs(i) - 1).when((F.col(strand) == 0) & (i > 0) & far & (i < F.col("_n")), i + 1).otherwise(F.abs(i))
    with_index = matched.join(counts, by, "left").withColumn("proj_index1", index).drop("_n")
    return with_index.join(ranked, [by, "proj_index1"], "left")


def clip_adjusted_distance(distance: Column, strand: Column, is_5prime: Column, clip: Column, untrimmed: Column) -> Column:
    """Distance of the read's end (with its clipped bases) to the site; no clip is counted if adapters are untrimmed."""
    outward = F.when((strand == 0) == is_5prime, -1).otherwise(1)
    return distance + outward * F.when(untrimmed, 0).otherwise(clip)
