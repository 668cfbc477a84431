"""Interval operators over half-open spans [start0, end1) by chromosome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import scan

C, S, E = "chrom_index1", "start0", "end1"
#: Each level's bins are so many times wider than the last one's; a span is in as many bins of its level and one at most.
STEP, LEVELS = 64, 4


def binned(spans: DataFrame, width: int) -> DataFrame:
    """Each span once for each ``width``-wide bin it touches, as ``_bin``."""
    return spans.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(S) / width), F.floor((F.greatest(F.col(E), F.col(S) + 1) - 1) / width))))


def levelled(spans: DataFrame, width: int) -> DataFrame:
    """Each span once for each bin it touches, as ``_bin`` (level, bin), of a level whose bins fit its length."""
    last = F.greatest(F.col(E), F.col(S) + 1) - 1
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(last - F.col(S) < width * STEP ** (k + 1), k).otherwise(level)
    size = F.element_at(F.array(*(F.lit(width * STEP**k).cast("bigint") for k in range(LEVELS))), F.col("_level") + 1)
    rows = spans.withColumn("_level", level).withColumn("_size", size)
    bins = F.sequence(F.floor(F.col(S) / F.col("_size")), F.floor(last / F.col("_size")))
    return rows.withColumn("_bin", F.explode(bins)).withColumn("_bin", F.struct(F.col("_level").alias("level"), F.col("_bin").alias("bin"))).drop("_level", "_size")


def level_bins(place: Column, width: int) -> Column:
    """The (level, bin) pairs of a 0-based place, as an array."""
    return F.array(*(F.struct(F.lit(k).alias("level"), F.floor(place / (width * STEP**k)).alias("bin")) for k in range(LEVELS)))


def place_hits(points: DataFrame, regions: DataFrame, width: int, pos: str) -> DataFrame:
    """Each distinct place (``_c``, ``_pos``) of ``points`` with each of the regions that hold it, and ``center_distance``.

    An equi-join on (chromosome, level, bin): a region is copied to the few bins of its level that it touches, a place has
    one bin in each level, so regions of any lengths cost alike.
    """
    at = points.select(C, F.col(pos).alias("_pos")).distinct().withColumn("_bin", F.explode(level_bins(F.col("_pos") - 1, width)))
    hit = at.join(levelled(regions, width), [C, "_bin"]).where((F.col("_pos") - 1 >= F.col(S)) & (F.col("_pos") - 1 < F.col(E))).drop("_bin")
    middle = F.col(S) + ((F.col(E) - F.col(S)) / 2).cast("bigint")
    return hit.withColumn("center_distance", F.col("_pos") - middle).withColumnRenamed(C, "_c")


def point_in_interval(points: DataFrame, regions: DataFrame, width: int = 512, pos: str = "pos1") -> DataFrame:
    """Inner join of 1-based points with the regions that hold them, with ``center_distance``.

    Regions are found for distinct places and joined back, so that points at one place don't search for them again.
    """
    hit = place_hits(points, regions, width, pos)
    return points.join(hit, (F.col(C) == F.col("_c")) & (F.col(pos) == F.col("_pos"))).drop("_c", "_pos")


def regions_of_points(points: DataFrame, regions: DataFrame, width: int = 512, pos: str = "pos1") -> DataFrame:
    """All points with their regions' names in order (``names``; empty outside any) and the nearest centre.

    Names are gathered once for each distinct place, however many points are there.
    """
    found = place_hits(points, regions, width, pos).groupBy("_c", "_pos").agg(
        F.array_join(F.sort_array(F.collect_set("name")), ",").alias("names"), F.min(F.abs("center_distance")).alias("nearest_center")
    )
    joined = points.join(found, (F.col(C) == F.col("_c")) & (F.col(pos) == F.col("_pos")), "left")
    return joined.withColumn("names", F.coalesce("names", F.lit(""))).drop("_c", "_pos")


def islands(spans: DataFrame, by: list[str], gap: int = 0) -> DataFrame:
    """Rows with ``island``: spans that overlap, touch, or are up to ``gap`` apart share one."""
    ends = spans.groupBy(*by, S).agg(F.max(E).alias(E))  # however many spans start at one place, it is one row
    reach = scan(ends, by, S, [S], _before=("max_before", F.col(E)))
    new = F.when(F.col(S) <= F.col("_before") + gap, 0).otherwise(1)
    numbered = scan(reach.withColumn("_new", new), by, S, [S], island=("sum", F.col("_new"))).select(*by, S, "island")
    return spans.join(numbered, [*by, S])


def collapse(spans: DataFrame, by: list[str] = [C], padding: int = 0) -> DataFrame:  # noqa: B006
    """Merge overlapping or touching spans; ``padding`` widens them for the comparison and is taken off again."""
    wide = spans.withColumn(S, F.greatest(F.col(S) - padding, F.lit(0))).withColumn(E, F.col(E) + padding)
    return (
        islands(wide, by).groupBy(*by, "island")
        .agg(F.min(S).alias(S), F.max(E).alias(E), F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("name")), "::").alias("names"))
        .withColumn(S, F.when(F.col(S) == 0, 0).otherwise(F.col(S) + padding)).withColumn(E, F.col(E) - padding).drop("island")
    )


def overlap_join(left: DataFrame, right: DataFrame, width: int = 1_000_000, how: str = "left_semi") -> DataFrame:
    """Spans of ``left`` that overlap (``left_semi``) or don't overlap (``left_anti``) a span of ``right``.

    ``right`` is collapsed first, so that no span is met more than its bins ask for.
    """
    keyed = left.withColumn("_id", F.monotonically_increasing_id()) if "_id" not in left.columns else left
    r = binned(collapse(right.withColumn("name", F.lit("")) if "name" not in right.columns else right), width).select(C, "_bin", F.col(S).alias("_s"), F.col(E).alias("_e"))
    a, b = binned(keyed, width).alias("a"), r.alias("b")
    on = (F.col(f"a.{C}") == F.col(f"b.{C}")) & (F.col("a._bin") == F.col("b._bin")) & (F.col(f"a.{S}") < F.col("b._e")) & (F.col("b._s") < F.col(f"a.{E}"))
    touched = a.join(b, on, "left_semi").select(*left.columns)
    if how == "left_semi":
        return touched.distinct()
    return left.distinct().join(touched.distinct(), [*left.columns], "left_anti")


def coverage_runs(spans: DataFrame, weight: str | None = None) -> DataFrame:
    """Runs of equal depth above zero: chrom_index1, start0, end1, coverage.

    +w and -w events are summed by position and swept; positions where nothing changes drop out, so equal
    neighbours are one run.  Sums are exact; ``least(coverage, 65535)`` belongs to an export.
    """
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    events = spans.select(C, F.explode(F.array(F.struct(F.col(S).alias("p"), w.alias("d")), F.struct(F.col(E).alias("p"), (-w).alias("d")))).alias("e"))
    net = events.groupBy(C, F.col("e.p").alias("p")).agg(F.sum("e.d").alias("d")).where("d <> 0")
    runs = scan(net, [C], "p", ["p"], **{E: ("lead", F.col("p")), "coverage": ("sum", F.col("d"))})
    return runs.select(C, F.col("p").alias(S), E, "coverage").where("coverage > 0")


def depth_at(points: DataFrame, runs: DataFrame, width: int = 512, pos: str = "pos1") -> DataFrame:
    """Points with the ``coverage`` of the run that holds them (0 outside any run)."""
    at = points.select(C, F.col(pos).alias("_pos")).distinct().withColumn("_bin", F.explode(level_bins(F.col("_pos") - 1, width)))
    r = levelled(runs, width).select(C, "_bin", F.col(S).alias("_s"), F.col(E).alias("_e"), F.col("coverage").alias("_v"))
    found = at.join(r, [C, "_bin"]).where((F.col("_pos") > F.col("_s")) & (F.col("_pos") <= F.col("_e"))).select(F.col(C).alias("_c"), "_pos", "_v")
    joined = points.join(found, (F.col(C) == F.col("_c")) & (F.col(pos) == F.col("_pos")), "left")
    return joined.withColumn("coverage", F.coalesce("_v", F.lit(0).cast("bigint"))).drop("_c", "_pos", "_v")


def elementary_segments(spans: DataFrame, by: list[str] = [C], gaps: bool = False) -> DataFrame:  # noqa: B006
    """Split at every boundary; ``n`` spans hold each segment (without ``gaps``, one at least)."""
    ends = spans.select(*by, F.explode(F.array(F.struct(F.col(S).alias("p"), F.lit(1).alias("d")), F.struct(F.col(E).alias("p"), F.lit(-1).alias("d")))).alias("e"))
    net = ends.groupBy(*by, F.col("e.p").alias("p")).agg(F.sum("e.d").alias("d"))
    swept = scan(net, by, "p", ["p"], **{E: ("lead", F.col("p")), "n": ("sum", F.col("d"))})
    out = swept.select(*by, F.col("p").alias(S), E, "n").where(F.col(E).isNotNull())
    return out if gaps else out.where("n > 0")


def group_score(segments: DataFrame, spans: DataFrame, score: str, how: str, width: int = 512) -> DataFrame:
    """Score each segment from the spans that hold it: COUNT, SUM, AVERAGE, MEDIAN, MIN, MAX or BOOLEAN."""
    v = F.col("_v")
    agg = {"COUNT": F.count(v), "SUM": F.sum(v), "AVERAGE": F.avg(v), "MEDIAN": F.percentile(v, 0.5), "MIN": F.min(v), "MAX": F.max(v), "BOOLEAN": F.max(F.lit(1))}[how]
    inner = levelled(spans, width).select(C, "_bin", F.col(S).alias("_s"), F.col(E).alias("_e"), F.col(score).alias("_v"), F.col("name").alias("_name"))
    seg = segments.select(C, S, E).withColumn("_bin", F.explode(level_bins(F.col(S), width)))
    hit = seg.join(inner, [C, "_bin"]).where((F.col(S) >= F.col("_s")) & (F.col(E) <= F.col("_e")))
    return hit.groupBy(C, S, E).agg(agg.alias("score"), F.array_join(F.sort_array(F.collect_set("_name")), ",").alias("names"))


def complement(spans: DataFrame, chroms: DataFrame) -> DataFrame:
    """Parts of the chromosomes that no span holds."""
    joined = collapse(spans.withColumn("name", F.lit(""))).select(C, S, E)
    ends = joined.unionByName(chroms.select(C, F.col("chrom_size").alias(S), F.col("chrom_size").alias(E)))
    gaps = scan(ends, [C], S, [S, E], _before=("lag", F.col(E)))
    return gaps.select(C, F.coalesce("_before", F.lit(0)).alias(S), F.col(S).alias(E)).where(F.col(S) < F.col(E))


def clip_window(runs: DataFrame, low: int, high: int) -> DataFrame:
    """Runs that meet [low, high), cut to it."""
    return runs.where((F.col(E) > low) & (F.col(S) < high)).withColumn(S, F.greatest(F.col(S), F.lit(low))).withColumn(E, F.least(F.col(E), F.lit(high)))


#: Columns of a pileup track, with and without what isn't allowed to call variants.
TRACK = {True: {c: c for c in ("n_ref", "n_a", "n_c", "n_g", "n_t", "n_del", "n_n", "n_ins")}, False: {"n_ref": "n_ref", "n_a": "n_a", "n_c": "n_c", "n_g": "n_g", "n_t": "n_t", "n_del_allowed": "n_del", "n_ins_allowed": "n_ins"}}


def pileup_track(runs: DataFrame, low: int, high: int, include_unallowed: bool, bases_per_pixel: float, least_pixels: int = 3) -> DataFrame:
    """Bars of a pileup in [low, high] (1-based): the columns of ``TRACK``, cut to the window, none narrower than ``least_pixels``."""
    half = bases_per_pixel * least_pixels / 2
    first, last = F.greatest(F.col(S) + 1, F.lit(low)), F.least(F.col(E), F.lit(high))
    bars = runs.where((F.col(E) >= low) & (F.col(S) + 1 <= high)).select(first.alias("first"), last.alias("last"), *(F.col(c).alias(n) for c, n in TRACK[include_unallowed].items()))
    narrow, middle = (F.col("last") - F.col("first") + 1) / bases_per_pixel < least_pixels, (F.col("first") + F.col("last")) / 2
    return bars.withColumns({"first": F.when(narrow, F.floor(middle - half + 0.5)).otherwise(F.col("first")), "last": F.when(narrow, F.ceil(middle + half - 0.5)).otherwise(F.col("last"))})
