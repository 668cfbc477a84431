"""Counters, tallies, summaries and pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counter(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def tally_fractions(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Bases by keys with their share of all, truncated to 4 decimals."""
    out = df.groupBy(*keys).agg(F.sum(value).alias("bases"))
    total = out.agg(F.sum("bases").alias("_all"))
    return out.join(F.broadcast(total)).withColumn("fraction", F.floor(F.col("bases") / F.col("_all") * 10_000) / 10_000).drop("_all")


def pivot_counts(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Counts by ``row`` and ``column``; ``values`` are listed so that no extra pass looks for them; none is 0."""
    return df.groupBy(row).pivot(column, values).count().na.fill(0)


def describe(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    v = F.col(value)
    return df.groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.percentile(v, 0.5).alias("median"), F.min(v).alias("least"), F.max(v).alias("most"))


def histogram_mode(df: DataFrame, keys: list[str], value: Column, size: int) -> DataFrame:
    """Bin that holds most values (the least of equals)."""
    h = df.groupBy(*keys, (F.floor(value / size) * size).alias("bin")).agg(F.count("*").alias("n"))
    return h.groupBy(*keys).agg(F.max_by("bin", F.struct("n", -F.col("bin"))).alias("mode"))


def trim_outliers(df: DataFrame, keys: list[str], value: str, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Rows within two exact quantiles of their group."""
    q = df.groupBy(*keys).agg(F.percentile(value, low).alias("_lo"), F.percentile(value, high).alias("_hi"))
    return df.join(q, keys).where((F.col(value) >= F.col("_lo")) & (F.col(value) <= F.col("_hi"))).drop("_lo", "_hi")


def merge_summary(reads: DataFrame) -> DataFrame:
    """Reads by how their mates were merged: merged (``fm`` set), paired (same name as a neighbour), orphan; with percentages."""
    n = F.count("*").over(Window.partitionBy("qname"))
    kind = F.when(F.col("fm").isNotNull(), "merged").when(n > 1, "paired").otherwise("orphan")
    out = reads.withColumn("kind", kind).groupBy("kind").agg(F.count_distinct("qname").alias("n"))
    return out.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 2))


def final_reports(final: DataFrame) -> DataFrame:
    """Counts of final junctions by offset type and coverage type, with singletons and validated ones."""
    return final.groupBy("offset_type", "coverage_type").agg(F.count("*").alias("n"), F.count_if(F.col("n_dedup") == 1).alias("n_singleton"), F.count_if(F.col("n_dedup") >= 3).alias("n_validated"))


def first_rows(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each key."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def down_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows chosen by the hash of their key: the same ones every time."""
    return df.withColumn("_h", F.md5(F.col(key).cast("string"))).orderBy("_h", key).limit(n).drop("_h")


def cumulative_offsets(chroms: DataFrame) -> DataFrame:
    """Prefix sums of chromosome sizes: ``offset`` of each chromosome in the genome."""
    w = Window.orderBy("chrom_index1").rowsBetween(Window.unboundedPreceding, -1)
    return chroms.withColumn("offset", F.coalesce(F.sum("chrom_size").over(w), F.lit(0)).cast("bigint"))


def composite(genomes: dict[str, DataFrame]) -> DataFrame:
    """Union of genomes with each one's name as a suffix of its chromosomes."""
    out = None
    for name, df in genomes.items():
        df = df.withColumn("chrom", F.concat_ws("_", F.col("chrom").cast("string"), F.lit(name)))
        out = df if out is None else out.unionByName(df)
    return out


def final_counters(final: DataFrame) -> DataFrame:
    """Counters of final junctions: report, key, n; needs the labels of ``add_classes``, jxn_type and n_dedup."""
    one = lambda report, key, when=True: F.struct(F.lit(report).alias("report"), F.when(F.lit(when) if isinstance(when, bool) else when, F.col(key)).alias("key"))
    reports = F.array(
        one("offset", "offset_type"), one("type", "jxn_type"), one("chimericity", "chimericity"), one("singletons", "chimericity", F.col("n_dedup") == 1),
        one("validated", "chimericity", F.col("n_dedup") >= 3), one("genomicity", "genomicity"), one("count", "coverage_type"),
    )
    return final.select(F.explode(reports).alias("r")).where("r.key is not null").groupBy("r.report", "r.key").agg(F.count("*").alias("n"))


def target_summary(alignments: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Alignments of single-alignment reads by target class (on, near, off), with densities over each class's size.

    ``alignments``: class, start1, end1, site_first, site_last; ``sizes``: bases of each class in the genome.
    """
    bases = F.element_at(F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair)), F.col("class"))
    n = alignments.groupBy("class").agg(
        F.count("*").alias("n_alns"), F.sum(F.col("end1") - F.col("start1") + 1).alias("n_seq_bases"), F.sum(F.abs(F.col("site_last") - F.col("site_first")) + 1).alias("n_proj_bases")
    )
    rounded = lambda x, scalar: F.floor(x * scalar + 0.5) / scalar
    return n.select(
        "*", rounded(F.col("n_alns") / bases, 1000).alias("aln_density"), rounded(F.col("n_seq_bases") / bases, 100).alias("seq_coverage"), rounded(F.col("n_proj_bases") / bases, 100).alias("proj_coverage"),
        rounded(F.col("n_seq_bases") / F.col("n_alns"), 100).alias("avg_aln"), rounded(F.col("n_proj_bases") / F.col("n_alns"), 100).alias("avg_insert"), rounded(F.col("n_seq_bases") / F.col("n_proj_bases"), 1000).alias("frac_sequenced"),
    )
