"""In-silico digestion, fragments between sites, and fragment statistics."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Grams per mole of a base pair.
BASE_PAIR_MASS = 615.96


def site_count(seq: Column, pattern: str) -> Column:
    """Non-overlapping matches in a sequence."""
    return F.regexp_count(seq, F.lit(pattern)).cast("bigint")


def chunks(sequences: DataFrame, key: str, size: int = 1_000_000, overlap: int = 64) -> DataFrame:
    """Cut long sequences into chunks that share ``overlap`` bases with the next: key, chunk_start0, seq."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.char_length("seq") - 1, F.lit(0)).cast("bigint"), F.lit(size).cast("bigint"))
    return sequences.select(key, "seq", F.explode(starts).alias("chunk_start0")).withColumn("seq", F.substring("seq", (F.col("chunk_start0") + 1).cast("int"), F.lit(size + overlap)))


def digest(pieces: DataFrame, key: str, enzymes: list[tuple[str, str, int]], size: int = 1_000_000) -> DataFrame:
    """Cut sites: key, enzyme, site_pos1 (the first base after the cut), each once.

    ``pieces`` come from ``chunks``; a match belongs to the chunk in which it starts.  ``enzymes`` are (name, regular expression,
    cut offset).  Overlapping occurrences count.
    """
    compiled = [(n, re.compile(f"(?={r})"), o) for n, r, o in enzymes]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, n, start + m.start() + o + 1) for k, start, seq in zip(pdf[key], pdf["chunk_start0"], pdf["seq"]) for n, r, o in compiled for m in r.finditer(seq) if m.start() < size]
            yield pd.DataFrame(rows, columns=[key, "enzyme", "site_pos1"])

    kind = dict(pieces.dtypes)[key]
    return pieces.select(key, "chunk_start0", "seq").mapInPandas(run, f"{key} {kind}, enzyme string, site_pos1 bigint")


def fragments(sites: DataFrame, by: list[str]) -> DataFrame:
    """Consecutive sites -> fragments [start0, end1)."""
    nxt = F.lead("site_pos1").over(Window.partitionBy(*by).orderBy("site_pos1"))
    return sites.select(*by, (F.col("site_pos1") - 1).alias("start0"), (nxt - 1).alias("end1")).where("end1 is not null").withColumn("size", F.col("end1") - F.col("start0"))


def nxx(sizes: DataFrame, by: list[str], fraction: float = 0.5, value: str = "size", weight: str | None = None) -> DataFrame:
    """First size, in descending order, at which the running sum reaches 1 - ``fraction`` of the total.

    Equal sizes are summed first, so a window holds the distinct sizes only.
    """
    w = F.sum(weight) if weight else F.count("*")
    counted = sizes.groupBy(*by, value).agg((w * F.col(value)).alias("_mass"))
    run = Window.partitionBy(*by).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumn("_cum", F.sum("_mass").over(run)).withColumn("_all", F.sum("_mass").over(Window.partitionBy(*by)))
    return counted.where(F.col("_cum") >= F.col("_all") * (1 - fraction)).groupBy(*by).agg(F.max(value).alias("nxx"))


def fragment_statistics(frags: DataFrame, by: list[str], sizes: tuple[int, ...] = (500, 1000, 2000)) -> DataFrame:
    """Number, bases, least, most, quartiles, shares in [n, 2n) by molecules and by mass, and fmol in a microgram."""
    inside = lambda n: (F.col("size") >= n) & (F.col("size") < 2 * n)
    out = frags.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum("size").alias("bases"), F.min("size").alias("least"), F.max("size").alias("most"),
        *(F.percentile("size", q).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)),
        *(F.count_if(inside(n)).alias(f"n_{n}") for n in sizes), *(F.sum(F.when(inside(n), F.col("size")).otherwise(0)).alias(f"bases_{n}") for n in sizes),
    )
    for n in sizes:
        out = out.withColumn(f"molar_{n}", F.col(f"n_{n}") / F.col("n")).withColumn(f"mass_{n}", F.col(f"bases_{n}") / F.col("bases"))
    return out.withColumn("fmol_per_ug", 1e9 / (F.col("bases") / F.col("n") * BASE_PAIR_MASS))


def enzyme_summary(enzymes: DataFrame, statistics: DataFrame, key: str = "enzyme") -> DataFrame:
    """Full outer merge of the enzyme table with its statistics."""
    return enzymes.join(statistics, key, "full")


#: Percentages and least sizes of the fragment summary.
PERCENTS = (1, 2.5, 5, 10, 50, 90, 95, 97.5, 99)
LEAST_SIZES = (*range(150, 351, 25), *range(1000, 15_001, 1000))


def fragment_summary(frags: DataFrame, by: list[str], percents: tuple = PERCENTS, sizes: tuple[int, ...] = LEAST_SIZES) -> DataFrame:
    """Number, Gb, least, most, quantiles ``q`` and weighted sizes ``n`` at each percentage, and shares of molecules and mass in [s, 2 s).

    Columns: n_sites, total_gb, least, most, q_<percent>, nxx_<percent>, molar_<s>, mass_<s>, n_<s>; a point in a percentage is ``_``.
    """
    name = lambda p: str(p).replace(".", "_")
    inside = lambda s: (F.col("size") >= s) & (F.col("size") < 2 * s)
    counted = frags.groupBy(*by, "size").agg(F.count("*").alias("_n"))
    n, mass = F.sum("_n"), F.sum(F.col("_n") * F.col("size"))
    part = lambda s, v: F.coalesce(F.sum(F.when(inside(s), v)), F.lit(0))
    out = counted.groupBy(*by).agg(
        n.alias("n_sites"), F.round(mass / 1e9, 2).alias("total_gb"), F.min("size").alias("least"), F.max("size").alias("most"),
        *(F.percentile("size", p / 100, F.col("_n")).alias(f"q_{name(p)}") for p in percents),
        *(c for s in sizes for c in ((part(s, F.col("_n")) / n).alias(f"molar_{s}"), (part(s, F.col("_n") * F.col("size")) / mass).alias(f"mass_{s}"), part(s, F.col("_n")).alias(f"n_{s}"))),
    )
    run = Window.partitionBy(*by).orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counted.withColumn("_cum", F.sum(F.col("_n") * F.col("size")).over(run)).withColumn("_all", F.sum(F.col("_n") * F.col("size")).over(Window.partitionBy(*by)))
    reached = running.groupBy(*by).agg(*(F.max(F.when(F.col("_cum") >= F.col("_all") * (1 - p / 100), F.col("size"))).alias(f"nxx_{name(p)}") for p in percents))
    return out.join(reached, by)
