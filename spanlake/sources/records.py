"""Readers of sequencing text formats into DataFrames, and exports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Columns of a SAM line.
SAM_COLUMNS = ["qname", "flag", "rname", "pos1", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
SAM_INTS = {"flag", "pos1", "mapq", "pnext", "tlen"}
TAG_TYPES = {"i": "bigint", "f": "float", "Z": "string", "A": "string"}


def sam(spark: SparkSession, path: str) -> DataFrame:
    """SAM text: the eleven columns and ``tags`` (map of tag to its text, arrays as ``type,values``); header lines go."""
    parts = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    columns = [F.get(parts, F.lit(i)).cast("bigint" if c in SAM_INTS else "string").alias(c) for i, c in enumerate(SAM_COLUMNS)]
    tags = F.transform(F.slice(parts, 12, 10_000), lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.regexp_replace(t, "^..:.:", "").alias("v")))
    return lines.select(*columns, F.map_from_entries(tags).alias("tags"))


def sam_header(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.col("value").startswith("@"))


def tag(name: str, kind: str = "Z"):
    """One tag as a column of its type; ``B`` gives array<int>."""
    v = F.col("tags")[name]
    return F.slice(F.split(v, ","), 2, 1_000_000).cast("array<int>") if kind == "B" else v.cast(TAG_TYPES[kind])


class _BlockReader(DataSourceReader):
    """Shared by FASTQ and FASTA: one partition for each file, since a record's start can't be told from inside."""

    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        import glob

        files = sorted(f for p in self.options["path"].split(",") for f in (glob.glob(p) or [p]))
        return [InputPartition(f) for f in files]

    def lines(self, path: str):
        import gzip

        with (gzip.open(path, "rt") if path.endswith(".gz") else open(path)) as f:
            yield from (x.rstrip("\r\n") for x in f)


class FastqSource(DataSource):
    """``spark.read.format("fastq").load(path)``: qname, comment, seq, qual, file."""

    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return "qname string, comment string, seq string, qual string, file string"

    def reader(self, schema):
        class Reader(_BlockReader):
            def read(self, partition):
                lines = self.lines(partition.value)
                for head in lines:
                    if not head:
                        continue
                    seq, _, qual = next(lines), next(lines), next(lines)
                    if not head.startswith("@") or len(seq) != len(qual):
                        raise ValueError(f"bad FASTQ record {head!r} in {partition.value}")
                    name, _, comment = head[1:].partition(" ")
                    yield name, comment, seq, qual, partition.value

        return Reader(self.options)


class FastaSource(DataSource):
    """``spark.read.format("fasta").option("chunk", n).load(path)``: chrom, start0, seq in chunks of ``n`` bases and ``overlap`` more."""

    @classmethod
    def name(cls):
        return "fasta"

    def schema(self):
        return "chrom string, start0 bigint, seq string"

    def reader(self, schema):
        class Reader(_BlockReader):
            def read(self, partition):
                size, more = int(self.options.get("chunk", "1000000")), int(self.options.get("overlap", "64"))
                chrom, start, held = None, 0, ""

                def full(last):
                    nonlocal start, held
                    while len(held) >= size + more or last and held:
                        yield chrom, start, held[: size + more]
                        start, held = start + size, held[size:]

                for line in self.lines(partition.value):
                    if line.startswith(">"):
                        yield from full(True)
                        chrom, start, held = line[1:].split()[0], 0, ""
                    else:
                        held += line.upper()
                        yield from full(False)
                yield from full(True)

        return Reader(self.options)


def register(spark: SparkSession) -> None:
    for source in (FastqSource, FastaSource):
        spark.dataSource.register(source)


def fastq_reads(spark: SparkSession, path: str, min_size: int = 0, max_length: int | None = None) -> DataFrame:
    """FASTQ records cut to ``max_length``, with ``passes_size``."""
    register(spark)
    df = spark.read.format("fastq").option("path", path).load()
    if max_length:
        df = df.withColumn("seq", F.substring("seq", 1, max_length)).withColumn("qual", F.substring("qual", 1, max_length))
    return df.withColumn("passes_size", F.char_length("seq") >= min_size)


def fasta_range(fasta: DataFrame, chrom: str, start0: int, end1: int) -> DataFrame:
    """Bases [start0, end1) of a chromosome from chunks without overlap."""
    inside = fasta.where((F.col("chrom") == chrom) & (F.col("start0") < end1) & (F.col("start0") + F.char_length("seq") > start0))
    cut = inside.select("start0", F.expr(f"substring(seq, int(greatest({start0} - start0, 0)) + 1, int(least({end1} - start0, char_length(seq)) - greatest({start0} - start0, 0)))").alias("seq"))
    return cut.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start0", "seq"))), lambda x: x["seq"]), "").alias("seq"))


def bed(spark: SparkSession, path: str, padding: int = 0) -> DataFrame:
    """BED: chrom, start0, end1, name, score, strand.  Comments and browser lines go; commas in numbers are read; a bad line fails."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("value")).where("value <> '' and not value rlike '^(#|track|browser)'")
    p = F.split("value", "\t")
    number = lambda i: F.regexp_replace(F.get(p, F.lit(i)), ",", "").try_cast("bigint")
    df = lines.select(F.get(p, F.lit(0)).alias("chrom"), number(1).alias("start0"), number(2).alias("end1"), F.get(p, F.lit(3)).alias("name"), F.get(p, F.lit(4)).try_cast("double").alias("score"), F.get(p, F.lit(5)).alias("strand"), "value")
    good = F.col("start0").isNotNull() & (F.col("end1") >= F.col("start0")) & (F.col("strand").isNull() | F.col("strand").isin("+", "-", "."))
    df = df.withColumn("chrom", F.when(F.coalesce(good, F.lit(False)), F.col("chrom")).otherwise(F.raise_error(F.concat(F.lit("bad BED line: "), F.col("value"))))).drop("value")
    return df.withColumn("start0", F.greatest(F.col("start0") - padding, F.lit(0))).withColumn("end1", F.col("end1") + padding) if padding else df


def gtf_genes(spark: SparkSession, path: str, longest: int = 5_000_000) -> DataFrame:
    """Gene spans from exons: chrom, start0, end1, name, length, strand (the commonest); contigs with ``_`` and huge spans go."""
    p = F.split("value", "\t")
    exons = spark.read.text(path).where("not startswith(value, '#')").select(
        F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(2)).alias("feature"), F.get(p, F.lit(3)).cast("bigint").alias("a"), F.get(p, F.lit(4)).cast("bigint").alias("b"),
        F.get(p, F.lit(6)).alias("strand"), F.regexp_extract("value", 'gene_name "([^"]+)"', 1).alias("name"),
    ).where("feature = 'exon' and not contains(chrom, '_') and name <> ''")
    n = exons.groupBy("chrom", "name", "strand").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.count("*").alias("n"))
    out = n.groupBy("chrom", "name").agg((F.min("a") - 1).alias("start0"), F.max("b").alias("end1"), F.max_by("strand", F.struct("n", "strand")).alias("strand"))
    return out.withColumn("length", F.col("end1") - F.col("start0")).where(F.col("length") < longest).select("chrom", "start0", "end1", "name", "length", "strand")


def fai(spark: SparkSession, path: str, ordering: str = "canonical") -> DataFrame:
    """Chromosome sizes with ``chrom_index1``.

    ``canonical``: chr1.. (or Roman numerals), X, Y, M, EBV, others go; ``file``: all in the order of the file.
    """
    p = F.split("value", "\t")
    df = spark.read.text(path).select(F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(1)).cast("bigint").alias("chrom_size"), F.get(p, F.lit(2)).cast("bigint").alias("_at"))
    return order_chroms(df, ordering)


def roman(n: int) -> str:
    out = ""
    for v, s in ((90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        while n >= v:
            out, n = out + s, n - v
    return out


def order_chroms(df: DataFrame, ordering: str = "canonical") -> DataFrame:
    from pyspark.sql import Window

    if ordering == "file":
        rank = F.col("_at")
    else:
        name = F.regexp_replace("chrom", "^chr", "")
        uses_roman = df.where(F.regexp_replace("chrom", "^chr", "").isin("II", "III", "IV")).limit(1).count() > 0
        rank = F.when(name == "EBV", 94).when(name == "M", 93).when(name == "Y", 92)
        if uses_roman:
            for n in range(1, 91):
                rank = rank.when(name == roman(n), n)
        else:
            rank = rank.when(name == "X", 91).when(name.rlike("^[1-9][0-9]?$"), name.try_cast("int"))
    ranked = df.withColumn("_rank", rank).where("_rank is not null")
    # one row for each chromosome of a genome
    return ranked.withColumn("chrom_index1", F.row_number().over(Window.orderBy("_rank")).cast("bigint")).select("chrom", "chrom_size", "chrom_index1")


def enzymes(spark: SparkSession, *paths: str, priorities: tuple[int, ...] | None = None) -> DataFrame:
    """Enzyme tables (CSV with a header); ``priorities`` keeps those values of CpG_priority."""
    df = spark.read.csv(list(paths), header=True)
    return df.where(F.col("CpG_priority").cast("int").isin(list(priorities))) if priorities else df


# exports --------------------------------------------------------------------------------------------------


def write_indexed(df: DataFrame, path: str, chrom: str = "chrom_index1", pos: str = "pos1") -> None:
    """Range-readable table: a folder for each chromosome, rows in order of position with row-group statistics."""
    df.repartitionByRange(chrom, pos).sortWithinPartitions(chrom, pos).write.mode("overwrite").partitionBy(chrom).parquet(path)


def read_range(spark: SparkSession, path: str, chrom: int, low: int, high: int, column: str = "pos1") -> DataFrame:
    """Rows of chrom:low-high; only that folder's row groups that can hold them are read."""
    return spark.read.parquet(path).where((F.col("chrom_index1") == chrom) & F.col(column).between(low, high))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("compression", "gzip").csv(path)


def bedgraph(runs: DataFrame, most: int = 65_535) -> DataFrame:
    """Coverage runs in bedGraph order, capped at 16 bits; runs of depth 0 are left out."""
    return runs.where("coverage > 0").select("chrom_index1", "start0", "end1", F.least(F.col("coverage"), F.lit(most)).alias("coverage"))


def write_final_junctions(final: DataFrame, path: str) -> None:
    """The same rows in two orders, by node 1 and by node 2."""
    for name, order in (("by_node1", ("node1", "node2")), ("by_node2", ("node2", "node1"))):
        final.orderBy(*order).write.mode("overwrite").parquet(f"{path}/{name}")


def ubam_rows(merged: DataFrame) -> DataFrame:
    """Merged strands as unaligned SAM columns with their tags."""
    q = F.array_join(F.transform("qual", lambda x: F.chr(x + 33)), "")
    tags = F.map_from_arrays(F.array(F.lit("dd")), F.array("dd"))
    return merged.select(F.concat_ws("/", "movie", F.col("zmw").cast("string"), F.lit("ccs")).alias("qname"), F.lit(4).alias("flag"), "seq", q.alias("qual"), tags.alias("tags"))


def read_name_patterns() -> re.Pattern:
    """Names of paired files end in _R1 or _R2, _1 or _2, before the extension."""
    return re.compile(r"(?P<base>.+)[._]R?(?P<mate>[12])(?P<rest>(?:_\d+)?\.f(?:ast)?q(?:\.gz)?)$")


#: Tags that each stage needs from those before it.
STAGE_TAGS = {
    "alignment": ["ch", "tl", "ec", "dt", "dd", "sk", "fm"],
    "junctions": ["ch", "tl", "fm", "de", "cs", "po", "tm", "to", "af", "bn", "jx", "ji"],
    "variants": ["ec", "dd", "cs", "de", "rf", "sb"],
}


def keep_tags(df: DataFrame, stage: str) -> DataFrame:
    """Records with only those tags that ``stage`` needs."""
    return df.withColumn("tags", F.map_filter("tags", lambda k, v: k.isin(STAGE_TAGS[stage])))
