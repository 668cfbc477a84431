"""Registered queries of readers, exports, streams and settings: files made from the fixtures are written, read back and compared."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..operators import snv
from ..sources import inputs, records
from ..streaming import records as streams
from . import fixtures as fx
from .core import ORACLES, QUERIES, big, col, query  # noqa: F401


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared one; in a private one only where that is unset and all runs in one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='spanlake-')).removeprefix('file://')}/spanlake-files/{name}-{uuid.uuid4().hex}"


def text_file(lines: DataFrame, name: str, compression: str = "none") -> str:
    """Write a one-column table as text; the folder."""
    path = folder(lines.sparkSession, name)
    lines.write.text(path, compression=compression)
    return path


SAM = "concat_ws('\\t', 'r' || qname, cast(strand0 * 16 as string), 'chr' || chrom_index1, cast(pos1 as string), cast(mapq as string), ref_span || 'M', '*', '0', '0', 'ACGT', 'IIII', 'de:f:0.5', 'xi:i:' || aln_i, 'cs:Z::' || ref_span, 'ip:B:C,1,' || mapq)"


def sam_file(spark: SparkSession, sf: str, compression: str = "none") -> str:
    header = spark.sql("select '@HD\tVN:1.6' as value")
    return text_file(header.union(fx.alignments(spark, sf).select(F.expr(SAM).alias("value"))), "sam", compression)


@query("select concat('r', qname) qname, strand0 * 16 flag, concat('chr', chrom_index1) rname, pos1, mapq, concat(ref_span, 'M') cigar, aln_i xi, 0.5::double de, mapq::int ip from fx_aln")
def s1_sam(spark, sf):
    df = records.sam(spark, sam_file(spark, sf))
    return df.select("qname", "flag", "rname", "pos1", "mapq", "cigar", records.tag("xi", "i").alias("xi"), records.tag("de", "f").cast("double").alias("de"), F.get(records.tag("ip", "B"), F.lit(1)).alias("ip"))


@query("select concat('chr', chrom_index1) rname, count(*) n, min(pos1) first, max(pos1) as last from fx_aln group by 1")
def s2_s3_split_by_chrom(spark, sf):
    """Alignments of a SAM file fanned out to a folder for each chromosome, and one folder at a time read back."""
    path = folder(spark, "by-chrom")
    records.sam(spark, sam_file(spark, sf)).write.partitionBy("rname").parquet(path)
    return spark.read.parquet(path).groupBy("rname").agg(F.count("*").alias("n"), F.min("pos1").alias("first"), F.max("pos1").alias("last"))


@query("select concat('d', doc_id) qname, 'c x' as comment, substr(seq, 1, 50) seq, repeat('I', least(50, length(seq))::int) qual, length(substr(seq, 1, 50)) >= 40 passes_size from fx_seq where seq <> ''")
def s4_fastq(spark, sf):
    s = fx.sequences(spark, sf).where("seq <> ''")
    path = text_file(s.select(F.expr(r"concat('@d', doc_id, ' c x\n', seq, '\n+\n', repeat('I', char_length(seq)))").alias("value")), "fastq")
    return records.fastq_reads(spark, f"{path}/*.txt", 40, 50).select("qname", "comment", "seq", "qual", "passes_size")


@query("select concat('c', doc_id) chrom, i * 1000 start0, substr(seq, i * 1000 + 1, 1016) seq from fx_seq, unnest(range(0, (length(seq) + 999) // 1000)) t(i) where seq <> ''")
def s6_fasta(spark, sf):
    s = fx.sequences(spark, sf).where("seq <> ''")
    path = text_file(s.select(F.expr(r"concat('>c', doc_id, ' made up\n', regexp_replace(seq, '(.{60})(?=.)', '$1\n'))").alias("value")), "fasta")
    records.register(spark)
    return spark.read.format("fasta").option("path", f"{path}/*.txt").option("chunk", "1000").option("overlap", "16").load()


@query("select concat('chr', chrom_index1) chrom, greatest(start0 - 10, 0) start0, end1 + 10 end1, name, kind::double score, case when kind = 1 then '-' else '+' end strand from fx_region")
def s7_bed(spark, sf):
    r = fx.regions(spark, sf).select(F.expr("concat_ws('\t', 'chr' || chrom_index1, format_number(start0, 0), cast(end1 as string), name, cast(kind as string), if(kind = 1, '-', '+\r'))").alias("value"))
    return records.bed(spark, text_file(spark.sql("select '#made up' as value union all select 'track x'").union(r), "bed"), 10)


@query("""select concat('chr', c) chrom, min(s) start0, max(e) end1, name, max(e) - min(s) as length, '+' strand from (
  select chrom_index1 c, concat('g', kind) as name, start0 s, end1 e from fx_region union all select chrom_index1, concat('g', kind), end1 + 99, end1 + 200 from fx_region) group by c, name""")
def s8_gtf(spark, sf):
    line = "concat('chr{0}', {1}, '\\tx\\t', '{2}', '\\t', {3}, '\\t', {4}, '\\t.\\t', '{5}', '\\t.\\tgene_id \"i\"; gene_name \"g', kind, '\";')"
    made = [line.format("", "chrom_index1", "exon", "start0 + 1", "end1", "+"), line.format("", "chrom_index1", "exon", "end1 + 100", "end1 + 200", "+"), line.format("", "chrom_index1", "CDS", "1", "9999999", "-"), line.format("1_alt", "chrom_index1", "exon", "1", "2", "+")]
    r = fx.regions(spark, sf).select(F.explode(F.array(*map(F.expr, made))).alias("value"))
    return records.gtf_genes(spark, text_file(r, "gtf"))


@query("select 'e' || cast(p_partkey % 40 as varchar) enzyme, cast(p_partkey % 4 as varchar) \"CpG_priority\" from part where p_partkey % 4 in (1, 2) group by all")
def s10_enzymes(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet").selectExpr("'e' || p_partkey % 40 as enzyme", "cast(p_partkey % 4 as string) as CpG_priority").distinct()
    path = folder(spark, "enzymes")
    p.write.option("header", True).csv(path)
    return records.enzymes(spark, path, priorities=(1, 2))


@query("select cast(chrom_index1 as varchar) chrom_index1, cast(pos1 as varchar) pos1, cast(qname as varchar) qname from fx_aln")
def s11_tsv(spark, sf):
    path = folder(spark, "tsv")
    records.write_tsv(fx.alignments(spark, sf).select("chrom_index1", "pos1", "qname"), path)
    return spark.read.option("sep", "\t").csv(path).toDF("chrom_index1", "pos1", "qname")


@query("select chrom_index1, site_pos1, 'sites' bundle from (select distinct * from fx_site) union all select chrom_index1, chrom_size, 'chroms' from fx_chrom")
def s15_s17_bundle(spark, sf):
    """A bundle of named tables with its manifest, from which they are found again."""
    import json

    tables = {"sites": fx.sites(spark, sf).distinct(), "chroms": fx.chroms(spark).withColumnRenamed("chrom_size", "site_pos1")}
    paths = {n: folder(spark, n) for n in tables}
    for n, df in tables.items():
        df.write.parquet(paths[n])
    listed = json.loads(inputs.manifest(tables, paths))
    both = [spark.read.parquet(t["path"]).select(*t["columns"], F.lit(n).alias("bundle")) for n, t in listed.items()]
    return both[0].unionByName(both[1])


@query("""select * from (values ('ONT_frag', 'size', '7'), ('ONT_frag', 'max_size', '100'), ('ONT_frag', 'simplex', '1'), ('ONT_frag', 'compatible_platforms', 'ONT,PacBio'), ('ONT_frag', 'platform', 'ONT'), ('ONT_frag', 'library', 'frag')) v(name, setting, value)""")
def s19_settings(spark, sf):
    platforms, libraries = {"ONT": {"max_size": "100", "simplex": "1"}, "X": {}}, {"frag": {"size": "5", "compatible_platforms": "ONT,PacBio"}}
    return inputs.long_form(spark, {"ONT_frag": inputs.settings(platforms, libraries, "ONT", "frag", {"size": "7", "simplex": ""})})


@query("select * from (values ('.fastq.gz', 'a_R1.fastq.gz', 'a_R2.fastq.gz'), ('.fastq.gz', 'b_R1.fastq.gz', 'b_R2.fastq.gz')) v(kind, one, two)")
def s5_discovery(spark, sf):
    kind, files = inputs.discover(["b_R2.fastq.gz", "a_R1.fastq.gz", "x.bam", "b_R1.fastq.gz", "a_R2.fastq.gz", "notes.txt"])
    return spark.createDataFrame([(kind, *f) for f in files], "kind string, one string, two string")


@query("select concat('m/', doc_id, '/ccs') qname, 4 flag, seq, repeat('?', length(seq)::int) qual, concat('=', length(seq)) dd from fx_seq where seq <> ''")
def s21_unaligned_rows(spark, sf):
    s = fx.sequences(spark, sf).where("seq <> ''").select(F.lit("m").alias("movie"), col("doc_id").alias("zmw"), "seq", F.expr("array_repeat(30, char_length(seq))").alias("qual"), F.concat(F.lit("="), F.char_length("seq").cast("string")).alias("dd"))
    return records.ubam_rows(s).select("qname", "flag", "seq", "qual", col("tags")["dd"].alias("dd"))


@query("select concat('r', qname) qname, pos1, concat(':', ref_span) cs, 2 n_tags from fx_aln")
def p31_stage_tags(spark, sf):
    kept = records.keep_tags(records.sam(spark, sam_file(spark, sf)), "variants")
    return kept.select("qname", "pos1", col("tags")["cs"].alias("cs"), F.size("tags").alias("n_tags"))


@query("""select doc_id, concat(substr(seq, 4, 9), '+', '--', substr(seq, 16, 5), substr(seq, 21)) expanded from (
  select doc_id, seq from fx_seq where length(seq) >= 30)""")
def f3_query_on_reference(spark, sf):
    s = fx.sequences(spark, sf).where("length(seq) >= 30").withColumn("cigar", F.expr("concat('3S10M2I2D5M', char_length(seq) - 20, 'M')"))
    return s.select("doc_id", codec.query_on_reference(col("cigar"), col("seq")).alias("expanded"))


def finished(stream: DataFrame, mode: str, name: str, once: bool = False) -> DataFrame:
    """All rows of a stream over the files that are there, by way of files, as there may be more than the driver can hold.

    ``once``: in a single batch, for streams with timers, which never end by themselves.
    """
    spark, path = stream.sparkSession, folder(stream.sparkSession, name)
    spark.createDataFrame([], stream.schema).write.parquet(path)  # of no input there is no batch
    out = stream.writeStream.outputMode(mode).trigger(**{"once" if once else "availableNow": True}).option("checkpointLocation", folder(spark, "stream"))
    if mode == "append":
        out = out.format("parquet").option("path", path)
    else:
        out = out.foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(path))  # each batch has all rows
    out.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("select concat('r', qname) qname, count(*) n_alns from fx_aln group by 1")
def r1_stream_counts(spark, sf):
    return finished(streams.count_reads(spark.readStream.text(sam_file(spark, sf, "gzip"))), "complete", "r1")


@query("select qname movie, qname * 2 zmw, 'pair' outcome, 'A' seq0, 'T' seq1 from fx_aln where aln_i = 0 and qname % 3 <> 0")
def r2_stream_pairs(spark, sf):
    """Strands that find their partner; a third of them have none and wait."""
    path = folder(spark, "strands")
    a = fx.alignments(spark, sf).where("aln_i = 0").selectExpr("cast(qname as string) as movie", "qname * 2 as zmw", "explode(if(qname % 3 = 0, array(0), array(0, 1))) as strand")
    a.withColumn("seq", F.when(col("strand") == 0, "A").otherwise("T")).write.parquet(path)
    s = spark.readStream.schema("movie string, zmw bigint, strand int, seq string").parquet(path)
    # timers of strands that wait keep such a stream busy, so that it never ends by itself
    return finished(streams.pair_strands(s, 3_600_000), "append", "r2", once=True).where("outcome = 'pair'").withColumn("movie", col("movie").cast("bigint"))


@query("select chrom_index1, least(count(*), 25) n from fx_aln group by 1")
def r3_stream_cap(spark, sf):
    path = folder(spark, "rows")
    fx.alignments(spark, sf).select("chrom_index1", "qname").write.parquet(path)
    s = spark.readStream.schema("chrom_index1 bigint, qname bigint").parquet(path)
    return finished(streams.capped(s, "chrom_index1", "chrom_index1 bigint, qname bigint", 25), "append", "r3").groupBy("chrom_index1").agg(big(F.count("*")).alias("n"))


@query("select concat('r', qname) qname, mapq from fx_aln")
def r5_stream_map(spark, sf):
    lines = spark.readStream.text(sam_file(spark, sf, "gzip")).where("value not like '@%'")
    return finished(streams.map_records(lines, qname=F.substring_index("value", "\t", 1), mapq=F.get(F.split("value", "\t"), F.lit(4)).cast("bigint")), "append", "r5")


@query("select chrom_index1, pos0, n_ref, alt_bases, row_number() over (order by chrom_index1, pos0, n_ref, alt_bases) as place from (select distinct chrom_index1, pos1 pos0, aln_i n_ref, substr('ACGT', (mapq % 4 + 1)::int, 1) alt_bases from fx_aln)")
def t5_variant_order(spark, sf):
    v = fx.alignments(spark, sf).selectExpr("chrom_index1", "pos1 as pos0", "aln_i as n_ref", "substring('ACGT', int(mapq % 4 + 1), 1) as alt_bases").distinct()
    return snv.ordered_variants(v, "place")
