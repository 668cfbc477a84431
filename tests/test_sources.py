"""Readers, discovery, exports and streams over small files."""

import time

import pytest
from conftest import SF, same_rows
from pyspark.sql import functions as F

from spanlake.sources import inputs, records
from spanlake.streaming import records as streams


def test_sam(spark, tmp_path):
    p = tmp_path / "a.sam"
    p.write_text("@HD\tVN:1.6\nr1\t0\tchr1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\tde:f:0.1\tip:B:C,1,2\nr2\t16\tchr1\t9\t0\t*\t*\t0\t0\t*\t*\n")
    df = records.sam(spark, str(p))
    got = df.select("qname", "flag", records.tag("de", "f").alias("de"), records.tag("ip", "B").alias("ip")).orderBy("qname").collect()
    assert [(r.qname, r.flag) for r in got] == [("r1", 0), ("r2", 16)]
    assert got[0].ip == [1, 2] and abs(got[0].de - 0.1) < 1e-6 and got[1].de is None
    assert records.sam_header(spark, str(p)).count() == 1


def test_fastq_and_fasta(spark, tmp_path):
    q = tmp_path / "x.fastq"
    q.write_text("@r1 c\nACGT\n+\nIIII\n@r2\nAC\n+\nII\n")
    got = records.fastq_reads(spark, str(q), min_size=3, max_length=3).orderBy("qname").collect()
    assert [(r.qname, r.seq, r.passes_size) for r in got] == [("r1", "ACG", True), ("r2", "AC", False)]
    f = tmp_path / "g.fa"
    f.write_text(">c1 x\nACGTAC\nGTACGT\n>c2\nTT\n")
    records.register(spark)
    df = spark.read.format("fasta").option("path", str(f)).option("chunk", "5").option("overlap", "0").load()
    assert [(r.chrom, r.start0, r.seq) for r in df.orderBy("chrom", "start0").collect()] == [("c1", 0, "ACGTA"), ("c1", 5, "CGTAC"), ("c1", 10, "GT"), ("c2", 0, "TT")]
    assert records.fasta_range(df, "c1", 3, 11).first()["seq"] == "TACGTACG"


def test_bed_and_gtf(spark, tmp_path):
    b = tmp_path / "a.bed"
    b.write_text("#c\nchr1\t1,000\t2000\tx\t5\t+\r\nchr2\t5\t9\n")
    assert [(r.chrom, r.start0, r.end1) for r in records.bed(spark, str(b), padding=10).orderBy("chrom").collect()] == [("chr1", 990, 2010), ("chr2", 0, 19)]
    bad = tmp_path / "bad.bed"
    bad.write_text("chr1\t9\t5\n")
    with pytest.raises(Exception, match="bad BED line"):
        records.bed(spark, str(bad)).collect()
    g = tmp_path / "a.gtf"
    line = 'chr1\ts\texon\t{}\t{}\t.\t{}\t.\tgene_name "{}";\n'
    g.write_text("#h\n" + line.format(11, 20, "+", "G") + line.format(31, 40, "+", "G") + line.format(1, 6_000_000, "-", "BIG") + line.format(1, 2, "+", "Z").replace("chr1", "chr1_alt"))
    assert [tuple(r) for r in records.gtf_genes(spark, str(g)).collect()] == [("chr1", 10, 40, "G", 30, "+")]


def test_chromosome_order(spark, tmp_path):
    f = tmp_path / "a.fai"
    f.write_text("chrM\t5\t0\t1\t1\nchrII\t2\t9\t1\t1\nchrI\t1\t20\t1\t1\n")
    assert [(r.chrom, r.chrom_index1) for r in records.fai(spark, str(f)).orderBy("chrom_index1").collect()] == [("chrI", 1), ("chrII", 2), ("chrM", 3)]
    assert [r.chrom for r in records.fai(spark, str(f), "file").orderBy("chrom_index1").collect()] == ["chrM", "chrII", "chrI"]


def test_range_table(spark, tmp_path):
    df = spark.createDataFrame([(c, p) for c in (1, 2) for p in range(50)], "chrom_index1 bigint, pos1 bigint")
    records.write_indexed(df, str(tmp_path / "t"))
    assert records.read_range(spark, str(tmp_path / "t"), 2, 10, 12).count() == 3
    records.write_tsv(df, str(tmp_path / "tsv"))
    assert spark.read.option("sep", "\t").csv(str(tmp_path / "tsv")).count() == 100


def test_discovery():
    assert inputs.discover(["a.bam", "a.fastq.gz"]) == (".fastq.gz", [("a.fastq.gz",)])
    assert inputs.discover(["s_R2.fastq.gz", "s_R1.fastq.gz"]) == (".fastq.gz", [("s_R1.fastq.gz", "s_R2.fastq.gz")])
    assert inputs.discover(["b.unaligned.bam", "a.fastq"])[0] == ".unaligned.bam"
    with pytest.raises(ValueError):
        inputs.discover(["s_R1.fastq", "s_R2.fastq", "t_R1.fastq"])
    with pytest.raises(ValueError):
        inputs.list_samples(["x"] * 33)


def test_settings(tmp_path):
    (tmp_path / "p.csv").write_text("setting,ONT,PacBio\nmax_size,100,200\nsimplex,1,0\n")
    (tmp_path / "l.csv").write_text("setting,frag\nsize,5\ncompatible_platforms,ONT\n")
    p, lib = inputs.transposed(str(tmp_path / "p.csv")), inputs.transposed(str(tmp_path / "l.csv"))
    s = inputs.settings(p, lib, "ONT", "frag", {"size": "7", "simplex": ""})
    assert s["size"] == "7" and s["simplex"] == "1" and s["max_size"] == "100"
    with pytest.raises(ValueError):
        inputs.settings(p, lib, "PacBio", "frag")


def test_stream_counts_and_caps(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.sam").write_text("@HD\nr1\tx\nr1\ty\nr2\tz\n")
    q = streams.count_reads(spark.readStream.text(str(src))).writeStream.format("memory").queryName("n_reads").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(tuple(r) for r in spark.sql("select * from n_reads").collect()) == [("r1", 2), ("r2", 1)]


def test_stream_pairs(spark, tmp_path):
    src = str(tmp_path / "in")
    schema = "movie string, zmw bigint, strand int, seq string"
    spark.createDataFrame([("m", 1, 0, "A"), ("m", 1, 1, "T"), ("m", 2, 0, "C")], schema).write.parquet(src)
    q = streams.pair_strands(spark.readStream.schema(schema).parquet(src)).writeStream.format("memory").queryName("pairs").outputMode("append").start()
    # a timer keeps such a stream busy, so it never reports that all is processed
    until = time.time() + 120
    while time.time() < until and not spark.sql("select * from pairs").count():
        time.sleep(1)
    q.stop()
    assert [(r.zmw, r.outcome, r.seq0, r.seq1) for r in spark.sql("select * from pairs").collect()] == [(1, "pair", "A", "T")]
    assert F is not None


def test_stream_rows_come_from_files(spark):
    from spanlake.plans import files

    for name in ("r1_stream_counts", "r5_stream_map"):
        found = files.QUERIES[name](spark, SF)
        assert found.inputFiles() and found.count()  # not from the driver's memory


def test_stream_without_input(spark, tmp_path):
    from spanlake.plans import files

    (tmp_path / "in").mkdir()
    lines = spark.readStream.text(str(tmp_path / "in"))
    assert files.finished(streams.count_reads(lines), "complete", "none").collect() == []
    assert files.finished(streams.map_records(lines, value=F.col("value")), "append", "none").collect() == []


def test_pairs_don_t_depend_on_the_clock(spark, duck, monkeypatch):
    from types import SimpleNamespace

    from spanlake.plans import files

    ticks = iter(range(0, 10**9, 1000))
    monkeypatch.setattr(files, "time", SimpleNamespace(time=lambda: next(ticks), sleep=time.sleep), raising=False)
    assert same_rows(files.r2_stream_pairs(spark, SF), duck.sql(files.ORACLES["r2_stream_pairs"]))


def test_pairs_over_batches(spark, tmp_path, monkeypatch):
    """All molecules in one group: strands meet over batches, the last of a strand counts, and what waits too long is an orphan."""
    monkeypatch.setattr(streams, "GROUPS", 1)
    schema = "movie string, zmw bigint, strand int, seq string"
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    big = 2**53 + 1

    def batch(rows, wait_ms):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        pairs = streams.pair_strands(spark.readStream.schema(schema).parquet(src), wait_ms)
        pairs.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(once=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(pairs.schema).parquet(out).select("zmw", "outcome", "seq0", "seq1").collect())

    first = batch([("m", big, 0, "A"), ("m", big, 1, "T"), ("m", 2, 0, "C"), ("m", 3, 1, "G")], 3_600_000)
    assert first == [(big, "pair", "A", "T")]
    second = batch([("m", 2, 0, "CC"), (None, 2, 1, "X"), ("m", 2, 1, "GG"), ("m", big, 0, "A")], 3_600_000)
    assert sorted(set(second) - set(first)) == [(2, "pair", "CC", "GG")]
    third = batch([("m", 9, 0, "N")], 0)
    assert sorted(set(third) - set(second)) == [(9, "orphan", "N", None)]


def test_stage_tags(spark, tmp_path):
    p = tmp_path / "a.sam"
    p.write_text("r1\t0\tc\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\tcs:Z::4\tzz:i:1\n")
    assert records.keep_tags(records.sam(spark, str(p)), "variants").first()["tags"] == {"cs": ":4"}
