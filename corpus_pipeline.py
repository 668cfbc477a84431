"""Corpus pipeline: quality, line dedup, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns what it kept, with the columns of ``documents`` (the last one
its packed pieces).  ``run`` writes each stage's rows to the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm import decontaminate, line_dedup, near_dedup, packing, quality_crf
from spanlake.llm.common import scratch, table


def plain_names(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but doc_id and text renamed, so that none clashes with a stage's own."""
    return docs.toDF(*(n if n in ("doc_id", "text") else f"c{i}" for i, n in enumerate(docs.columns)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject (score of at least 1/2)."""
    model = quality_crf.quality_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    plain = plain_names(docs)
    return quality_crf.score(plain, model, plain.columns).where("score >= 0.5").drop("score").toDF(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that an earlier line of the corpus matches; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(plain_names(docs)).drop("removed").toDF(*docs.columns)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least doc_id, of each group of near-duplicates (five words, similarity 0.8).

    Rows of one doc_id are one document, of which the row of the least text stays; rows with a null doc_id stay.
    """
    gone = near_dedup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    several = left.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    row = F.struct(*left.columns)
    one = left.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, F.struct(F.col("text"), F.xxhash64(row))).alias("_row"))
    return left.join(several, "doc_id", "left_anti").select(docs.columns).union(one.select("_row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in windows of 2048."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: The classifier, the alignment and the packing have no SQL form; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
