"""The ``opN_*`` queries over the supplied tables, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprints, license_scan, line_dedup, near_dedup, packing, pii, quality_crf, toxicity, url_reputation
from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, _ = url_reputation.split_url(F.col("url"))
    outcomes = url_reputation.page_outcomes(pages.select("url", "html")).select(host.alias("host"), "outcome")
    return url_reputation.judge(pages, outcomes)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents")).drop("found")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def queries() -> dict:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_quality_crf": op2_quality_crf,
        "op3_url_reputation": op3_url_reputation,
        "op4_toxicity": op4_toxicity,
        "op5_decontamination": op5_decontamination,
        "op6_license_scan": op6_license_scan,
        "op7_packing": op7_packing,
        "op8_pii": op8_pii,
        "op9_fingerprints": op9_fingerprints,
        "op10_near_dedup": op10_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.ORACLE,
        "op3_url_reputation": url_reputation.ORACLE,
        "op10_near_dedup": near_dedup.oracle(3, 85),
    }
