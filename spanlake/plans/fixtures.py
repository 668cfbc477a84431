"""Domain inputs projected from the supplied tables, as Spark frames and as DuckDB CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ALIGNMENTS = """
select l_orderkey as qname,
  cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) - 1 as bigint) as aln_i,
  cast(l_suppkey % 5 + 1 as bigint) as chrom_index1,
  cast((l_partkey % 20) * 1000 + l_linenumber * 3 + 1 as bigint) as pos1,
  cast(case when l_returnflag = 'R' then 1 else 0 end as bigint) as strand0,
  cast(l_quantity as bigint) * 20 as ref_span,
  cast(60 - 2 * round(l_discount * 100) as bigint) as mapq,
  cast(round(l_tax * 100) as bigint) as div_pct,
  cast(l_suppkey % 11 - 5 as bigint) as jxn_offset
from {lineitem}"""
SITES = "select cast(p_partkey % 5 + 1 as bigint) as chrom_index1, cast(p_partkey * 10 + 1 as bigint) as site_pos1 from {part}"
REGIONS = """
select cast(c_custkey % 5 + 1 as bigint) as chrom_index1, cast((c_custkey * 7919) % 19000 as bigint) as start0,
  cast((c_custkey * 7919) % 19000 + 50 + (c_custkey % 7) * 30 as bigint) as end1, c_name as name, cast(c_nationkey % 3 as bigint) as kind
from {customer}"""
SEQUENCES = """
select doc_id, translate(lower(regexp_replace(text, '[^a-zA-Z]', ''{G})),
  'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') as seq
from {documents}"""


def view(spark: SparkSession, sf_dir: str, sql: str, **frames: DataFrame) -> DataFrame:
    names = [t for t in ("lineitem", "part", "customer", "documents", "orders", "supplier", "events") if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names}, **frames)


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, ALIGNMENTS)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, SITES)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, REGIONS)


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, SEQUENCES.replace("{G}", ""))


def chroms(spark: SparkSession) -> DataFrame:
    """Five synthetic chromosomes."""
    return spark.range(1, 6).selectExpr("id as chrom_index1", "30000 + id * 1000 as chrom_size")


def _duck(sql: str) -> str:
    for t in ("lineitem", "part", "customer", "documents"):
        sql = sql.replace("{" + t + "}", t)
    return sql.replace("{G}", ", 'g'")


#: CTEs that every oracle starts with.
DUCK = (
    f"with recursive fx_aln as ({_duck(ALIGNMENTS)}), fx_site as ({_duck(SITES)}), fx_region as ({_duck(REGIONS)}), fx_seq as ({_duck(SEQUENCES)}), "
    "fx_chrom as (select cast(range as bigint) chrom_index1, cast(30000 + range * 1000 as bigint) chrom_size from range(1, 6))"
)
