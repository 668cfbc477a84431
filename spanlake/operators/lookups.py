"""Merges, lookups and choices of rows that several steps share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def left_merge(left: DataFrame, right: DataFrame, keys: list[str], missing: int = 0) -> DataFrame:
    """All rows of ``left`` with the columns of ``right``; numbers that are missing are ``missing``."""
    return left.join(right, keys, "left").na.fill(missing)


def summed_union(parts: list[DataFrame], keys: list[str], value: str, out: str) -> DataFrame:
    """Counts of several tables added up by key."""
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum(value).alias(out))


def with_chrom_sizes(df: DataFrame, chroms: DataFrame) -> DataFrame:
    """Rows with their chromosome's columns; ``chroms`` has one row for each chromosome of a genome."""
    return df.join(F.broadcast(chroms), "chrom_index1")


def rows_of_keys(df: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a set of keys."""
    return df.join(chosen.select(key), key, "left_semi")


def reads_of_groups(grouped: DataFrame, paths: DataFrame, keys: list[str]) -> DataFrame:
    """Each group's reads, once, with their paths' columns."""
    return grouped.select(*keys, "qname").distinct().join(paths, "qname")


def touching(junctions: DataFrame, low: int, high: int) -> DataFrame:
    """Junctions of which either node lies in [low, high]."""
    return junctions.where(F.abs("node1").between(low, high) | F.abs("node2").between(low, high))


def group_exact(junctions: DataFrame) -> DataFrame:
    """Equal junctions with their number and their reads' names in order (``qnames``)."""
    items = F.array_sort(F.collect_list(F.struct("qname", "aln_i")))
    out = junctions.groupBy("node1", "node2", "jxn_offset").agg(F.count("*").alias("n"), items.alias("_items"))
    return out.withColumn("qnames", F.array_join(F.transform("_items", lambda x: x["qname"].cast("string")), ",")).drop("_items")


def representative(grouped: DataFrame, keys: list[str], value: str = "node1") -> DataFrame:
    """Most frequent value of each group, the least of equals, and its number ``n``."""
    n = grouped.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg(F.max_by(value, F.struct("n", -F.col(value))).alias(value), F.max("n").alias("n"))


def kept_where(column: Column, condition: Column) -> Column:
    """A column whose values go where the condition doesn't hold, as for reads that later steps don't use."""
    return F.when(condition, column)


def tallied(final: DataFrame, seen: str = "n_instances") -> DataFrame:
    """Final junctions that tallies count: seen once, or three times and more; translocations, or over 1000 bases."""
    return final.where(((F.col(seen) == 1) | (F.col(seen) >= 3)) & ((F.col("type_bits") == 8) | (F.col("sv_size") > 1000)))


def ranked(df: DataFrame, value: str, tie: str) -> DataFrame:
    """A small table with its rows' places by falling value (``rank``); one row for each enzyme or library."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(value), tie)).cast("bigint"))


def best_and_worst(df: DataFrame, key: str, value: str, by: str, tie: str) -> DataFrame:
    """Value of each key's row of the most and of the least ``by``; the least ``tie`` of equals."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(by, -F.col(tie))).alias("best"), F.min_by(value, F.struct(by, tie)).alias("worst"))
