"""Ordered scans along a chromosome in blocks of positions, so that tasks follow the data and not the chromosomes.

A window over a whole chromosome is one task, however long it is.  Here rows are windowed within (chromosome, block of
positions); what a block takes over from those before or after it comes from a table with one row for each block,
which alone is windowed over the chromosome.  That table has a genome's length / ``WIDTH`` rows, whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions of a block.
WIDTH = 1 << 18


def scan(df: DataFrame, by: list[str], pos: str, order: list[str], width: int = WIDTH, **wanted: tuple[str, Column]) -> DataFrame:
    """``df`` with a column for each of ``wanted``: name=(kind, value), along ``order`` (which starts with ``pos``) within ``by``.

    Kinds: ``sum`` (up to this row), ``max_before`` and ``min_after`` (of all rows before, after), ``lag`` and ``lead`` (one row away); null
    where there is no such row.  Null values don't count, but ``lag`` and ``lead`` don't skip them.
    """
    rows = df.withColumns({"_b": F.floor(F.col(pos) / width)} | {f"_v_{n}": F.struct(v.alias("v")) if kind in ("lag", "lead") else v for n, (kind, v) in wanted.items()})
    place = F.struct(*order)
    own = Window.partitionBy(*by, "_b").orderBy(*order)
    # frames only look back: an unbounded following frame is quadratic
    down = Window.partitionBy(*by, "_b").orderBy(*(F.col(c).desc() for c in order))
    blocks, blocks_down = Window.partitionBy(*by).orderBy("_b"), Window.partitionBy(*by).orderBy(F.col("_b").desc())
    before, upto = (Window.unboundedPreceding, -1), (Window.unboundedPreceding, Window.currentRow)
    totals, carried, within = [], {}, {}
    for n, (kind, _) in wanted.items():
        v, t = F.col(f"_v_{n}"), F.col(f"_t_{n}")
        agg, carry, here = {
            "sum": (F.sum(v), F.sum(t).over(blocks.rowsBetween(*before)), F.sum(v).over(own.rowsBetween(*upto))),
            "max_before": (F.max(v), F.max(t).over(blocks.rowsBetween(*before)), F.max(v).over(own.rowsBetween(*before))),
            "min_after": (F.min(v), F.min(t).over(blocks_down.rowsBetween(*before)), F.min(v).over(down.rowsBetween(*before))),
            "lag": (F.max_by(v, place), F.lag(t).over(blocks), F.lag(v).over(own)),
            "lead": (F.min_by(v, place), F.lead(t).over(blocks), F.lead(v).over(own)),
        }[kind]
        totals.append(agg.alias(f"_t_{n}"))
        carried[f"_c_{n}"], within[f"_w_{n}"] = carry, here
    keys = [*by, "_b"]
    edge = rows.groupBy(*keys).agg(*totals).withColumns(carried).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *carried)
    out = rows.withColumns(within)
    joined = out.join(edge, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "left")
    result = []
    for n, (kind, _) in wanted.items():
        c, w = F.col(f"_c_{n}"), F.col(f"_w_{n}")
        both = {"sum": F.when(c.isNotNull(), F.coalesce(w, F.lit(0)) + c).otherwise(w), "max_before": F.greatest(w, c), "min_after": F.least(w, c)}.get(kind, F.coalesce(w, c)["v"])
        result.append(both.alias(n))
    return joined.select(*(x for x in df.columns if x not in wanted), *result)


def number_groups(values: DataFrame, by: list[str], value: str, out: str, starts: Callable[[Column, Column], Column], width: int = WIDTH) -> DataFrame:
    """Distinct ``values`` with ``out``: how many of them up to this one start a group; ``starts(value, the one before)`` says which.

    The first value of all starts one.  One pass: groups are counted within blocks, and a block's first value is
    compared with the last one before it in the table of blocks.
    """
    rows = values.withColumn("_b", F.floor(F.col(value) / width))
    own = Window.partitionBy(*by, "_b").orderBy(value)
    before = F.lag(value).over(own)
    rows = rows.withColumn("_inner", F.when(before.isNull(), 0).when(starts(F.col(value), before), 1).otherwise(0))
    rows = rows.withColumn("_in", F.sum("_inner").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    keys = [*by, "_b"]
    blocks = Window.partitionBy(*by).orderBy("_b")
    edge = rows.groupBy(*keys).agg(F.min(value).alias("_first"), F.max(value).alias("_last"), F.sum("_inner").alias("_n"))
    last = F.lag("_last").over(blocks)
    edge = edge.withColumn("_new", F.when(last.isNull() | starts(F.col("_first"), last), 1).otherwise(0))
    upto = F.sum(F.col("_n") + F.col("_new")).over(blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    edge = edge.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), upto.alias("_upto"))
    joined = rows.join(edge, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return joined.select(*values.columns, (F.col("_in") + F.col("_upto")).alias(out))
