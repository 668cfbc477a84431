"""Optional streaming ingestion: keyed pairing with orphans, capped emission, one-record maps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Molecules are dealt to so many groups; a group's waiting strands are one state, so that Python is called for groups and not for molecules.
GROUPS = 512
PAIRED = "movie string, zmw string, outcome string, seq0 string, seq1 string"
WAITING = "movie array<string>, zmw array<string>, seq0 array<string>, seq1 array<string>, until array<bigint>"


def pair_strands(strands: DataFrame, wait_ms: int = 60_000) -> DataFrame:
    """Stream of (movie, zmw, strand, seq): a strand waits in state for its partner; after ``wait_ms`` it is an orphan."""
    key, ends = ["movie", "zmw"], ["seq0", "seq1"]
    names = [*key, *ends, "until"]

    def update(_group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        rows = pd.DataFrame(dict(zip(names, state.get)) if state.exists else {n: [] for n in names}, columns=names, dtype=object)
        new = [pdf[[*key, "strand", "seq"]] for pdf in batches if len(pdf)]
        if new:
            got = pd.concat(new, ignore_index=True)
            if not got["strand"].isin([0, 1]).all():
                raise ValueError("strands are 0 or 1")
            # a molecule's last row of each strand counts, in this batch or what waits from those before
            last = got.drop_duplicates([*key, "strand"], keep="last")
            either = [last.loc[last["strand"] == k, [*key, "seq"]].rename(columns={"seq": f"new{k}"}).assign(**{f"has{k}": True}) for k in (0, 1)]
            met = either[0].merge(either[1], "outer", key)
            rows = rows.merge(met, "outer", key)
            for k, end in enumerate(ends):
                rows[end] = rows[f"new{k}"].where(rows[f"has{k}"].notna(), rows[end])
            rows["until"] = rows["until"].where(rows["has0"].isna() & rows["has1"].isna(), now + wait_ms)
        rows = rows[names].astype(object)
        rows = rows.where(rows.notna(), None)
        pair = rows["seq0"].notna() & rows["seq1"].notna()
        late = ~pair & (rows["until"] <= now)
        out = rows.assign(outcome=pair.map({True: "pair", False: "orphan"})).loc[pair | late, [*key, "outcome", *ends]]
        rows = rows[~(pair | late)]
        if len(rows):
            state.update(tuple(rows[n].tolist() for n in names))
            state.setTimeoutDuration(max(1, int(rows["until"].min()) - now))
        elif state.exists:
            state.remove()
        if len(out):
            yield out

    dealt = strands.select(F.col("movie"), F.col("zmw").cast("string").alias("zmw"), "strand", "seq", F.pmod(F.xxhash64("movie", "zmw"), F.lit(GROUPS)).alias("_group"))
    paired = dealt.groupBy("_group").applyInPandasWithState(update, PAIRED, WAITING, "append", GroupStateTimeout.ProcessingTimeTimeout)
    return paired.withColumn("zmw", F.col("zmw").cast("bigint"))


def capped(rows: DataFrame, key: str, columns: str, n: int) -> DataFrame:
    """At most ``n`` rows of each key over the whole stream; the state is one count for each key."""
    names = [c.split()[0] for c in columns.split(", ")]

    def update(_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (seen,) = state.get if state.exists else (0,)
        for pdf in batches:
            take = pdf[names].iloc[: max(0, n - seen)]
            seen += len(pdf)
            if len(take):
                yield take
        state.update((min(seen, n),))

    return rows.groupBy(key).applyInPandasWithState(update, columns, "seen bigint", "append", GroupStateTimeout.NoTimeout)


def count_reads(lines: DataFrame) -> DataFrame:
    """Running number of alignments of each read of a SAM text stream."""
    return lines.where(~F.col("value").startswith("@")).groupBy(F.substring_index("value", "\t", 1).alias("qname")).agg(F.count("*").alias("n_alns"))


def map_records(lines: DataFrame, **columns) -> DataFrame:
    """One-record map of a stream."""
    return lines.select(*(c.alias(n) for n, c in columns.items()))
