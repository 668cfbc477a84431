"""Discovery of inputs, sample tables, configuration, and the manifest of outputs (driver side, no data)."""

from __future__ import annotations

import csv
import json

from pyspark.sql import DataFrame, SparkSession

from .records import read_name_patterns

#: Kinds of read files, the first found wins.
PRECEDENCE = [".unaligned.bam", ".fastq.gz", ".fastq", ".bam", ".cram"]
MOST_SAMPLES = 32


def discover(names: list[str]) -> tuple[str, list[tuple[str, ...]]]:
    """(kind, files): FASTQ files as pairs if their names pair up; an unpaired mate is an error."""
    for kind in PRECEDENCE:
        found = sorted(n for n in names if n.endswith(kind) and not (kind == ".bam" and n.endswith(PRECEDENCE[0])))
        if not found:
            continue
        if not kind.startswith(".fastq"):
            return kind, [(n,) for n in found]
        pairs: dict = {}
        for n in found:
            m = read_name_patterns().match(n)
            pairs.setdefault((m["base"], m["rest"]) if m else (n, ""), {})[m["mate"] if m else "1"] = n
        sizes = {len(p) for p in pairs.values()}
        if sizes == {2}:
            return kind, [(p["1"], p["2"]) for _, p in sorted(pairs.items())]
        if sizes == {1}:
            return kind, [tuple(p.values()) for _, p in sorted(pairs.items())]
        raise ValueError("read 1 and read 2 files don't pair up")
    raise ValueError("no read files")


def list_samples(prefixes: list[str], merging: bool = False) -> list[str]:
    if len(prefixes) > MOST_SAMPLES:
        raise ValueError(f"more than {MOST_SAMPLES} samples")
    if merging and len(prefixes) < 2:
        raise ValueError("two samples at least are needed")
    return list(prefixes)


def sample_table(spark: SparkSession, prefixes: list[str]) -> DataFrame:
    """A bit for each input; its name is the file's prefix."""
    rows = [(1 << i, p.rsplit("/", 1)[-1].split(".")[0]) for i, p in enumerate(list_samples(prefixes))]
    return spark.createDataFrame(rows, "sample_bit bigint, sample_name string")


def transposed(path: str) -> dict[str, dict[str, str]]:
    """Settings by column of a transposed CSV: first column the setting, one column for each platform or library."""
    with open(path, newline="") as f:
        rows = [r for r in csv.reader(f) if r and r[0] and not r[0].startswith("#")]
    return {name: {r[0]: r[i] for r in rows[1:] if i < len(r)} for i, name in enumerate(rows[0]) if i}


def settings(platforms: dict, libraries: dict, platform: str, library: str, job: dict | None = None) -> dict[str, str]:
    """Platform defaults, then the library's, then the job's own values (unless empty); checks that both are known and fit."""
    if platform not in platforms or library not in libraries:
        raise ValueError(f"unknown platform or library: {platform}, {library}")
    out = {**platforms[platform], **libraries[library], **{k: v for k, v in (job or {}).items() if v not in (None, "", "NA")}}
    allowed = libraries[library].get("compatible_platforms", "")
    if allowed and platform not in allowed.replace(",", " ").split():
        raise ValueError(f"library {library} doesn't fit platform {platform}")
    return out | {"platform": platform, "library": library}


def long_form(spark: SparkSession, table: dict[str, dict[str, str]]) -> DataFrame:
    return spark.createDataFrame([(n, k, v) for n, s in table.items() for k, v in s.items()], "name string, setting string, value string")


def manifest(tables: dict[str, DataFrame], paths: dict[str, str]) -> str:
    """JSON of written tables: path and columns of each."""
    return json.dumps({n: {"path": paths[n], "columns": dict(df.dtypes)} for n, df in sorted(tables.items())}, indent=1)
