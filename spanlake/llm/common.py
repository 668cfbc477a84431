"""Shared helpers: table access, shared scratch storage, the training fold, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a private one only where it is unset and all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spanlake-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def scratch(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder once and read it back.

    A written table survives lost executors and is computed once, unlike a cache.  The shuffle files of finished
    steps go from the executors' disks as soon as the driver's collector finds that nothing refers to them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spanlake/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Delete a scratch table that no later plan reads."""
    spark = df.sparkSession
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for root in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/spanlake/" in root:
            path = jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(conf).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send at most ``rows`` rows at once to Python: ten thousand whole texts are a worker's memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_sample(documents: DataFrame, labels: DataFrame, label: str, bound: int) -> list[tuple[str, int]]:
    """At most ``bound`` labelled (text, label) rows outside the held-out fold, by a hash order.

    The bound is the only sampling in a model's life: it limits what reaches the driver, whatever the
    size of the corpus.  A document with several label rows counts once with its largest label, one with several
    rows with one of its texts.  Rows with a null id, text or label, and labels without a document, teach nothing.
    """
    y = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id")))
        .groupBy("_id").agg(F.max("_y").alias("_y"))
    )
    docs = documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_t")).where("_id is not null and _t is not null")
    # one text of each labelled document, by its hash; texts themselves move only for the rows that are taken
    held = docs.select("_id", F.xxhash64("_t").alias("_v")).join(y, "_id").groupBy("_id").agg(F.min("_v").alias("_v"), F.max("_y").alias("_y"))
    wanted = held.withColumn("_o", F.xxhash64("_id")).orderBy("_o", "_id").limit(bound)
    rows = docs.withColumn("_v", F.xxhash64("_t")).join(F.broadcast(wanted), ["_id", "_v"]).groupBy("_o", "_id").agg(F.min("_t").alias("_t"), F.max("_y").alias("_y")).collect()
    rows.sort(key=lambda r: (r["_o"], r["_id"]))
    return [(r["_t"], r["_y"]) for r in rows]


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id for every node of ``edges(a, b)``: columns ``node``, ``component``.

    Alternates large-star and small-star steps.  Each step is one grouped minimum (partial sums on the
    map side) and one join, so a hub of any degree is never gathered into one task.  Every step's
    edges go to shared storage; the state is compared by count and an order-free checksum.
    """
    state = scratch(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
        "cc",
    )
    seen = None
    while True:  # it settles after some log n rounds
        both = state.union(state.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").select(F.col("b").alias("x"), F.col("a").alias("y"), "m")
            .select(F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("m").alias("b")), F.struct(F.col("y").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct()
        )
        after = scratch(small, "cc")
        drop_scratch(state)
        state = after
        mark = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    low = state.groupBy("a").agg(F.min("b").alias("component"))
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return low.select(F.col("a").alias("node"), "component").union(roots).groupBy("node").agg(F.min("component").alias("component"))
