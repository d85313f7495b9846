"""Helpers shared by the operators: written intermediates and distributed connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, and consumers never recompute what stands above.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows an Arrow batch holds at most.  Texts are whole, so this bounds a worker's memory better than Spark's 10,000 does.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Let Python workers take at most ``BATCH_ROWS`` texts at a time (a session setting; smaller ones stay)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def give_back() -> None:
    """In a Python worker: return freed memory to the system, as an idle worker would keep it."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def spare(df: DataFrame, name: str, *more: DataFrame) -> str:
    """A column name like ``name`` that neither ``df`` nor any of ``more`` has, in any case."""
    taken = {c.lower() for d in (df, *more) for c in d.columns}
    name = "__" + name
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, for explicit range partitionings."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list ``(a, b)`` by alternating large-star and small-star rounds.

    Returns ``(node, component)`` with the smallest reachable node, for every node that has an edge to another one.
    Self loops and null ends are ignored; an empty edge list gives an empty frame.  Each round is two grouped minima
    and their joins; a hub's neighbours are never gathered in one row, and skewed joins are left for AQE to split.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = store(e, "cc")
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u hangs below the smallest of u's neighbourhood
        large = (both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        large = store(large, "cc")
        # small star: u and its smaller neighbours hang below the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = store(joined.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
