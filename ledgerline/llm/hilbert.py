"""Hilbert-curve sharding (operator 2), with DataFrame functions only.

Several metadata dimensions are quantised to ``bits`` bits each, and rows are ordered by their index on the Hilbert curve
through that grid (then by id and content), so that rows close in all dimensions lie together.  Categories are quantised in the
order of their values, so that a run's smallest and largest value say something of each dimension: ``write_shards`` cuts
the runs into files whose min/max statistics let a reader skip files by any of them.  The runs' row counts differ by at most one.

The global position of a row comes from two levels: rows are range-partitioned and sorted by (curve index, id, checksum) and
written; a row's position is its place within its partition plus the sizes of the partitions before.  Only the partitions'
sizes (one row each) meet in one place.  A curve cell that holds a third of all rows is split by the later sort columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, spare, store


def quantise_hash(c: Column, bits: int) -> Column:
    """A value as one of 2^bits grid values by its hash; null is 0.  Keeps equal values together, but no order to prune by."""
    return F.when(c.isNull(), F.lit(0).cast("long")).otherwise(
        F.pmod(F.xxhash64(c.cast("string")), F.lit((1 << bits) - 1)) + 1)


def with_rank(rows: DataFrame, column: str, bits: int, out: str) -> DataFrame:
    """``rows`` with ``out``: the values of a category in their order, as one of 2^bits grid values holding about equal numbers of
    rows; null is 0.  The distinct values (one row each) are ranked in one place: meant for categories, not for ids."""
    value, n, before = spare(rows, "value"), spare(rows, "n"), spare(rows, "before")
    counts = rows.where(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`").alias(value)).agg(F.count("*").alias(n))
    order = Window.orderBy(value)
    total = F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    start = F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.withColumn(before, F.coalesce(start, F.lit(0)) / total).select(
        value, (F.floor(F.col(before) * ((1 << bits) - 1)) + 1).cast("long").alias(out))
    return rows.join(ranks, F.col(f"`{column}`") == F.col(value), "left").drop(value).fillna(0, [out])


def quantise_log(c: Column, bits: int, top: float = 34.0) -> Column:
    """A size from 0 to 2^top on a logarithmic grid; larger ones share the last value; null counts as 0."""
    cells = (1 << bits) - 1
    at = F.floor(F.log2(F.greatest(F.coalesce(c.cast("double"), F.lit(0.0)), F.lit(0.0)) + 1) * cells / top)
    return F.least(at, F.lit(cells)).cast("long")


def hilbert_index(dims: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of grid values of ``bits`` bits each (at most 63 bits together).

    Skilling's transformation, as folds over short constant arrays: the inverse undo of the excess work per bit and dimension,
    then Gray encoding, then the bits interleaved, the highest first.
    """
    n = len(dims)
    if n * bits > 63:
        raise ValueError("more than 63 bits")
    names = [f"x{i}" for i in range(n)]

    def pick(acc, i):
        return reduce(lambda out, j: F.when(i == j, acc[names[j]]).otherwise(out), range(1, n), acc["x0"])

    def undo(acc, step):
        q, i = step["q"], step["i"]
        p = q - 1
        xi = pick(acc, i)
        swap = (acc["x0"].bitwiseXOR(xi)).bitwiseAND(p)
        first = F.when(xi.bitwiseAND(q) != 0, acc["x0"].bitwiseXOR(p)).otherwise(acc["x0"].bitwiseXOR(swap))
        rest = [F.when((i == j) & (xi.bitwiseAND(q) == 0), acc[names[j]].bitwiseXOR(swap)).otherwise(acc[names[j]])
                .alias(names[j]) for j in range(1, n)]
        return F.struct(first.alias("x0"), *rest)

    steps = F.array(*(F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)))
    start = F.struct(*(d.cast("long").alias(x) for d, x in zip(dims, names)))
    moved = F.aggregate(steps, start, undo) if bits > 1 else start

    def gray(x):
        out = [x["x0"]]
        for j in range(1, n):
            out.append(x[names[j]].bitwiseXOR(out[-1]))
        return F.struct(*(c.alias(k) for c, k in zip(out, names)))

    def interleave(x):
        last = x[names[-1]]
        t = F.aggregate(F.array(*(F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1))), F.lit(0).cast("long"),
                        lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)) if bits > 1 else F.lit(0)
        parts = [F.shiftleft(F.shiftright(x[k].bitwiseXOR(t), b).bitwiseAND(F.lit(1)), b * n + (n - 1 - j))
                 for b in range(bits) for j, k in enumerate(names)]
        return reduce(lambda a, b: a.bitwiseOR(b), parts)

    # one-element folds bind an intermediate once instead of repeating its expression
    coded = F.transform(F.array(moved), gray)
    return F.element_at(F.transform(coded, interleave), 1)


def shard_by_curve(rows: DataFrame, dims: list[Column], order: list[Column], shards: int, bits: int = 8,
                   keep: list[Column] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``curve``, ``position`` (0-based, over all rows), ``shard`` and ``slot``.

    Rows are ordered by curve index, then by ``order``; ties in all of these are in no given order but get places of their
    own.  Shard k takes the k-th of ``shards`` runs; the first (rows mod shards) runs have one row more.  With fewer rows than
    shards the last shards are empty; an empty table gives an empty result.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    width = partitions(rows.sparkSession)
    keys = [f"__o{i}" for i in range(len(order))]
    kept = [F.col(f"`{c}`") for c in rows.columns] if keep is None else keep
    sized = rows.select(*kept, hilbert_index(dims, bits).alias("curve"), *(c.alias(k) for c, k in zip(order, keys)))
    placed = store(sized.repartitionByRange(width, "curve", *keys).sortWithinPartitions("curve", *keys).drop(*keys)
                   .withColumn("__at", F.monotonically_increasing_id()), "hilbert")
    part = F.shiftright("__at", 33).cast("int")
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # one row a partition
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    total = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__total"))
    total = total.first()[0]
    low, more = divmod(total, shards)
    position = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    edge = more * (low + 1)  # rows in the longer runs
    shard = F.when(F.col("position") < edge, F.floor(F.col("position") / (low + 1))) \
        .otherwise(more + F.floor((F.col("position") - edge) / max(low, 1))).cast("int")
    first = F.when(F.col("shard") <= more, F.col("shard").cast("long") * (low + 1)).otherwise(
        F.lit(edge) + (F.col("shard").cast("long") - more) * low)
    return (placed.withColumn("__part", part).join(starts, "__part").withColumn("position", position)
            .withColumn("shard", shard).withColumn("slot", F.col("position") - first)
            .drop("__part", "__before", "__at"))


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write a placed frame (``shard_by_curve``) by shard: files of at most ``rows_per_file`` rows in curve order, none of which
    shares its part of the curve with another, so their min/max statistics are narrow in every dimension."""
    run = F.floor(F.col("slot") / rows_per_file)
    (placed.withColumn("__run", run).repartitionByRange(partitions(placed.sparkSession), "shard", "__run", "slot")
     .sortWithinPartitions("shard", "__run", "slot").drop("__run")
     .write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path))
