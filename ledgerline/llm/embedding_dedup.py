"""Embedding near-duplicates by random-hyperplane sign hashing (operator 4).

Equal vectors collapse into one class first.  Each class gets ``tables`` signatures of ``bits`` signs of projections on random
hyperplanes; classes that share a signature in any table are compared, by exact cosine in double precision.  ``bits`` grows
with the logarithm of the number of classes, and ``tables`` is set so that a pair at the threshold meets in some table with
probability ``recall`` (pairs above it more often).

Buckets are compared inside tasks, in pairs of blocks of at most ``BLOCK`` classes, so a bucket that holds a third of all rows
is spread over many tasks and no pair is ever a row.  A pair counts in the first table in which its signatures agree, so it
counts once.  A block pair reports, per class, its number of links and the smallest class it reaches there; these feed the
link counts and the distributed connected components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, store

BLOCK = 1024


def plan(classes: int, threshold: float, recall: float = 0.999) -> tuple[int, int]:
    """(bits, tables) for so many classes."""
    bits = max(6, min(24, round(math.log2(max(classes, 2))) - 6))
    meet = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def _planes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng(dim).normal(size=(count, dim))


def _sign(bits: int, tables: int, vec: str):
    """(cls, copies, vector) -> cls, copies, dim, signatures (as a list and packed), vector bytes; one row a class."""
    packed = "<u2" if bits <= 16 else "<u4"

    def run(batches):
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            raw = batch.column(2).to_pylist()
            dims = np.array([len(v) for v in raw])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = np.array([raw[i] for i in at], np.float64)
                # by a power of two, which loses nothing: squares of large doubles would overflow, of small ones vanish
                x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
                signs = (x @ _planes(int(d), bits * tables).T > 0).reshape(len(at), tables, bits)
                sigs = (signs * weights).sum(axis=2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(np.full(len(at), d, np.int32)),
                     pa.array(sigs.astype(np.int32).tolist(), pa.list_(pa.int32())),
                     pa.array([s.tobytes() for s in sigs.astype(packed)], pa.binary()),
                     pa.array([v.tobytes() for v in x.astype(vec)], pa.binary())],
                    names=["cls", "copies", "dim", "keys", "sigs", "vec"])
    return run


def _compare(threshold: float, bits: int, vec: str):
    """Rows sorted by (t, sig, dim, bi, bj) -> (cls, links, low) of classes that have links in a block pair."""
    def links(rows, key):
        t, _, _, bi, bj = key
        x = np.frombuffer(b"".join(rows["vec"]), vec).reshape(len(rows["cls"]), -1).astype(np.float64)
        x = x / np.sqrt((x * x).sum(axis=1))[:, None]
        sigs = np.frombuffer(b"".join(rows["sigs"]), "<u2" if bits <= 16 else "<u4").reshape(len(x), -1)
        cls, copies, own = (np.array(rows[c]) for c in ("cls", "copies", "own"))
        left, right = np.flatnonzero(own == bi), np.flatnonzero(own == bj)
        i, j = np.nonzero(x[left] @ x[right].T >= threshold)
        i, j = left[i], right[j]
        if bi == bj:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return None
        first = np.empty(len(i), bool)
        for a in range(0, len(i), 1 << 16):
            s = slice(a, a + (1 << 16))
            first[s] = (sigs[i[s]] == sigs[j[s]]).argmax(axis=1) == t
        degree = np.bincount(i[first], copies[j[first]], len(x)) + np.bincount(j[first], copies[i[first]], len(x))
        low = cls.copy()
        while True:  # the smallest class reachable within this block pair
            before = low.copy()
            np.minimum.at(low, i, before[j])
            np.minimum.at(low, j, before[i])
            if (before == low).all():
                break
        some = np.zeros(len(x), bool)
        some[i] = some[j] = True
        return [pa.array(cls[some]), pa.array(degree[some].astype(np.int64)), pa.array(low[some])]

    def run(batches):
        group, rows = None, {"cls": []}

        def flush():
            out = links(rows, group) if len(rows["cls"]) > 1 else None
            if out:
                yield pa.RecordBatch.from_arrays(out, names=["cls", "links", "low"])
        for batch in batches:
            d = batch.to_pydict()
            keys = list(zip(d["t"], d["sig"], d["dim"], d["bi"], d["bj"]))
            for i, g in enumerate(keys):
                if g != group:
                    yield from flush()
                    group, rows = g, {c: [] for c in ("cls", "copies", "own", "sigs", "vec")}
                for c in rows:
                    rows[c].append(d[c][i])
        yield from flush()
    return run


def near_vectors(rows: DataFrame, threshold: float = 0.9, recall: float = 0.999, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """One row per row: ``vec_id``, ``n_links``, ``component_id``, ``kept`` (vec_id = component_id).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; vectors of different
    lengths never link.  Equal vectors link with one another and count one by one.  Repeated rows come back repeated, each
    counting as a vector.  Rows without an id come back with their links' component, or null.  Other columns are ignored; an
    empty table gives an empty result.
    """
    v = F.col(vector_col)
    fine = (v.isNotNull() & (F.size(v) > 0)
            & ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
            & F.exists(v, lambda x: x != 0))
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"),
                       F.when(F.coalesce(fine, F.lit(False)), F.transform(v, lambda x: x.cast("double"))).alias("v"))
    classes = store(base.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("cls"), F.count("*").alias("copies")),
                    "ed-classes")
    usable = classes.where("cls is not null")
    bits, tables = plan(usable.count(), threshold, recall)
    vec = "<f4" if rows.schema[vector_col].dataType.elementType.typeName() == "float" else "<f8"  # as exact as the input
    signed = store(usable.select("cls", "copies", "v").mapInArrow(
        _sign(bits, tables, vec), "cls long, copies long, dim int, keys array<int>, sigs binary, vec binary"), "ed-signed")
    key = ["t", "sig", "dim"]
    light = store(signed.select("cls", "dim", F.posexplode("keys").alias("t", "sig")), "ed-keys")
    sizes = light.groupBy(*key).agg(F.count("*").alias("c")).where("c > 1").withColumn("nb", F.ceil(F.col("c") / BLOCK))
    placed = (light.join(sizes, key).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb").cast("int") - 1)))
              .select(*key, F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "cls"))
    held = (placed.join(signed.select("cls", "copies", "sigs", "vec"), "cls")
            .repartition(*key, "bi", "bj").sortWithinPartitions(*key, "bi", "bj")
            .select(*key, "bi", "bj", "own", "cls", "copies", "sigs", "vec"))
    found = store(held.mapInArrow(_compare(threshold, bits, vec), "cls long, links long, low long"), "ed-links")
    degree = found.groupBy("cls").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("cls").alias("a"), F.col("low").alias("b")))
    final = (classes.join(degree, "cls", "left").join(comps.withColumnRenamed("node", "cls"), "cls", "left")
             .select("v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "cls").alias("c")))
    return (base.join(final, "v", "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("c")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
