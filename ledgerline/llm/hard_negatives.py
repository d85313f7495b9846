"""Hard-negative mining by a secondary-sort shuffle (operator 12).

Every anchor is scored against all rows.  Pairs travel as packed keys (anchor, descending score, kind, id), whose byte order is
the wanted order, so ``repartitionAndSortWithinPartitions`` delivers each anchor's pairs from the best score down.  A
streaming iterator opens a window at each positive and hands out the negatives that fall into open windows; it holds a few
windows, never an anchor's pairs.

Anchors are taken in blocks of counted bytes, each sent to all tasks, and rows are scored where they are read.  A task hands
on only pairs that can still count: of its own rows, each anchor's first positives, and each window's first negatives.  That
loses nothing (what isn't among the first of its own task isn't among the first of all) and keeps what is shuffled for an
anchor at tasks x (positives + positives x negatives) pairs, however many rows are alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

from .common import partitions, spare

BLOCK_BYTES = 32 << 20  # of an anchor block's components, as doubles
_CELLS = 1 << 21  # scores a task holds at a time
_FAR = 2**63 - 1
#: A pair: its anchor's number in the block, the score from the top, positives (0) before negatives (1), the id.
KEY = np.dtype([("anchor", ">u4"), ("down", ">u8"), ("kind", "u1"), ("id", ">u8")])
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def pack(anchor: np.ndarray, score: np.ndarray, kind: int, ident: np.ndarray) -> list[bytes]:
    keys = np.empty(len(anchor), KEY)
    keys["anchor"], keys["kind"] = anchor, kind
    keys["down"] = np.uint64(_FAR) - score.astype(np.int64).view(np.uint64)
    keys["id"] = ident.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return keys.view(f"V{KEY.itemsize}").ravel().tolist()


def unpack(key: bytes) -> tuple[int, int, int, int]:
    """(anchor, score, kind, id)."""
    return int.from_bytes(key[:4]), _FAR - int.from_bytes(key[4:12]), key[12], int.from_bytes(key[13:]) - (1 << 63)


def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): doubles where these are exact, else whole numbers of any size (as objects)."""
    with np.errstate(over="ignore"):
        q = np.floor(x * scale)
    if not q.size or np.abs(q).max() < 2**53:
        return q
    exact = [int(b) if math.isfinite(b) else int(a) * scale for a, b in zip(x.ravel().tolist(), q.ravel().tolist())]
    return np.array(exact, object).reshape(q.shape)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact whole inner products of a's rows with b's rows; those beyond 64 bits count as the outermost number."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    if a.dtype != object and b.dtype != object and a.shape[1] * np.abs(a).max() * np.abs(b).max() < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = [x if x.dtype == object else np.array([int(v) for v in x.ravel()], object).reshape(x.shape) for x in (a, b)]
    return np.array([[min(max(int(p @ q), -_FAR), _FAR) for q in whole[1]] for p in whole[0]], np.int64)


class FirstOf:
    """The first k (by descending score, then id) of each slot's cells seen so far."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.least = np.full(slots, -_FAR - 1)  # no lower score can enter
        self.held = [np.zeros(0, np.int64) for _ in range(4)]  # slot, score, id, number of the row

    def add(self, *cells: np.ndarray) -> None:
        if not len(cells[0]):
            return
        both = [np.concatenate(x) for x in zip(self.held, cells)]
        slot, score, ident, row = both
        order = np.lexsort((row, ident, -score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        self.held = [x[order[rank < self.k]] for x in both]
        last = order[rank == self.k - 1]
        self.least[both[0][last]] = score[last]


def by_length(vectors: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, components) of the vectors of each length."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dim)
        yield dim, at, flat[start[at][:, None] + np.arange(dim)].reshape(len(at), dim)


def _score(block, scale: int, windows, k: int):
    """Rows (id, label, v) -> packed keys of a task's pairs that may count.

    Without ``windows``: each anchor's first k positives.  With them (lowest and highest score by anchor and positive): each
    window's first k negatives.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, own_labels, groups = block.value
        low, high = windows.value if windows is not None else (None, None)
        each = 1 if windows is None else low.shape[1]
        first: dict[tuple[int, int], FirstOf] = {}
        seen = 0
        for batch in batches:
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            number = np.arange(seen, seen + len(ids))
            seen += len(ids)
            for dim, at, x in by_length(batch.column(2)):
                if dim not in groups:
                    continue
                own, q = groups[dim]
                x = quantise(x, scale)
                step = max(1, _CELLS // len(at))
                for s in range(0, len(own), 512):
                    part = own[s:s + 512]
                    best = first.setdefault((dim, s), FirstOf(len(part) * each, k))
                    for r in range(0, len(at), max(1, _CELLS // len(part))):
                        rows = at[r:r + max(1, _CELLS // len(part))]
                        score = inner_products(q[s:s + 512], x[r:r + len(rows)])
                        same = own_labels[part][:, None] == labels[rows]
                        other = own_ids[part][:, None] != ids[rows]
                        for j in range(each):
                            if windows is None:
                                mask = same & other & (score >= best.least[:, None])
                            else:
                                floor = np.maximum(low[part, j], best.least[j::each])
                                mask = ~same & other & (score >= floor[:, None]) & (score <= high[part, j][:, None])
                            a, c = np.nonzero(mask)
                            best.add(a * each + j, score[a, c], ids[rows[c]], number[rows[c]])
        for (dim, s), best in first.items():
            slot, score, ident, row = best.held
            anchor = groups[dim][0][s + slot // each]
            _, keep = np.unique(np.stack([anchor, row]), axis=1, return_index=True)  # a pair may lie in several windows
            for i in range(0, len(keep), 10_000):
                some = keep[i:i + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pack(anchor[some], score[some], int(windows is not None), ident[some]), pa.binary())], names=["key"])
    return run


def _sorted(keys, n: int):
    """An RDD of packed keys with each anchor's keys together and in order."""
    return keys.map(lambda k: (k, None)).repartitionAndSortWithinPartitions(
        n, lambda k: int.from_bytes(k[:4])).keys()


def _first_positives(k: int):
    def run(keys):
        for anchor, own in groupby(map(unpack, keys), key=lambda x: x[0]):
            yield anchor, [(score, ident) for _, (_, score, _, ident) in zip(range(k), own)]
    return run


def _emit(ids, negatives: int, low: int, high: int):
    """Sorted keys -> result rows.  Open windows are [id, score, negatives given]."""
    def run(keys):
        at, windows = None, []
        for anchor, score, kind, ident in map(unpack, keys):
            if anchor != at:
                at, windows = anchor, []
            if kind == 0:
                windows.append([ident, score, 0])
                continue
            passed = False
            for w in windows:
                if 100 * score < low * w[1] or w[2] == negatives:
                    passed = True  # scores only fall: this window gets no more
                elif 100 * score <= high * w[1]:
                    w[2] += 1
                    yield int(ids.value[anchor]), w[0], w[2], ident, w[1], score
            if passed:
                windows = [w for w in windows if 100 * score >= low * w[1] and w[2] < negatives]
    return run


def mine_hard_negatives(rows: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50,
                        high: int = 95, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each anchor's first ``positives`` rows of its label, the first ``negatives`` rows of other labels whose score lies
    between ``low`` and ``high`` percent of the positive's.

    A row's score is the whole inner product of the components floor(scale * x) with the anchor's (beyond 64 bits: the
    outermost number); higher scores come first, ties by smaller id.  ``anchors`` marks the anchor rows, ``label`` gives a
    whole number.  Columns: ``anchor_id, positive_id, rank`` (from 1), ``negative_id, positive_score, negative_score``.

    Rows take no part if id, label or vector is null or a component is null or not finite.  Rows of the anchor's own id are
    never its partners, and vectors of another length neither.  Repeated rows count one by one, as partners and as anchors
    (whose results then repeat).  Other columns are ignored; an empty table, or one without anchors, gives an empty result.
    """
    spark = rows.sparkSession
    sc = spark.sparkContext
    v, mark = F.col(vector_col), spare(rows, "anchor")
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    usable = (rows.withColumn(mark, F.coalesce(anchors, F.lit(False))).where(fine & label.isNotNull() & F.col(id_col).isNotNull())
              .select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                      F.transform(v, lambda x: x.cast("double")).alias("v"), F.col(mark).alias("is_anchor")))
    chosen, result = scratch_path(spark, "hn-anchors"), scratch_path(spark, "hn-result")
    own = usable.where("is_anchor").drop("is_anchor").withColumn("n", F.monotonically_increasing_id())
    total = own.agg(F.sum(F.size("v") * 8 + 32)).first()[0]
    spark.createDataFrame([], SCHEMA).write.parquet(result)
    if total is None:
        return spark.read.schema(SCHEMA).parquet(result)
    blocks = -(-total // block_bytes)
    own.withColumn("block", F.pmod(F.xxhash64("n"), F.lit(blocks))).write.partitionBy("block").parquet(chosen)
    n = partitions(spark)
    for k in range(blocks):
        table = (spark.read.schema("id long, label long, v array<double>, n long, block long").parquet(chosen)
                 .where(F.col("block") == k).select("id", "label", "v").toArrow())
        if not table.num_rows:
            continue
        numbers, vectors = table["id"].to_numpy(), table["v"].combine_chunks()
        ids = sc.broadcast(numbers)
        # plain arrays, so that the workers need no class of ours to read them
        block = sc.broadcast((numbers, table["label"].to_numpy(),
                              {dim: (at, quantise(x, scale)) for dim, at, x in by_length(vectors)}))
        pairs = usable.select("id", "label", "v")

        def keys(task):
            return pairs.mapInArrow(task, "key binary").rdd.map(lambda r: bytes(r[0]))
        best = _sorted(keys(_score(block, scale, None, positives)), n).mapPartitions(_first_positives(positives)).collect()
        # at most ``positives`` of each of the block's anchors; a window without a positive lets nothing in
        lows, highs = np.full((table.num_rows, positives), _FAR), np.full((table.num_rows, positives), -_FAR - 1)
        opening = []
        for anchor, own_best in best:
            for j, (score, ident) in enumerate(own_best):
                lows[anchor, j] = min(-(-low * score // 100), _FAR)
                highs[anchor, j] = high * score // 100
                opening.append((anchor, score, ident))
        windows = sc.broadcast((lows, highs))
        opened = pack(*(np.array([o[i] for o in opening], np.int64) for i in range(2)), 0,
                      np.array([o[2] for o in opening], np.int64)) if opening else []
        stream = sc.parallelize(opened, n).union(keys(_score(block, scale, windows, negatives)))
        found = _sorted(stream, n).mapPartitions(_emit(ids, negatives, low, high))
        spark.createDataFrame(found, SCHEMA).write.mode("append").parquet(result)
        for held in (block, ids, windows):
            held.destroy()
    return spark.read.schema(SCHEMA).parquet(result)
