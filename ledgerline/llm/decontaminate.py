"""Benchmark decontamination by a broadcast hash set of normalised test n-grams (operator 6).

Words are runs of digits, a-z (A-Z lower-cased) and anything beyond ASCII.  A benchmark item's windows are its runs of
``size`` consecutive words; a shorter item is one window.  The windows' hashes are broadcast in blocks whose bytes are
counted beforehand (``block_bytes``), a window's items dealt over all of them, so a window of very many items is split; with more
than one block the documents are scanned once per block and the hits united.  Each task rolls the
same hash over the words of its whole texts, looks up every position, and verifies hits on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import _BASE, ALNUM, Words, _powers, mix, sub_batches
from .common import bounded_batches, spare, store

_INV = pow(_BASE, -1, 1 << 64)
RESULT = "struct<n_words:bigint,runs:array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>,items:array<string>>"


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on, by differences of one running sum."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers(_BASE, len(h)), out=run[1:])
    return mix((run[size:] - run[:-size]) * _powers(_INV, n))


def _item_windows(size: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = {"item": [], "m": [], "h": [], "gram": []}
            for lo, n, data, off in sub_batches(batch.column(1)):
                w = Words(data, off, ALNUM)
                for i in range(n):
                    a, b = int(w.first[i]), int(w.first[i + 1])
                    if a == b:
                        continue
                    m = min(size, b - a)
                    for j, x in enumerate(window_hashes(w.hash[a:b], m).view(np.int64).tolist(), a):
                        rows["item"].append(ids[lo + i])
                        rows["m"].append(m)
                        rows["h"].append(x)
                        rows["gram"].append(b" ".join(w.text(k) for k in range(j, j + m)))
            yield pa.RecordBatch.from_arrays([pa.array(rows["item"], pa.string()), pa.array(rows["m"], pa.int32()),
                                              pa.array(rows["h"], pa.int64()), pa.array(rows["gram"], pa.binary())],
                                             names=["item", "m", "h", "gram"])
    return run


def _scanner(grams: list[tuple]):
    """arrow_udf over (text, result so far): adds what the block's windows hit."""
    table: dict[int, dict[int, list]] = {}
    for item, m, h, gram in grams:
        table.setdefault(m, {}).setdefault(h, []).append((gram, item))
    sizes = {m: np.sort(np.array(list(t), np.int64).view(np.uint64)) for m, t in table.items()}
    bits = 20

    def scan(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        marks = {}
        for m, known in sizes.items():
            marks[m] = np.zeros(1 << bits, bool)
            marks[m][(known >> np.uint64(64 - bits)).astype(np.int64)] = True
        for text, before in parts:
            n_words, runs, items = [], [], []
            for lo, rows, data, off in sub_batches(text):
                w = Words(data, off, ALNUM)
                n_words += w.per_text().tolist()
                own: list[list] = [[] for _ in range(rows)]
                found: list[set] = [set() for _ in range(rows)]
                for m, known in sizes.items():
                    h = window_hashes(w.hash, m)
                    at = np.flatnonzero(marks[m][(h >> np.uint64(64 - bits)).astype(np.int64)])
                    at = at[np.isin(h[at], known)]
                    doc = np.searchsorted(w.first, at, "right") - 1
                    inside = at + m <= w.first[doc + 1]
                    for i, d in zip(at[inside].tolist(), doc[inside].tolist()):
                        gram = b" ".join(w.text(k) for k in range(i, i + m))
                        hit = [item for g, item in table[m][int(h[i].view(np.int64))] if g == gram]
                        if hit:
                            found[d].update(hit)
                            own[d].append((i, i + m))
                for d in range(rows):
                    old = before[lo + d].as_py()
                    first = int(w.first[d])
                    merged = [[r["first"], r["last"]] for r in (old or {}).get("runs") or ()] + \
                        [[a - first, b - first] for a, b in own[d]]
                    out: list[list[int]] = []
                    for a, b in sorted(merged):
                        if out and a <= out[-1][1]:
                            out[-1][1] = max(out[-1][1], b)
                        else:
                            out.append([a, b])
                    chars = []
                    if out:  # code points before each byte of this text
                        points = np.cumsum((data[off[d]:off[d + 1]] & 0xC0) != 0x80)
                        for a, b in out:
                            s, e = w.start[first + a] - off[d], w.end[first + b - 1] - off[d]
                            chars.append({"first": a, "last": b, "start": int(points[s]) - 1, "end": int(points[e - 1])})
                    runs.append(chars)
                    items.append(sorted(found[d] | set((old or {}).get("items") or ())))
            yield pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "last", "start", "end")]))),
                 pa.array(items, pa.list_(pa.string()))], names=["n_words", "runs", "items"])
    return F.arrow_udf(scan, RESULT).asNondeterministic()


def mark_contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, block_bytes: int = 64 << 20,
                       text_col: str = "text", out: str = "contamination") -> DataFrame:
    """``docs`` with one struct column ``out``: n_words, runs of hit words, items (as strings, sorted).

    A run has its first and last (exclusive) word and its code-point span; a word is hit when it lies in an occurrence of any
    window.  Null and empty texts have no words, no runs and no items; null or wordless benchmark texts have no windows;
    repeated rows on either side count once per row and once per item id; a null item_id is the item "null".  An empty
    benchmark marks nothing.  All other columns of ``docs`` stay as they are; an existing column ``out`` is replaced.
    """
    bounded_batches(docs.sparkSession)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), F.col("text"))
    grams = store(items.mapInArrow(_item_windows(size), "item string, m int, h long, gram binary").distinct(), "dc-grams")
    held = grams.agg(F.sum(F.length("gram") + 64)).first()[0] or 0
    blocks = max(1, -(-held // block_bytes))
    done = docs.withColumn(out, F.lit(None).cast(RESULT))
    for k in range(blocks):
        # by item too, so a window that many items share spreads over the blocks: each holds at most about block_bytes
        block = grams.where(F.pmod(F.xxhash64("h", "item"), F.lit(blocks)) == k).collect()
        scan = _scanner([(r.item, r.m, r.h, bytes(r.gram)) for r in block])
        done = done.withColumn(out, scan(F.col(text_col), F.col(out)))
        if k + 1 < blocks:
            done = store(done, "dc-pass")
    return done


def n_hit(out: str = "contamination"):
    return F.aggregate(f"{out}.runs", F.lit(0).cast("long"), lambda s, r: s + r["last"] - r["first"])


def is_contaminated(out: str = "contamination", share: int = 20):
    """At least one word hit, and at least one in ``share`` of the words."""
    return (n_hit(out) > 0) & (F.lit(share) * n_hit(out) >= F.col(f"{out}.n_words"))


def drop_spans(text, spans, by: str = ""):
    """``text`` without the code-point spans (sorted, apart), each replaced by ``by``."""
    first = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))
    cut = F.aggregate(spans, first, lambda s, r: F.struct(
        F.concat(s["done"], F.substr(text, (s["at"] + 1).cast("int"), (r["start"] - s["at"]).cast("int")), F.lit(by)).alias("done"),
        r["end"].alias("at")), lambda s: F.concat(s["done"], F.substr(text, (s["at"] + 1).cast("int"))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = 13,
                  text_col: str = "text") -> DataFrame:
    """``docs`` (same columns) without contaminated documents, or with their hit spans cut out (``remove="spans"``)."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove={remove!r}: documents or spans")
    mark = spare(docs, "contamination")
    marked = mark_contamination(docs, benchmark, size, text_col=text_col, out=mark)
    if remove == "documents":
        return marked.where(~is_contaminated(mark)).drop(mark)
    return marked.withColumn(text_col, F.when(is_contaminated(mark), drop_spans(F.col(text_col), F.col(f"{mark}.runs")))
                             .otherwise(F.col(text_col))).drop(mark)
