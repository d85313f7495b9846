"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata (operator 1).

    y = w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

so a text is scored in time linear in its features.  x has one entry per distinct hashed word (1 / root of their number), and
standardised structure statistics and metadata (the given character count), see ``STATISTICS``.  The machine is trained by
AdaGrad on a bounded, class-balanced sample (``per_class`` labelled rows a class, by hash of the id); the score is the
logistic of y, with the labels' own class balance put back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import NON_SPACE, Words, sub_batches

WORD_BITS = 16
RANK = 6
STATISTICS = ("log bytes", "log words", "bytes a word", "letters", "upper case", "digits", "punctuation", "beyond ASCII",
              "bars", "marks #$%&*", "exclamations", "full stops", "line ends a word", "distinct words", "most frequent word",
              "repeats of the word before", "words with marks inside or at the end", "log given characters")

_KIND = np.zeros(256, np.int64)  # columns of byte counts
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[c for c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = 4
_KIND[128:] = 5
_KIND[ord("|")] = 6
_KIND[[c for c in b"#$%&*"]] = 7
_KIND[ord("!")] = 8
_KIND[ord(".")] = 9
_KIND[ord("\n")] = 10


def features(data: np.ndarray, off: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(statistics by text, distinct hashed words of all texts, offsets)."""
    words = Words(data, off, NON_SPACE)
    n = words.per_text()
    size = np.diff(off)
    rows = len(size)
    kind = np.bincount(np.repeat(np.arange(rows), size) * 11 + _KIND[data], minlength=rows * 11).reshape(rows, 11)
    share = kind / np.maximum(size, 1)[:, None]
    h = (words.hash >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    doc = np.repeat(np.arange(rows), n)
    uniq, times = np.unique((doc << WORD_BITS) | h, return_counts=True)
    udoc = uniq >> WORD_BITS
    first = np.searchsorted(udoc, np.arange(rows + 1))
    most = np.zeros(rows)
    full = np.flatnonzero(n)
    if len(full):
        most[full] = np.maximum.reduceat(times, first[:-1][full])
    again = np.zeros(len(h), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    odd = _KIND[data[words.end - 1]] >= 7 if len(h) else np.zeros(0, bool)
    per = np.maximum(n, 1)
    s = np.stack([np.log1p(size), np.log1p(n), size / per, share[:, 1], share[:, 2], share[:, 3], share[:, 4], share[:, 5],
                  share[:, 6], share[:, 7], share[:, 8], share[:, 9], kind[:, 10] / per, np.diff(first) / per, most / per,
                  np.bincount(doc[again], minlength=rows) / per, np.bincount(doc[odd], minlength=rows) / per,
                  np.log1p(np.maximum(given, 0))], axis=1)
    return s, uniq & ((1 << WORD_BITS) - 1), first


def _given(column, texts) -> np.ndarray:
    """The given character counts; where null, the texts' own lengths."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.coalesce(column.cast(pa.int64()), pc.utf8_length(texts).cast(pa.int64())), 0).to_numpy()


def _featurise(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, given in parts:
        out, g = [], _given(given, texts)
        for lo, rows, data, off in sub_batches(texts):
            s, idx, first = features(data, off, g[lo:lo + rows])
            out += [s[i].astype("<f8").tobytes() + idx[first[i]:first[i + 1]].astype("<u4").tobytes() for i in range(rows)]
        yield pa.array(out, pa.binary())


class FactorisationMachine:
    def __init__(self, rows: list[bytes], labels: np.ndarray, prior: float, rounds: int = 10, batch: int = 64,
                 rate: float = 0.08, l2: float = 1e-4):
        k = len(STATISTICS)
        dense = np.stack([np.frombuffer(r[:8 * k], "<f8") for r in rows])
        words = [np.frombuffer(r[8 * k:], "<u4").astype(np.int64) for r in rows]
        self.mean, self.scale = dense.mean(axis=0), dense.std(axis=0) + 1e-6
        dense = self.standard(dense)
        rng = np.random.default_rng(11)
        size = (1 << WORD_BITS) + k
        self.w0, self.w, self.v = 0.0, np.zeros(size), rng.normal(0, 0.02, (size, RANK))
        g0, gw, gv = 1e-6, np.full(size, 1e-6), np.full((size, RANK), 1e-6)
        weight = np.where(labels > 0, 0.5 / max(1e-9, (labels > 0).mean()), 0.5 / max(1e-9, (labels <= 0).mean()))
        tail = (1 << WORD_BITS) + np.arange(k)
        for _ in range(rounds):
            for pick in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
                idx = np.concatenate([np.append(words[i], tail) for i in pick])
                x = np.concatenate([np.append(np.full(len(words[i]), 1 / np.sqrt(max(1, len(words[i])))), dense[i])
                                    for i in pick])
                n = np.array([len(words[i]) + k for i in pick])
                at = np.cumsum(n) - n
                row = np.repeat(np.arange(len(pick)), n)
                vx = self.v[idx] * x[:, None]
                s = np.add.reduceat(vx, at)
                y = self.w0 + np.add.reduceat(self.w[idx] * x, at) + 0.5 * (s * s - np.add.reduceat(vx * vx, at)).sum(axis=1)
                e = weight[pick] * (1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[pick]) / len(pick)
                ex = e[row] * x
                own, inv = np.unique(idx, return_inverse=True)
                dw = np.bincount(inv, ex) + l2 * self.w[own]
                pull = ex[:, None] * (s[row] - vx)
                dv = np.stack([np.bincount(inv, pull[:, f]) for f in range(RANK)], axis=1) + l2 * self.v[own]
                g0 += e.sum() ** 2
                gw[own] += dw * dw
                gv[own] += dv * dv
                self.w0 -= rate * e.sum() / np.sqrt(g0)
                self.w[own] -= rate * dw / np.sqrt(gw[own])
                self.v[own] -= rate * dv / np.sqrt(gv[own])
        self.shift = np.log(prior / (1 - prior)) if 0 < prior < 1 else 0.0
        self.table = np.column_stack([self.w, self.v, (self.v ** 2).sum(axis=1)]).astype(np.float32)

    def standard(self, dense: np.ndarray) -> np.ndarray:
        return np.clip((dense - self.mean) / self.scale, -4, 4)

    def score(self, data: np.ndarray, off: np.ndarray, given: np.ndarray) -> np.ndarray:
        s, idx, first = features(data, off, given)
        d = self.standard(s)
        n = np.diff(first)
        x = 1 / np.sqrt(np.maximum(n, 1))
        full = np.flatnonzero(n)
        sums = np.zeros((len(n), RANK + 2))
        if len(full):  # sums of w, v and v^2 over each text's words
            sums[full] = np.add.reduceat(self.table[idx].astype(np.float64), first[:-1][full], axis=0)
        tail = 1 << WORD_BITS
        linear = self.w0 + sums[:, 0] * x + d @ self.w[tail:]
        s = sums[:, 1:-1] * x[:, None] + d @ self.v[tail:]
        square = sums[:, -1] * x * x + (d * d) @ (self.v[tail:] ** 2).sum(axis=1)
        y = linear + 0.5 * ((s * s).sum(axis=1) - square) + self.shift
        return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def train_quality(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = 3000, id_col: str = "doc_id",
                  text_col: str = "text", chars_col: str = "n_chars") -> FactorisationMachine | None:
    """Learn from at most ``per_class`` rows of each label, among ``usable`` label rows.

    ``usable`` is a condition on the label rows' id.  The ids of the smallest hashes are taken, ``per_class`` of each label, and of
    their documents the ``per_class`` of the smallest hashes of id and text, copies once: what is broadcast and what is collected
    are bounded exactly, by row, however often an id or a text repeats.  Labels other than 0 and 1 and rows without an id teach
    nothing.  Gives None when either class is missing.
    """
    known = labels.where(usable & F.col("quality").isin(0, 1) & F.col(id_col).isNotNull()).select(id_col, "quality").distinct()
    counts = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return None
    h = F.xxhash64(F.col(id_col), F.lit(3))
    picked = known.where("quality = 0").orderBy(h, id_col).limit(per_class).unionByName(
        known.where("quality = 1").orderBy(h, id_col).limit(per_class))
    given = (F.col(chars_col) if chars_col in docs.columns else F.lit(None)).cast("long")
    own = F.xxhash64(F.col(id_col), F.col(text_col))
    found = (docs.select(id_col, F.col(text_col).alias("text"), given.alias("given")).join(F.broadcast(picked), id_col)
             .select(F.col(id_col).alias("id"), "quality", "text", "given", own.alias("h"))
             .dropDuplicates(["quality", "h"]))
    make = F.arrow_udf(_featurise, "binary").asNondeterministic()
    rows = []
    for q in (0, 1):
        some = found.where(F.col("quality") == q).orderBy("h").limit(per_class)
        rows += some.select("id", "quality", make(F.col("text"), F.col("given")).alias("f")).collect()
    rows = sorted((r[0], r.quality, bytes(r.f)) for r in rows)
    if len({q for _, q, _ in rows}) < 2:
        return None
    return FactorisationMachine([f for _, _, f in rows], np.array([float(q) for _, q, _ in rows]),
                                counts[1] / (counts[0] + counts[1]))


def score_quality(docs: DataFrame, model: FactorisationMachine | None, text_col: str = "text", chars_col: str = "n_chars",
                  out: str = "quality_score") -> DataFrame:
    """``docs`` with the score of each whole text in ``out`` (0 to 1; null and empty texts too; 0.5 without a model).

    Every row is kept, repeated ones too; other columns stay (an existing column ``out`` is replaced).
    """
    if model is None:
        return docs.withColumn(out, F.lit(0.5))

    def run(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, given in parts:
            g, scores = _given(given, texts), []
            for lo, rows, data, off in sub_batches(texts):
                scores.append(model.score(data, off, g[lo:lo + rows]))
            yield pa.array(np.concatenate(scores) if scores else np.zeros(0))
    given = F.col(chars_col) if chars_col in docs.columns else F.lit(None).cast("long")
    return docs.withColumn(out, F.arrow_udf(run, "double").asNondeterministic()(F.col(text_col), given))
