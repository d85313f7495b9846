"""Hierarchical language ID (operator 9): the family first, then linear support vector machines within it.

Features are relative frequencies of hashed byte 2-, 3- and 4-grams of the whole text, with A-Z folded and everything ASCII
that is no letter read as one blank.  Each is divided by the root of its mean frequency in the sample, which is folded into
the weights, so a text is scored in one linear pass: the sum of its n-grams' weights over their number.  All machines
(one-versus-rest for families, one-versus-one within a family) are trained by dual coordinate descent on a bounded
sample (``per_language`` texts a language, by hash of the text).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import sub_batches
from .common import bounded_batches, give_back

# ISO 639-1 codes by family.  A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt uz",
    "indic": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg ms su tl",
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
DIMS = 1 << 14  # per n-gram order
_ORDERS = (2, 3, 4)
UNDETERMINED = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def grams(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: (feature of each n-gram start, whether the n-gram lies within its text)."""
    folded = _FOLD[data].astype(np.uint32)
    end = np.repeat(off[1:], np.diff(off))
    at = np.arange(len(data))
    code = folded.copy()
    for k, n in enumerate(_ORDERS):
        if len(data) < n:
            return
        code = code[:len(data) - n + 1] * np.uint32(257) + folded[n - 1:] if n > 2 else folded[:-1] * np.uint32(257) + folded[1:]
        h = (code * np.uint32(0x9E3779B1)) >> np.uint32(18)
        yield h.astype(np.int64) + k * DIMS, at[:len(h)] + n <= end[:len(h)]


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Per text: whether it has any Unicode letter."""
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    got = np.diff(np.append(0, np.cumsum(ascii_letter))[off]) > 0
    for i in np.flatnonzero(~got & (np.diff(np.append(0, np.cumsum(data >= 128))[off]) > 0)):
        got[i] = any(c.isalpha() for c in data[off[i]:off[i + 1]].tobytes().decode("utf-8", "ignore"))
    return got


def _counts(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Per text the sparse n-gram counts, as (u32 feature, u32 count) pairs; empty without a letter."""
    for column in parts:
        out = []
        for _, rows, data, off in sub_batches(column):
            ok = has_letter(data, off)
            for i in range(rows):
                own = data[off[i]:off[i + 1]]
                c = np.zeros(DIMS * len(_ORDERS), np.int64)
                if ok[i]:
                    for h, _ in grams(own, np.array([0, len(own)])):
                        c += np.bincount(h, minlength=len(c))
                at = np.flatnonzero(c)
                out.append(np.stack([at, c[at]], axis=1).astype("<u4").tobytes())
        yield pa.array(out, pa.binary())


def _svm(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dims: int, c: float = 20.0, rounds: int = 12) -> np.ndarray:
    """Weights (a bias last) of an L2-loss linear SVM, by dual coordinate descent; classes weigh alike."""
    w = np.zeros(dims + 1)
    alpha = np.zeros(len(x))
    cost = np.where(y > 0, c / max(1, (y > 0).sum()), c / max(1, (y < 0).sum())) * len(y) / 2
    norm = np.array([(v * v).sum() + 1 for _, v in x]) + 1 / (2 * cost)
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            at, v = x[i]
            g = y[i] * (w[at] @ v + w[-1]) - 1 + alpha[i] / (2 * cost[i])
            new = max(alpha[i] - g / norm[i], 0.0)
            if new != alpha[i]:
                d = (new - alpha[i]) * y[i]
                w[at] += d * v
                w[-1] += d
                alpha[i] = new
    return w


class LanguageModel:
    """Families, their languages and the machines' weights (one column each of ``table``, biases apart)."""

    def __init__(self, languages: list[str], sample: list[tuple[str, bytes]]):
        self.languages = languages
        if not languages:
            return
        family = [_FAMILY_OF.get(x, x) for x in languages]
        self.families = sorted(set(family))
        self.of = [[i for i, f in enumerate(family) if f == g] for g in self.families]
        dims = DIMS * len(_ORDERS)
        x, mean = [], np.zeros(dims)
        for _, raw in sample:
            pairs = np.frombuffer(raw, "<u4").reshape(-1, 2).astype(np.int64)
            at, f = pairs[:, 0].copy(), pairs[:, 1] / max(1, pairs[:, 1].sum())  # a view would keep the counts too
            x.append((at, f))
            mean[at] += f
        scale = 1 / np.sqrt(mean / max(1, len(x)) + 1e-6)
        for at, f in x:
            f *= scale[at]
        lang = np.array([languages.index(a) for a, _ in sample], dtype=np.int64)
        fam = np.array([self.families.index(family[i]) for i in lang], dtype=np.int64)
        columns = []
        for g in range(len(self.families)):
            columns.append(_svm(x, np.where(fam == g, 1.0, -1.0), dims) if len(self.families) > 1 else np.zeros(dims + 1))
        self.pairs = []
        for own in self.of:
            for k, a in enumerate(own):
                for b in own[k + 1:]:
                    use = np.flatnonzero((lang == a) | (lang == b))
                    self.pairs.append((a, b, len(columns)))
                    columns.append(_svm([x[i] for i in use], np.where(lang[use] == a, 1.0, -1.0), dims))
        w = np.stack(columns, axis=1)
        self.table = (w[:-1] * scale[:, None]).astype(np.float32)
        self.bias = w[-1].astype(np.float32)

    def margins(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Text by machine."""
        total = np.zeros((len(off) - 1, self.table.shape[1]))
        count = np.zeros(len(off) - 1)
        for h, inside in grams(data, off):
            edge = np.minimum(off, len(h))
            count += np.diff(np.append(0, np.cumsum(inside))[edge])
            for m in range(self.table.shape[1]):
                run = np.append(0, np.cumsum(np.where(inside, self.table[:, m].take(h), 0), dtype=np.float64))
                total[:, m] += np.diff(run[edge])
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, data: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
        ok = has_letter(data, off)
        m = self.margins(data, off)
        family = m[:, :len(self.families)]
        best = family.argmax(axis=1)
        soft = np.exp(3 * (family - family.max(axis=1, keepdims=True)))
        score = soft.max(axis=1) / soft.sum(axis=1)
        # one-versus-one within the family: most wins, then the larger sum of margins
        wins = np.zeros((len(m), len(self.languages)))
        for a, b, k in self.pairs:
            s = 1 / (1 + np.exp(-np.clip(6 * m[:, k], -50, 50)))
            wins[:, a] += (s >= 0.5) + 0.5 * s
            wins[:, b] += (s < 0.5) + 0.5 * (1 - s)
        out = []
        for i in range(len(m)):
            own = self.of[best[i]]
            pick = own[int(np.argmax(wins[i, own]))]
            for a, b, k in self.pairs:
                if pick in (a, b) and len(own) > 1:
                    s = 1 / (1 + math.exp(-max(-50.0, min(50.0, 6 * m[i, k]))))
                    score[i] *= s if pick == a else 1 - s
            out.append(self.languages[pick] if ok[i] else UNDETERMINED)
        return out, np.where(ok, np.clip(score, 0, 1), 0.0)


def train_languages(docs: DataFrame, usable: Column, per_language: int = 600, lang_col: str = "lang",
                    text_col: str = "text") -> LanguageModel:
    """Learn from at most ``per_language`` different texts of each language among the ``usable`` rows.

    The sample is drawn in Spark, by a hash of the text: copies of a text count once and ids play no part, so neither a hot id nor a
    hot text can crowd a language out or swell what is collected, which is ``per_language`` rows a language at most.  The
    languages themselves, one count each and one machine per pair within a family, are taken whole: their number is that of the
    labels.  Rows without a language, and texts without a letter, teach nothing.
    """
    bounded_batches(docs.sparkSession)
    h = F.pmod(F.xxhash64(F.col(text_col)), F.lit(1 << 30))
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), h.alias("h"))
    counts = {r[0]: r[1] for r in rows.select("lang", "h").distinct().groupBy("lang").count().collect()}
    if not counts:
        return LanguageModel([], [])
    # half as many again are drawn, so that the cut below finds enough
    share = F.create_map(*(x for a in sorted(counts) for x in (F.lit(a), F.lit(min(1.0, 1.5 * per_language / counts[a])))))
    drawn = rows.where(F.col("h") / float(1 << 30) < F.element_at(share, F.col("lang")))
    once = drawn.groupBy("lang", "h").agg(F.min("text").alias("text"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    count = F.arrow_udf(_counts, "binary").asNondeterministic()
    got = (once.withColumn("r", first).where(F.col("r") <= per_language).select("lang", count(F.col("text")).alias("grams")).collect())
    sample = sorted(((r.lang, bytes(r.grams)) for r in got if len(r.grams)), key=lambda x: (x[0], x[1]))
    del got
    return LanguageModel(sorted({a for a, _ in sample}), sample)


def predict_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct ``out``: ``lang`` and ``score`` (0 to 1).

    Null texts and texts without a letter are ``und`` with score 0, as is every text when nothing could be learned.  Every
    row is kept, repeated ones too, and other columns stay (an existing column ``out`` is replaced).
    """
    bounded_batches(docs.sparkSession)
    if not model.languages:
        return docs.withColumn(out, F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score")))

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in parts:
            langs, scores = [], []
            for _, _, data, off in sub_batches(column, 1 << 20):
                a, b = model.predict(data, off)
                langs += a
                scores.append(b)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()),
                                              pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=["lang", "score"])
        give_back()
    return docs.withColumn(out, F.arrow_udf(run, "struct<lang:string,score:double>").asNondeterministic()(F.col(text_col)))
