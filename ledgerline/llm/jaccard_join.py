"""N-gram Jaccard join by parity sketches (operator 7).

A text's set is its distinct word shingles, as 64-bit hashes.  Two sets of sizes a and b with Jaccard >= t/100 differ in at
most ``(100-t)(a+b)/(100+t)`` elements.

1. Sketch.  Per size band (sizes 2^i to 2^(i+1)) a set's hash range is cut into k segments; each element XORs its code into
   its segment's word.  A differing word needs a differing element, so the number of differing words never exceeds the
   symmetric difference (Hamming distance of the sketch, word-wise; ``bit_sketch`` is the same with one bit an element).
2. Pigeonhole.  With at most D words differing, two sketches of k words share k-D.  Each set emits the D+1 first of its words
   in one global order (most elements first, so empty and light words are hardly ever keys); the first shared word is then
   among the keys of both.  A set emits for its own band and for every larger one in which a partner may lie.
3. Join on the keys.  Per key the smallest and the largest set fingerprint come from a map-side combined aggregate; a key of
   two sets is settled by that pair.  For keys of more sets every member is paired with the smallest.  Pairs that the bit
   sketch can't rule out are verified, each set's nearest first, then those whose ends still lie in different components.
   Keys that still hold several components are compared in blocks of bounded size inside tasks, across components only: first
   the nearest pairs that would join components (a forest, fewer than the rows), then every pair left.  No pair that could
   link two components goes unverified, and no bucket's pairs are emitted whole.
4. Verification is on the whole texts' shingle sets.

Exact copies (equal sets) collapse into one class before any pair is made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import NON_SPACE, Words, mix, sub_batches
from .common import bounded_batches, components, give_back, partitions, store

_MULT = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                                0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9FB21C651E98DF25)]
SKETCH_BITS = 1024
BLOCK = 512


def shingle_sets(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): per text its distinct shingles, sorted; a shorter text's whole word sequence is one shingle."""
    h, counts = words.hash, words.per_text()
    sizes = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    s = np.zeros(max(len(h) - shingle + 1, 0), np.uint64)
    for j in range(shingle):
        s += h[j:len(s) + j] * _MULT[j]
    s = mix(s)
    out, ends = [], np.zeros(len(counts) + 1, np.int64)
    for i, (m, a) in enumerate(zip(sizes.tolist(), words.first.tolist())):
        if counts[i] >= shingle:
            u = np.unique(s[a:a + m])
            out.append(u)
            ends[i + 1] = len(u)
        elif m:
            c = int(counts[i])
            x = (h[a:a + c] * np.array(_MULT[:c])).sum(dtype=np.uint64) + np.array([c], np.uint64) * _MULT[-1]
            out.append(mix(x))
            ends[i + 1] = 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.cumsum(ends)


def _difference(a, b, t: int):
    return (100 - t) * (a + b) // (100 + t)


def _own_bound(n, t: int):
    """Largest symmetric difference to any partner of a set of size n."""
    return _difference(n, 100 * n // t, t)


def _segments(band: np.ndarray, t: int) -> np.ndarray:
    top = 2 << band
    return np.maximum(top * 8 * (100 - t) // (7 * t), _own_bound(top, t) + 1)


def _reduce(ufunc, values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Per-text reduction of non-empty texts' values; 0 for empty ones."""
    out = np.zeros(len(off) - 1, np.uint64)
    full = np.flatnonzero(np.diff(off))
    if len(full):
        out[full] = ufunc.reduceat(values, off[:-1][full])
    return out


def fingerprints(sets: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (_reduce(np.bitwise_xor, mix(sets ^ _MULT[4]), off), _reduce(np.add, mix(sets ^ _MULT[5]), off))


def sketch_keys(sets: np.ndarray, off: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, key): the first D+1 parity words of each set, for its own band and all in which a larger partner may lie."""
    n = np.diff(off)
    band = np.zeros(len(n), np.int64)
    band[n > 0] = np.floor(np.log2(n[n > 0])).astype(np.int64)
    rows, keys = [], []
    for ahead in range(64):
        idx = np.flatnonzero((n > 0) if not ahead else (n > 0) & (100 * n // t >= (1 << (band + ahead))))
        if not len(idx):
            break
        b = band[idx] + ahead
        k, need = _segments(b, t), _own_bound(n[idx], t) + 1
        text = np.repeat(np.arange(len(idx)), n[idx])
        at = np.concatenate([np.arange(off[i], off[i + 1]) for i in idx]) if len(idx) < len(n) else np.arange(len(sets))
        u = sets[at]
        seg = ((u >> np.uint64(32)) * k[text].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(u), bool)
        new[1:] = (seg[1:] != seg[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        word = mix(np.bitwise_xor.reduceat(mix(u), at) + b[text[at]].astype(np.uint64) * _MULT[6])
        weight = np.minimum(np.diff(np.append(at, len(u))), 255).astype(np.uint64)
        owner = text[at]
        order = np.lexsort((((np.uint64(255) - weight) << np.uint64(56)) | (word >> np.uint64(8)), owner))
        owner, word = owner[order], word[order]
        first = np.searchsorted(owner, np.arange(len(idx)))
        rank = np.arange(len(owner)) - first[owner]
        keep = rank < need[owner]
        rows.append(idx[owner[keep]])
        keys.append(word[keep])
        for j in np.flatnonzero(need > np.bincount(owner, minlength=len(idx))):  # too few words that aren't empty: add empty ones
            i = int(idx[j])
            used = np.unique(((sets[off[i]:off[i + 1]] >> np.uint64(32)) * np.uint64(k[j])) >> np.uint64(32))
            empty = np.setdiff1d(np.arange(k[j], dtype=np.uint64), used)
            empty = np.sort(mix(empty * _MULT[7] + np.uint64(b[j])))[:int(need[j]) - len(used)]
            rows.append(np.full(len(empty), i))
            keys.append(empty)
    return (np.concatenate(rows), np.concatenate(keys)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def bit_sketch(sets: np.ndarray) -> np.ndarray:
    """Parity sketch of SKETCH_BITS bits: each element toggles one bit, so Hamming distance <= symmetric difference."""
    ones = np.bincount((mix(sets ^ _MULT[3]) >> np.uint64(20)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS)
    return np.packbits((ones & 1).astype(np.uint8))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


_SIGNED = "doc_id long, n long, fp long, fp2 long, key long, sketch binary"
_NAMES = ["doc_id", "n", "fp", "fp2", "key", "sketch"]


def _signatures(shingle: int, t: int):
    def run(batches):
        seen: set[int] = set()  # sets whose keys this task has emitted; one entry a text of the task's split
        for batch in batches:
            ids = batch.column(0)
            for lo, rows, data, off in sub_batches(batch.column(1)):
                sets, so = shingle_sets(Words(data, off, NON_SPACE), shingle)
                fp, fp2 = fingerprints(sets, so)
                n = np.diff(so)
                sketches = pa.array([bit_sketch(sets[so[i]:so[i + 1]]).tobytes() for i in range(rows)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, rows), pa.array(n), _signed(fp), _signed(fp2), pa.nulls(rows, pa.int64()), sketches],
                    names=_NAMES)
                fresh = np.zeros(rows, bool)
                for i, x in enumerate(fp.tolist()):
                    if n[i] and x not in seen:
                        seen.add(x)
                        fresh[i] = True
                if not fresh.any():
                    continue
                of, keys = sketch_keys(sets[np.repeat(fresh, n)], np.append(0, np.cumsum(n[fresh])), t)
                none = pa.nulls(len(keys), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, _signed(fp[fresh][of]), none, _signed(keys),
                                                  pa.nulls(len(keys), pa.binary())], names=_NAMES)
        seen.clear()
        give_back()
    return run


def _texts_to_sets(shingle: int):
    """(cls, text) -> (cls, items): the sorted hashes of its set."""
    def run(batches):
        for batch in batches:
            for lo, rows, data, off in sub_batches(batch.column(1)):
                sets, so = shingle_sets(Words(data, off, NON_SPACE), shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, rows),
                     pa.array([sets[so[i]:so[i + 1]].tobytes() for i in range(rows)], pa.binary())], names=["cls", "items"])
    return run


def _verify(t: int):
    """(a, b, items of a, items of b) -> linked (a, b), by the exact Jaccard test."""
    def run(batches):
        for batch in batches:
            left, right, keep = batch.column(2), batch.column(3), []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                if 100 * len(x) < t * len(y):
                    keep.append(False)
                    continue
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * common >= t * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _far(x: pa.Array, y: pa.Array) -> np.ndarray:
    """Hamming distances of two columns of bit sketches."""
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint64).reshape(len(c), -1) for c in (x, y))
    return np.bitwise_count(x ^ y).sum(axis=1).astype(np.int64)


def _close_pairs(t: int):
    """(a, b, na, nb, sketch of a, sketch of b) -> (a, b, far) of the pairs that sizes and bit sketches can't rule out."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (batch.column(i).to_numpy() for i in (2, 3))
            far = _far(batch.column(4), batch.column(5))
            keep = (far <= _difference(na, nb, t)) & (100 * np.minimum(na, nb) >= t * np.maximum(na, nb))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(far)], names=["a", "b", "far"]).filter(pa.array(keep))
    return run


def _blocks(t: int, forest: bool):
    """Rows sorted by (key, bi, bj), each group at most two blocks: pairs across components that sizes and bit sketches can't
    rule out; with ``forest`` only the nearest ones that join components, fewer than the rows."""
    def pairs_of(rows):
        bi, bj = rows["bi"][0], rows["bj"][0]
        sk = np.frombuffer(b"".join(rows["sketch"]), np.uint64).reshape(len(rows["cls"]), -1)
        cls, comp, n, own = (np.array(rows[c]) for c in ("cls", "comp", "n", "own"))
        right = np.flatnonzero(own == bj)
        found = []
        for i in np.flatnonzero(own == bi):
            j = right[right > i] if bi == bj else right
            j = j[(comp[j] != comp[i]) & (100 * np.minimum(n[i], n[j]) >= t * np.maximum(n[i], n[j]))]
            if len(j):
                far = np.bitwise_count(sk[j] ^ sk[i]).sum(axis=1).astype(np.int64)
                ok = far <= _difference(n[i], n[j], t)
                found.append(np.stack([far[ok], np.full(int(ok.sum()), i), j[ok]]))
        if not found:
            return None
        found = np.concatenate(found, axis=1)
        if forest:
            root = {}

            def top(x):
                while root.setdefault(x, x) != x:
                    root[x] = x = root[root[x]]
                return x
            keep = []
            for e in np.lexsort((found[2], found[1], found[0])):
                x, y = top(comp[found[1, e]]), top(comp[found[2, e]])
                if x != y:
                    root[x] = y
                    keep.append(e)
            found = found[:, keep]
        x, y = cls[found[1]], cls[found[2]]
        return [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))]

    def run(batches):
        group, rows = None, {"cls": []}

        def flush():
            out = pairs_of(rows) if len(rows["cls"]) > 1 else None
            if out:
                yield pa.RecordBatch.from_arrays(out, names=["a", "b"])
        for batch in batches:
            d = batch.to_pydict()
            for i, g in enumerate(zip(d["key"], d["bi"], d["bj"])):
                if g != group:
                    yield from flush()
                    group, rows = g, {c: [] for c in d}
                for c in d:
                    rows[c].append(d[c][i])
        yield from flush()
    return run


def jaccard_groups(docs: DataFrame, shingle: int = 5, threshold: int = 80, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``.

    Two texts link when 100 * |A and B| >= threshold * |A or B| over their sets of distinct ``shingle``-word runs (A-Z
    lower-cased; words split at ASCII white space; a text of fewer words is one run).  ``component_id`` is the smallest
    doc_id reachable by links, the own one included.  Null or empty texts have no shingles and link with nothing.  Repeated
    rows come back repeated.  A row with a null doc_id gets the component of the texts whose set equals its own (null if
    there is none) and links nothing itself.  Other columns are ignored.  An empty table gives an empty result.
    """
    t = int(threshold)
    if not 0 < t <= 100:
        raise ValueError(f"threshold={threshold!r}: 1 to 100")
    bounded_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = store(base.mapInArrow(_signatures(shingle, t), _SIGNED), "jj-signed")
    sigs = signed.where("key is null").select("doc_id", "n", "fp", "fp2")
    keyed = signed.where("key is not null").select("key", "fp")

    # a class: the texts of one set; its id is the smallest doc_id
    classes = store(signed.where("key is null and n > 0").groupBy("fp", "fp2")
                    .agg(F.min("doc_id").alias("cls"), F.max("n").alias("n"), F.first("sketch").alias("sketch"))
                    .where("cls is not null"), "jj-classes")
    ends = keyed.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"), F.count("*").alias("c"))
    ends = store(ends.where("lo <> hi"), "jj-keys")
    members = store(keyed.join(ends.where("c > 2").select("key", "lo"), "key"), "jj-members")
    star = (ends.select(F.col("lo").alias("x"), F.col("hi").alias("y"))
            .unionByName(members.where("fp <> lo").select(F.col("lo").alias("x"), F.col("fp").alias("y"))).distinct())

    def ends_of(p: DataFrame, *cols: str, frame: DataFrame = classes) -> DataFrame:
        for side in ("a", "b"):
            p = p.join(frame.select(F.col("cls").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in cols)), side)
        return p.select("a", "b", *(f"{c}_{side}" for c in cols for side in ("a", "b")))

    of = classes.select("fp", "cls", "n")
    pairs = (star.join(of.select(F.col("fp").alias("x"), F.col("cls").alias("p"), F.col("n").alias("np")), "x")
             .join(of.select(F.col("fp").alias("y"), F.col("cls").alias("q"), F.col("n").alias("nq")), "y")
             .where(100 * F.least("np", "nq") >= t * F.greatest("np", "nq"))
             .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).where("a <> b").distinct())
    close = store(ends_of(pairs, "n", "sketch").mapInArrow(_close_pairs(t), "a long, b long, far long"), "jj-close")

    def verified(p: DataFrame) -> DataFrame:
        """Exact test on the shingle sets of the whole texts of the classes in ``p`` (a stored frame)."""
        wanted = p.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        texts = (base.join(wanted, base.doc_id == wanted.cls, "left_semi").where("text is not null")
                 .select(F.col("doc_id").alias("cls"), "text"))
        sets = store(texts.mapInArrow(_texts_to_sets(shingle), "cls long, items binary"), "jj-sets")
        return ends_of(p, "items", frame=sets).mapInArrow(_verify(t), "a long, b long")

    def grouped(found: DataFrame) -> DataFrame:
        return store(components(found), "jj-comps")

    def apart(p: DataFrame, comps: DataFrame) -> DataFrame:
        """Pairs whose ends are in different components so far."""
        for side in ("a", "b"):
            p = p.join(comps.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
        return p.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    # each class with its nearest star first; then what still lies apart
    first = store(close.groupBy("b").agg(F.min(F.struct("far", "a")).alias("m")).select(F.col("m.a").alias("a"), "b"), "jj-first")
    links = store(verified(first), "jj-links")
    comps = grouped(links)
    second = store(apart(close, comps).join(first, ["a", "b"], "left_anti").distinct(), "jj-second")
    more = store(verified(second), "jj-links")
    links, comps = (links.unionByName(more), None) if not more.isEmpty() else (links, comps)
    comps = comps or grouped(links)
    tried = first.unionByName(second)

    # keys that still hold several components: compare across them, in blocks
    near = members.join(of.select("fp", "cls"), "fp").select("key", "cls")
    width = partitions(docs.sparkSession)
    for forest in (True, False):
        now = store(near.join(comps, F.col("cls") == F.col("node"), "left")
                    .select("key", "cls", F.coalesce("component", "cls").alias("comp")), "jj-near")
        mixed = (now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"))
                 .where("lo <> hi").select("key", F.ceil(F.col("c") / BLOCK).cast("int").alias("nb")))
        held = (now.join(mixed, "key").join(classes.select("cls", "n", "sketch"), "cls")
                .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
                .select("key", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "cls",
                        "comp", "n", "sketch"))
        # a count of their own: blocks are light in bytes and heavy in work, so packing them by bytes makes few long tasks
        held = held.repartition(width, "key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
        rest = store(held.mapInArrow(_blocks(t, forest), "a long, b long").distinct().join(tried, ["a", "b"], "left_anti"),
                     "jj-rest")
        more = store(verified(rest), "jj-links")
        if not more.isEmpty():
            links, tried = links.unionByName(more), tried.unionByName(rest)
            comps = grouped(links)

    final = (classes.join(comps, F.col("cls") == F.col("node"), "left")
             .select("fp", "fp2", F.coalesce("component", "cls").alias("component")))
    return (sigs.join(final, ["fp", "fp2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")))
