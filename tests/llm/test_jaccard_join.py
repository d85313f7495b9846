import random
import re

import numpy as np
import pytest

from ledgerline.llm import jaccard_join as jj
from ledgerline.llm.jaccard_join import jaccard_groups


def brute(rows, k, t):
    """doc_id -> (set size, smallest reachable id), by comparing all pairs."""
    sets, root = {}, {}
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            inter = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - inter
            if union and 100 * inter >= t * union:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, groups=40, alone=60, vocabulary=400):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(vocabulary)
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([3, 5, 8, 20, 60, 200, 900]))]
        for _ in range(rng.choice([2, 3, 12])):
            t = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 5]) if len(t) > 10 else rng.choice([0, 0, 1])):
                p = rng.randrange(len(t))
                t[p:p + 1] = rng.choice([[word()], [], [word(), word()]])
            texts.append(t)
        if rng.random() < 0.3:
            texts.append(base + base[:len(base) // 8])
    for _ in range(alone):
        texts.append(passage + [word() for _ in range(rng.randrange(1, 80))])
    out = [" ".join(t) for t in texts]
    out += ["", None, "   ", "One", "ONE", "one two three", "One Two  THREE", "a\tb\nc\rd e", "é ß ü x y", "É ß ü x y"]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("k,t,seed", [(4, 85, 1), (5, 80, 2), (1, 50, 3)])
def test_matches_brute_force(spark, k, t, seed):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), k, t).collect()}
    assert got == brute(rows, k, t)


def test_chain_of_near_copies_in_one_bucket(spark):
    """Far ends of a chain share keys but don't link; the middle joins them; a second group shares the passage only."""
    base = [f"c{i}" for i in range(300)]
    rows, n = [], 0
    for step in range(60):
        t = list(base)
        for j in range(step * 4):
            t[j] = f"x{j}"
        rows.append((n, " ".join(t)))
        n += 1
    for i in range(200):
        rows.append((n, " ".join(base[:40] + [f"u{i}_{j}" for j in range(150)])))
        n += 1
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert got == brute(rows, 4, 85)


def test_nulls_repeats_clashes_and_empty(spark):
    schema = "doc_id long, text string, key string, fp string, n int, cls int, component_id int"
    rows = [(1, "a b c d e f", "k", "f", 1, 1, 7), (1, "a b c d e f", "k", "f", 1, 1, 7), (3, "A b C d E f", None, None, None, None, 1),
            (None, "a b c d e f", None, None, None, None, None), (None, None, None, None, None, None, None),
            (5, None, None, None, None, None, None), (6, "x " * 3000, None, None, None, None, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                  jaccard_groups(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (3, 2, 1), (None, 2, 1), (None, 0, None), (5, 0, 5), (6, 1, 6)], key=str)
    assert jaccard_groups(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("t,a,b", [(40, 7, 17), (20, 7, 34), (30, 15, 50), (85, 15, 17)])
def test_sets_bands_apart_share_a_key(t, a, b):
    """Low thresholds link sets of sizes several bands apart."""
    assert 100 * a >= t * b
    for seed in range(50):
        large = np.unique(np.random.default_rng(seed).integers(0, 1 << 63, b).astype(np.uint64))
        small = np.sort(np.random.default_rng(seed).permutation(large)[:a])
        rows, keys = jj.sketch_keys(np.concatenate([small, large]), np.array([0, a, a + b]), t)
        assert np.intersect1d(keys[rows == 0], keys[rows == 1]).size, seed
