"""The registered queries on whole small tables, against brute force, the libraries, or held-out accuracy."""

import hashlib
import html
import os
import re
import zlib

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
Q = E.queries()


def table(name, path=SF):
    return pd.read_parquet(f"{path}/{name}.parquet")


def result(spark, name, path=SF):
    return Q[name](spark, path).toPandas()


def held(ids):
    return [zlib.crc32(str(i).encode()) % 3 == 1 for i in ids]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def auc(score, label):
    rank = pd.Series(score).rank().to_numpy()
    pos = np.asarray(label) == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / max(1, pos.sum() * (~pos).sum())


def test_op1_held_out_quality(spark):
    path = "/root/testdata/sf0.01"
    r = result(spark, "op1_factorisation_quality", path)
    docs = table("documents", path)
    assert sorted(r.doc_id) == sorted(docs.doc_id) and r.score.between(0, 1).all()
    assert (r.predicted == (r.score >= 0.5).astype(int)).all() and list(r.held_out) == held(r.doc_id)
    x = r[r.held_out].merge(table("labels", path), on="doc_id")
    print("AUC", auc(x.score, x.quality), "accuracy", (x.predicted == x.quality).mean())
    assert auc(x.score, x.quality) > 0.9 and (x.predicted == x.quality).mean() > 0.9


def test_op2_runs_of_the_curve(spark):
    r = result(spark, "op2_hilbert_shards")
    docs = table("documents").set_index("doc_id")
    assert sorted(r.doc_id) == sorted(docs.index)
    counts = r.groupby("shard").size()
    assert set(counts.index) <= set(range(8)) and counts.max() - counts.min() <= 1
    assert r.grown_shard.isna().all() and set(r.law) == {"rows"}
    for _, g in r.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    s = r.sort_values("position")
    assert list(s.position) == list(range(len(r))) and s.shard.is_monotonic_increasing and s.curve.is_monotonic_increasing
    for i, size, crc in zip(r.doc_id, r["size"], r.text_crc32):
        raw = (docs.text[i] or "").encode()
        assert (size, crc) == (len(raw) + 1, zlib.crc32(raw))


def test_op3_base_spans(spark):
    r = result(spark, "op3_linked_secrets").set_index("doc_id")
    kinds = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                                   re.A), lambda m: len(m[2]) >= 6),
             ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
             ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    for i, text in zip(*table("documents")[["doc_id", "text"]].to_numpy().T):
        spans, n = [], []
        for k, (name, pattern, ok) in enumerate(kinds):
            got = [(m.start(), k, m.end(), name) for m in pattern.finditer(text or "") if ok(m)]
            n.append(len(got))
            spans += got
        base = ",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(spans))
        row = r.loc[i]
        assert [row.n_assign, row.n_access, row.n_hex] == n and row.base_sha256 == sha(base)
        assert set(base.split(",")) <= set(row.spans.split(",")) or not base


def groups(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("path", [SF, "/root/testdata/sf0.01"])
def test_op4_all_pairs(spark, path):
    r = result(spark, "op4_sign_hash_dedup", path).set_index("vec_id")
    t = table("embeddings", path)
    x = np.stack(t.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    ids = t.vec_id.tolist()
    root = groups(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near))])
    for i, n in zip(ids, near.sum(axis=1)):
        assert (r.n_links[i], r.component_id[i], r.kept[i]) == (n, root[i], root[i] == i)


def test_op5_articles(spark):
    r = result(spark, "op5_consensus_extract").set_index("page_id")
    for i, page in zip(*table("pages")[["page_id", "html"]].to_numpy().T):
        m = re.search(r"<article[^>]*>(.*?)</article>", page or "", re.S)
        blocks = re.split(r"</?(?:p|h\d|div|li|ul|ol|blockquote|section)\b[^>]*>", m[1]) if m else []
        want = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
        want = "\n".join(b for b in want if b)
        if m and "<" not in re.sub(r"</?(?:b|p|h1)>|<br>", "", m[1]):
            assert r.text[i] == want, i
        assert r.n_chars[i] == len(r.text[i])


def test_op6_brute_force(spark):
    r = result(spark, "op6_broadcast_decontam").set_index("doc_id")

    def words(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    windows = {}
    for i, t in zip(*table("benchmark")[["item_id", "text"]].to_numpy().T):
        w = words(t)
        m = min(13, len(w))
        for j in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[j:j + m]), set()).add(str(i))
    sizes = {len(k) for k in windows}
    some = 0
    for i, t in zip(*table("documents")[["doc_id", "text"]].to_numpy().T):
        w, hit, items = words(t), set(), set()
        for m in sizes:
            for j in range(len(w) - m + 1):
                got = windows.get(tuple(w[j:j + m]))
                if got:
                    items |= got
                    hit |= set(range(j, j + m))
        row = r.loc[i]
        some += bool(hit)
        assert (row.n_words, row.n_hit, row.n_items) == (len(w), len(hit), len(items))
        assert row.items_sha256 == sha(",".join(sorted(items)))
        assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    assert some


def test_op7_against_sql(spark):
    import check_oracles as C
    res = C.compare(spark, C.duck(SF), "op7", Q["op7_parity_sketch_join"], E.oracle_sql()["op7_parity_sketch_join"], SF)
    assert res["ok"], res


def test_op8_library(spark):
    import public_tokenizers as P
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    r = result(spark, "op8_chunk_table_pieces").set_index("doc_id")
    for i, t in zip(*table("documents")[["doc_id", "text"]].to_numpy().T):
        ids = sp.encode(t or "")
        row = r.loc[i]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))


def test_op9_held_out_languages(spark):
    path = "/root/testdata/sf0.01"
    r = result(spark, "op9_hierarchical_langid", path)
    docs = table("documents", path)
    assert sorted(r.doc_id) == sorted(docs.doc_id) and r.score.between(0, 1).all() and list(r.held_out) == held(r.doc_id)
    x = r.merge(docs, on="doc_id")
    h = x[x.held_out & x.lang.notna()]
    print("accuracy", (h.lang_pred == h.lang).mean())
    assert (h.lang_pred == h.lang).mean() > 0.93


def test_op10_library(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    r = result(spark, "op10_range_coded_ids").set_index("doc_id")
    start = 0
    for i, t in sorted(zip(*table("documents")[["doc_id", "text"]].to_numpy().T)):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        row = r.loc[i]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
