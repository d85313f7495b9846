"""The pipeline's rows against a plain version of every stage on whole small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import pandas as pd
import pytest

import corpus_pipeline
from ledgerline.llm import secrets as sc

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def near_copies(texts):
    """Ids that some smaller id reaches by links of Jaccard >= 0.8 over five-word shingles."""
    sets = {}
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    holders = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in sorted(sets):
        for j, both in Counter(j for s in sets[i] for j in holders[s] if j < i).items():
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i in sets if find(i) != i}


def contaminated(texts, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for text in items:
        w = re.findall(pattern, lower(text))
        m = min(13, len(w))
        windows |= {tuple(w[j:j + m]) for j in range(len(w) - m + 1 if m else 0)}
    sizes, out = {len(x) for x in windows}, set()
    for i, text in texts.items():
        w, hit = re.findall(pattern, lower(text)), set()
        for m in sizes:
            for j in range(len(w) - m + 1):
                if tuple(w[j:j + m]) in windows:
                    hit |= set(range(j, j + m))
        if hit and 20 * len(hit) >= len(w):
            out.add(i)
    return out


def redacted(text):
    """Every base match, and every weak part with its complements near in its paragraph, by comparing all of them."""
    text = text or ""
    base = sc.base_spans(text)
    weak = [x for x in sc._weak_spans(text) if not any(s < x[1] and x[0] < e for s, e, _ in base)]
    role = {"access": "id", "id": "id", "endpoint": "endpoint"}
    ends = [m.end() for m in re.finditer(r"\n[ \t\r]*\n", text)]

    def near(x, wanted):
        first = max([0, *(e for e in ends if e <= x[0])])
        last = min([len(text) + 1, *(e for e in ends if e > x[0])])
        lo, hi = max(x[0] - sc.REACH, first), min(x[1] + sc.REACH, last)
        return any(role.get(k, "key") == wanted and e > lo and s < hi and not (s < x[1] and x[0] < e)
                   for s, e, k in [*base, *weak])
    needs = {"id": ["key"], "blob": ["id"], "endpoint": ["id", "key"]}
    out, spans = [], sorted([*base, *(x for x in weak if all(near(x, w) for w in needs[x[2]]))])
    merged = []
    for s, e, _ in spans:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    at = 0
    for s, e in merged:
        out += [text[at:s], "[secret]"]
        at = e
    return "".join([*out, text[at:]])


@pytest.mark.parametrize("path", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_pipeline_against_plain_stages(spark, path):
    import public_tokenizers as P
    import sentencepiece
    docs = pd.read_parquet(f"{path}/documents.parquet")
    texts = dict(zip(docs.doc_id, docs.text))
    rows = Counter(docs.doc_id)
    assert max(rows.values()) == 1
    texts = {i: t for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    kept = [len(texts)]
    for gone in (near_copies, lambda x: contaminated(x, pd.read_parquet(f"{path}/benchmark.parquet").text)):
        out = gone(texts)
        texts = {i: t for i, t in texts.items() if i not in out}
        kept.append(len(texts))
    assert len(docs) >= kept[0] > kept[1] > kept[2] > 0
    changed = {i: redacted(t) for i, t in texts.items()}
    assert path.endswith('0.001') or any(changed[i] != texts[i] for i in texts)  # the smallest table has none left
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = {}
    for i, t in changed.items():
        ids = sp.encode(t)
        want[i] = (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), sp.decode(ids))))
    r = corpus_pipeline.run(spark, path).toPandas()
    got = dict(zip(r.doc_id, zip(r.n_tokens, r.ids_sha256, r.decoded_sha256)))
    assert len(got) == len(r) and sorted(got) == sorted(want)
    assert [i for i in want if got[i] != want[i]] == []


def test_stages_keep_the_columns(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert docs.columns == DOCUMENT_COLUMNS
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == DOCUMENT_COLUMNS, name


def test_stages_on_awkward_rows(spark):
    """Nulls anywhere, empty and long texts, repeated rows, rows without an id, and an empty table."""
    path = "/root/testdata/sf0.001"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = "der hund und die katze " * 3000
    rows = [(1, "the cat and the dog sat on a mat", "en", "a", 32), (1, "the cat and the dog sat on a mat", "en", "a", 32),
            (2, None, None, None, None), (3, "", "en", "a", 0), (None, "le chat et le chien du roi", "fr", None, None),
            (4, long, "de", "b", len(long)), (5, "password = hunter2hunter2", None, "s", None),
            (6, "The cat and the DOG sat on a mat", "en", "c", 32)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), path).collect() == [], name
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, path).collect(), schema)
    got = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(map(str, got)) == ["1", "4", "5", "None"] and docs.count() == 4
    assert got[5] == "[secret]" and got[4] == long
    last = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert {r.doc_id for r in last.collect()} == {1, 4, 5, None}


def test_near_copies_are_decided_by_row(spark):
    """Rows without an id, and different texts under one id, beside copies and repeated ids."""
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcde")
    rows = [(1, a), (1, a), (None, b), (None, c), (None, f"{c} more"), (None, a), (2, f"{a} more"), (2, d), (3, d), (3, e),
            (None, d), (4, ""), (4, None), (None, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_copies(spark, docs, None)
    assert got.columns == DOCUMENT_COLUMNS
    got = Counter((r.doc_id, r.text or "") for r in got.collect())
    assert got in [Counter([(1, a), (None, b), (None, t), (2, d), (3, e), (4, ""), (None, ""), (None, "")]) for t in (c, f"{c} more")]
