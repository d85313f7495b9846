"""Fill-in-middle, hard negatives and byte-level BPE against brute force and the library."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import bpe
from ledgerline.llm import hard_negatives as hn
from ledgerline.llm.fim import fill_in_middle, restore_text
from ledgerline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, fim string, ids string, __text string, __h1 int"
TEXTS = ["", None, "one", "  lead and trail \t\n", " \n ", "a<P>b c", "x <S", "S> y z <", "M> <P", "été 日本 😀  x y", "a b c d e f g h",
         "w " * 50_000, "long" * 50_000, " " * 50_000, "<|endoftext|> it's <|endof", "a\x1cb\x85c"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "f", "i", "t", 1) for k in range(6) for i, t in enumerate(TEXTS, 100 * k)]
    return spark.createDataFrame(rows + rows[:4] + [(None, "no id at all", None, None, None, None, None)], SCHEMA)


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+", text)
    digest = hashlib.sha256(b"42:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fim_equals_plain_cuts(spark, docs):
    done = fill_in_middle(docs)
    assert done.columns == ["doc_id", "text", "lang", "ids", "__text", "__h1", "fim"]
    got = done.select("doc_id", "text", "fim", restore_text(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.fim.n, r.fim.form, r.fim.prefix_chars, r.fim.middle_chars, r.fim.output) == plain_fim(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.fim.form for r in got} == {"plain", "spm", "psm"}
    assert fill_in_middle(docs.limit(0)).collect() == []


def test_fim_rates(spark):
    ids = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    forms = {r.form: r["count"] for r in fill_in_middle(ids, rate=100, spm=0).groupBy("fim.form").count().collect()}
    assert forms == {"psm": 400}
    assert fill_in_middle(ids, rate=0).where("fim.form <> 'plain'").count() == 0
    other = fill_in_middle(ids, seed=7).exceptAll(fill_in_middle(ids))
    assert other.count() > 100


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.read_tokenizer()


def test_bpe_equals_library(spark, docs, tokenizer):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_str(tokenizer)
    coded = bpe.decode_bpe(bpe.encode_bpe(docs, tokenizer), tokenizer)
    assert set(coded.columns) == {*docs.columns, "decoded"}
    for r in coded.collect():
        want = lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == lib.decode(want, skip_special_tokens=False)
    assert bpe.encode_bpe(docs.limit(0), tokenizer).collect() == []


def test_bpe_odd_strings(tokenizer):
    from tokenizers import Tokenizer

    lib, enc, dec = Tokenizer.from_str(tokenizer), bpe.BacktrackingEncoder(tokenizer), bpe.OffsetDecoder(tokenizer)
    rng = random.Random(5)
    pool = [*"aabbcdetioTHE  \n\t'.,=-_0129", "é", "ſ", "日本", "😀", "՘", "࢏", "<|endoftext|>", "<|endof", "'ll", "    ", "\xa0", " ",
            "​", "á", "�", "\x1c", "\x85"]
    for _ in range(4000):
        s = "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
        ids = lib.encode(s, add_special_tokens=False).ids
        assert enc.ids(s).tolist() == ids, s
        odd = ids + [rng.randrange(-3, 50_300) for _ in range(8)]
        assert dec.text(np.array(odd, np.int32)) == lib.decode([i for i in odd if i >= 0], skip_special_tokens=False)
    assert dec.text(np.zeros(0, np.int32)) == ""
    for s in ("ab" * 100_000, "=" * 100_000, "".join(rng.choice("abcdefgh") for _ in range(100_000))):
        assert enc.ids(s).tolist() == lib.encode(s, add_special_tokens=False).ids


def test_bpe_pairs_are_merges(tokenizer):
    """Compatible pairs are those that the merges, carried out one by one, leave as they are."""
    v = bpe.Vocabulary(tokenizer)
    pairs = bpe.PairTable(v.halves, 256)
    merge = {h: r for r, h in enumerate(v.halves) if r >= 256}

    def merged(text):
        out = list(text)
        while True:
            first = min(((merge[p], i) for i, p in enumerate(zip(out, out[1:])) if p in merge), default=None)
            if first is None:
                return out
            out[first[1]:first[1] + 2] = [first[0]]
    rng = random.Random(2)
    short = [r for r, t in enumerate(v.tokens) if len(t) < 6]
    seen = set()
    for _ in range(3000):
        x, y = rng.choice(short), rng.choice(short)
        seen.add(pairs.fits(x, y))
        assert pairs.fits(x, y) == (merged(v.tokens[x] + v.tokens[y]) == [x, y])
    assert seen == {True, False}


def test_bpe_settled_characters_split_as_in_library(tokenizer):
    import regex
    from tokenizers import Tokenizer

    split = Tokenizer.from_str(tokenizer).pre_tokenizer.pre_tokenize_str
    words, settled = regex.compile(bpe.WORDS), regex.compile(bpe.SETTLED)
    chars = [c for c in map(chr, range(0x10000)) if not 0xD800 <= ord(c) < 0xE000 and settled.fullmatch(c)]
    assert len(chars) > 30_000
    for i in range(0, len(chars), 4096):
        text = "".join(f"a{c}1{c}!{c} {c}  {c}a" for c in chars[i:i + 4096])
        assert [(m.start(), m.end()) for m in words.finditer(text)] == [x for _, x in split(text)]


def test_bpe_refuses_other_makes():
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.Vocabulary(bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json")))


def plain_negatives(rows, anchor, positives=5, negatives=3):
    """rows: (id, label, vector); every number in plain Python."""
    fine = [(i, y, [int(np.floor(np.float64(256) * np.float64(x))) for x in v]) for i, y, v in rows
            if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, y, q in filter(lambda r: anchor(r[0]), fine):
        near = sorted((-sum(a * b for a, b in zip(q, p)), j, z) for j, z, p in fine if j != i and len(p) == len(q))
        for s, j, _ in [x for x in near if x[2] == y][:positives]:
            fit = [(n, k) for n, k, z in near if z != y and 50 * -s <= 100 * -n <= 95 * -s]
            out += [(i, j, r, k, -s, -n) for r, (n, k) in enumerate(fit[:negatives], 1)]
    return out


def key(r):
    return tuple(map(str, r))


@pytest.mark.parametrize("block_bytes", [hn.BLOCK_BYTES, 200])
def test_negatives_equal_brute_force(spark, block_bytes):
    rng = random.Random(11)
    rows = [(i, rng.randrange(3), [rng.choice([-1.0, 0.0, 0.25, 0.5, 0.7, 1.0]) for _ in range(4)]) for i in range(-20, 180)]
    rows += [(i + 1000, 1, [1.0, 0.5, 0.0, 0.0]) for i in range(150)]  # a large group of equal vectors
    rows += rows[:12] * 2 + [(5000, 1, [0.0] * 4), (5001, 2, [1.0, 2.0]), (5005, 2, [0.5, 1.0]), (5010, 0, [1.0, 1.5]), (5015, 1, [])]
    rows += [(5020, None, [1.0] * 4), (5025, 1, None), (None, 1, [1.0] * 4), (5030, 1, [float("nan")] * 4), (5035, 2, [None, 1.0, 1.0, 1.0]),
             (5040, 2, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows],
                               "vec_id long, label int, embedding array<double>, __anchor string, block int").repartition(5)
    got = hn.mine_hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label"), block_bytes=block_bytes)
    want = plain_negatives(rows, lambda i: i % 5 == 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key) and len(want) > 300


def test_negatives_of_large_numbers(spark):
    rows = [(0, 1, [1e6, 3e5]), (1, 1, [1e6, 2e5]), (2, 0, [8e5, 1e5]), (3, 0, [7e5 + 0.123, 1e5]), (4, 1, [5e5, -1e6]), (5, 0, [6e5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = hn.mine_hard_negatives(df, F.col("vec_id") == 0, F.col("label"))
    assert sorted(map(tuple, got.collect())) == sorted(plain_negatives(rows, lambda i: i == 0))
    far = spark.createDataFrame([(0, 1, [1e300]), (1, 1, [1e300]), (2, 0, [5e299]), (3, 0, [1e-300])], df.schema)
    assert hn.mine_hard_negatives(far, F.col("vec_id") == 0, F.col("label")).collect() == []  # both at the end of 64 bits: not below


def test_negatives_without_anchors_or_rows(spark):
    df = spark.createDataFrame([(1, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    for rows in (df, df.limit(0)):
        assert hn.mine_hard_negatives(rows, F.col("vec_id") == 0, F.col("label")).collect() == []
    only = hn.mine_hard_negatives(df, F.col("vec_id") == 1, F.col("label"))
    assert only.collect() == [] and only.columns == [c.split()[0] for c in hn.SCHEMA.split(", ")]


def test_packed_keys_sort_as_pairs():
    far = 2**63 - 1
    pairs = [(a, s, k, i) for a in (0, 1, 300) for s in (-far, -1, 0, 5, far) for k in (0, 1) for i in (-far - 1, -1, 0, 7, far)]
    keys = [hn.pack(*(np.array([x]) for x in (a, s)), k, np.array([i]))[0] for a, s, k, i in pairs]
    assert [hn.unpack(x) for x in keys] == pairs
    assert [hn.unpack(x) for x in sorted(keys)] == sorted(pairs, key=lambda p: (p[0], -p[1], p[2], p[3]))


def test_bpe_query_digests(spark, tokenizer):
    from tokenizers import Tokenizer

    from tests.conftest import SF_SMALL

    lib = Tokenizer.from_str(tokenizer)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op13_backtracking_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --------------------------------------------------------------------------- earlier operators, mended

def test_no_language_is_crowded_out(spark):
    """All rows of a language under one id, or with one text, still teach it; what is collected stays bounded."""
    from ledgerline.llm import langid

    en, de = "the cat and the dog of the house number", "der hund und die katze von dem haus nummer"
    rows = [(7, f"{en} {i}", "en") for i in range(900)] + [(i, f"{de} {i}", "de") for i in range(700)] + [(i, "le chat et le chien", "fr") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train_languages(docs, F.lit(True), per_language=50)
    assert model.languages == ["de", "en", "fr"]
    got = langid.predict_languages(docs, model).groupBy("lang", "language.lang").count().collect()
    assert {(r[0], r[1]) for r in got} == {("en", "en"), ("de", "de"), ("fr", "fr")}


def test_quality_sample_is_bounded_by_row(spark, monkeypatch):
    from ledgerline.llm import quality

    docs = spark.createDataFrame([(i % 40, f"{'good plain words' if i % 2 else 'buy now $$$ click'} {i // 40}", 10) for i in range(4000)],
                                 "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 3, "doc_id long, quality int")
    seen = []

    class Counted(quality.FactorisationMachine):
        def __init__(self, rows, y, prior):
            seen.append((int((y == 0).sum()), int((y == 1).sum())))
            super().__init__(rows, y, prior)
    monkeypatch.setattr(quality, "FactorisationMachine", Counted)
    model = quality.train_quality(docs, labels, F.lit(True), per_class=30)
    assert seen == [(30, 30)]
    scores = quality.score_quality(docs, model).groupBy(F.col("doc_id") % 2).agg(F.avg("quality_score")).collect()
    assert dict(map(tuple, scores))[1] > dict(map(tuple, scores))[0]


@pytest.mark.parametrize("depth", [1, 8, 9, 40])
def test_article_within_many_wrappers(depth):
    from ledgerline.llm.extract import page_blocks

    page = "<body>" + "<div class='widget'>" * depth + "<p>" + "The article goes on and on. " * 20 + "</p>" + "</div>" * depth + "<p>Just beside it here</p></body>"
    assert any(b[0].startswith("The article goes on") for b in page_blocks(page))


def test_unclosed_tags_and_comments():
    import time

    from ledgerline.llm.extract import page_blocks

    for page in ("<a " * 350_000, "<p>x</p>" + "<a " * 350_000, "<div '" * 170_000 + ">"):
        start = time.perf_counter()
        page_blocks(page)
        assert time.perf_counter() - start < 5
    def text(page):
        return [b[0] for b in page_blocks(page)]
    assert text("<p>one</p><!-- two <b>three</b> four") == ["one"]
    assert text("<p>one</p><script>if (a > b) four") == ["one"]
    assert text("<p>one</p><script>x</script>two") == ["one", "two"]
    assert text("<p>one</p><!-- x -->two <b") == ["one", "two <b"]
    assert text("<p>one</p>two <!-- three") == ["one", "two"]


def test_many_linked_secrets_are_linear(spark):
    import time

    from ledgerline.llm import secrets as sc

    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzEXAMPLEKEY"
    text = "\n".join(f"CLIENT_ID=svc-{i}\nKEY={key}" for i in range(20_000))
    start = time.perf_counter()
    found = sc.link_parts(text, sc.base_spans(text))
    assert time.perf_counter() - start < 10 and sum(k == "blob" for _, _, k in found) == 20_000 and sum(k == "id" for _, _, k in found) == 20_000


def test_large_and_small_doubles_link(spark):
    from ledgerline.llm.embedding_dedup import near_vectors

    rows = [(1, [1e200, 2e200, 3e200]), (2, [1.0001e200, 2e200, 3e200]), (3, [1e-200, 2e-200, 3e-200]), (4, [3.0, -2.0, 0.5])]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.9).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}


def test_columns_named_like_the_operators_own(spark):
    from ledgerline.llm import decontaminate as dc
    from ledgerline.llm import secrets as sc
    from ledgerline.llm.extract import extract_text

    own = ["__secrets", "__contamination", "__host", "__paths", "__HOST_"]
    df = spark.createDataFrame([(1, "password: hunter22", "https://a.example/x", "<p>text</p>", *own)],
                               "doc_id long, text string, url string, html string, " + ", ".join(f"{c} string" for c in own))
    bench = spark.createDataFrame([(9, "nothing of it")], "item_id long, text string")
    for out in (sc.redact_secrets(df), dc.decontaminate(df, bench), extract_text(df, out="main").drop("main")):
        assert out.columns == df.columns and [out.first()[c] for c in own] == own


def test_shard_files_are_skipped_by_every_dimension(spark, tmp_path):
    """Files' min/max statistics leave few files to a filter on either category or on the size."""
    import glob

    import pyarrow.parquet as pq

    from ledgerline.llm.hilbert import quantise_log, shard_by_curve, with_rank, write_shards

    rng = random.Random(6)
    rows = [(i, rng.choice("abcdefgh"), f"src{rng.randrange(16):02d}", rng.randrange(1, 1 << 20)) for i in range(8000)]
    df = spark.createDataFrame(rows + [(9000, None, None, 5), (9001, None, "src03", None)], "id long, lang string, source string, size long")
    ranked = with_rank(with_rank(df, "lang", 4, "l"), "source", 4, "s")
    assert ranked.where("lang is null and l <> 0").count() == 0 and ranked.select("l").distinct().count() == 9
    placed = shard_by_curve(ranked, [F.col("l"), F.col("s"), quantise_log(F.col("size"), 4, 20)], [F.col("id")], 8, 4)
    write_shards(placed, str(tmp_path / "out"), 125)
    assert rows_of(spark, tmp_path / "out") == 8002
    files = []
    for f in glob.glob(f"{tmp_path}/out/shard=*/*.parquet"):
        md = pq.ParquetFile(f).metadata
        assert md.num_rows <= 125
        stats = {md.schema.column(i).name: md.row_group(0).column(i).statistics for i in range(md.num_columns)}
        files.append({c: (stats[c].min, stats[c].max) for c in ("lang", "source", "size") if stats[c].has_min_max})
    assert len(files) >= 64
    for c, value in (("lang", "c"), ("source", "src07"), ("size", 300)):
        hit = [f for f in files if c not in f or f[c][0] <= value <= f[c][1]]
        assert len(hit) < 0.5 * len(files), (c, len(hit), len(files))
    both = [f for f in files if all(c in f and f[c][0] <= v <= f[c][1] for c, v in (("lang", "c"), ("source", "src07")))]
    assert len(both) < 0.2 * len(files)


def rows_of(spark, path):
    return spark.read.parquet(str(path)).count()
