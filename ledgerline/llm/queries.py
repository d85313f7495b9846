"""The operators' registered queries (``opN_<name>``) and, where SQL can express them, their DuckDB oracles.

Each query is a thin call of its operator on the whole of its table, with the digest columns derived from the operator's
result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans.tables import Tables
from ledgerline.session import scratch_path

from . import decontaminate as dc
from . import secrets as sc
from .bpe import decode_bpe, encode_bpe
from .bpe import read_tokenizer as read_bpe
from .embedding_dedup import near_vectors
from .extract import extract_text
from .fim import fill_in_middle, restore_text
from .hard_negatives import mine_hard_negatives
from .hilbert import quantise_log, shard_by_curve, with_rank
from .jaccard_join import jaccard_groups
from .langid import predict_languages, train_languages
from .pieces import decode_pieces, encode_pieces, read_model
from .quality import score_quality, train_quality
from .token_files import read_token_files, read_tokenizer, write_token_files

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def fold(id_col: str = "doc_id"):
    """Remainder of an id's fold: rows of 1 are held out of learning.  A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def held_out():
    return (fold() == 1).alias("held_out")


def sha(c):
    return F.sha2(c.cast("binary"), 256)


# ---------------------------------------------------------------------------------------------- 1

@query("op1_factorisation_quality")
def op1(spark, sf_dir):
    """Quality score of every document; learned from labels outside the held-out fold."""
    t = Tables(spark, sf_dir)
    model = train_quality(t.documents, t.labels, fold() != 1)
    scored = score_quality(t.documents, model).select("doc_id", held_out(), F.col("quality_score").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


# ---------------------------------------------------------------------------------------------- 2

@query("op2_hilbert_shards")
def op2(spark, sf_dir):
    """All documents in eight runs of the Hilbert curve through language, source and size, counts at most one apart."""
    docs = Tables(spark, sf_dir).documents
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = with_rank(with_rank(rows, "lang", 8, "lang_rank"), "source", 8, "source_rank")
    dims = [F.col("lang_rank"), F.col("source_rank"), quantise_log(F.col("size"), 8)]
    placed = shard_by_curve(rows, dims, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], 8, 8,
                            [F.col("doc_id"), F.col("size"), F.col("text_crc32")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve", "position")


# ---------------------------------------------------------------------------------------------- 3

@query("op3_linked_secrets")
def op3(spark, sf_dir):
    """Secrets in every document: the base kinds, and weak parts whose complements stand near."""
    found = sc.find_secrets(Tables(spark, sf_dir).documents)
    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), sha(sc.joined(base)).alias("base_sha256"),
                        sc.joined(F.col("secrets")).alias("spans"))


# ---------------------------------------------------------------------------------------------- 4

VECTORS_SQL = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r AS (SELECT a AS vec_id, a AS node FROM n UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.node = l.a),
c AS (SELECT vec_id, min(node) AS c FROM r GROUP BY vec_id)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.c, v.vec_id) AS component_id, v.vec_id = coalesce(c.c, v.vec_id) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN c ON c.vec_id = v.vec_id"""


@query("op4_sign_hash_dedup", VECTORS_SQL)
def op4(spark, sf_dir):
    """Every vector with its number of links at cosine 0.9 and its component."""
    return near_vectors(Tables(spark, sf_dir).embeddings, 0.9)


# ---------------------------------------------------------------------------------------------- 5

@query("op5_consensus_extract")
def op5(spark, sf_dir):
    """The main text of every page by its host's winning container path."""
    return extract_text(Tables(spark, sf_dir).pages).select("page_id", "url", "text",
                                                            F.char_length("text").cast("long").alias("n_chars"))


# ---------------------------------------------------------------------------------------------- 6

_PLAIN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

DECONTAMINATION_SQL = rf"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_PLAIN}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_PLAIN}') AS ws FROM benchmark),
g AS (SELECT DISTINCT item_id, least(13, len(ws)) AS m,
        unnest(list_transform(range(1, len(ws) - least(13, len(ws)) + 2),
                              lambda i: array_to_string(ws[i:i + least(13, len(ws)) - 1], ' '))) AS gram FROM b WHERE len(ws) > 0),
k AS (SELECT DISTINCT m FROM g),
p AS (SELECT doc_id, m, unnest(range(1, len(ws) - m + 2)) AS p0, ws FROM d, k WHERE len(ws) >= m),
x AS (SELECT doc_id, m, p0, array_to_string(ws[p0:p0 + m - 1], ' ') AS gram FROM p),
h AS (SELECT x.doc_id, x.m, x.p0, g.item_id FROM x JOIN g ON x.m = g.m AND x.gram = g.gram),
w AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p0, p0 + m)) AS pos FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(w.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(w.n_hit, 0) > 0 AND 20 * coalesce(w.n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN w USING (doc_id) LEFT JOIN i USING (doc_id)"""


@query("op6_broadcast_decontam", DECONTAMINATION_SQL)
def op6(spark, sf_dir):
    """Every document with its hit words and the benchmark items whose windows occur in it."""
    t = Tables(spark, sf_dir)
    marked = dc.mark_contamination(t.documents, t.benchmark, out="c")
    return marked.select("doc_id", "c.n_words", dc.n_hit("c").alias("n_hit"), F.size("c.items").cast("long").alias("n_items"),
                         sha(F.array_join("c.items", ",")).alias("items_sha256"), dc.is_contaminated("c").alias("contaminated"))


# ---------------------------------------------------------------------------------------------- 7

JACCARD_SQL = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 4
        THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b USING (x)
      WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT a AS doc_id, a AS node FROM (SELECT DISTINCT a FROM l) UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.node = l.a),
c AS (SELECT doc_id, min(node) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN c USING (doc_id)"""


@query("op7_parity_sketch_join", JACCARD_SQL)
def op7(spark, sf_dir):
    """Every document with its shingle count and its component of Jaccard links (4 words, 0.85)."""
    return jaccard_groups(Tables(spark, sf_dir).documents, shingle=4, threshold=85)


# ---------------------------------------------------------------------------------------------- 8

@query("op8_chunk_table_pieces")
def op8(spark, sf_dir):
    """Every document's SentencePiece ids and the text decoded from them, as digests."""
    model = read_model()
    coded = decode_pieces(encode_pieces(Tables(spark, sf_dir).documents.select("doc_id", "text"), model), model)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
                        sha(F.col("decoded")).alias("decoded_sha256"))


# ---------------------------------------------------------------------------------------------- 9

@query("op9_hierarchical_langid")
def op9(spark, sf_dir):
    """Predicted language of every document; learned from the documents outside the held-out fold."""
    docs = Tables(spark, sf_dir).documents
    model = train_languages(docs, (fold() != 1) & F.col("doc_id").isNotNull())
    return predict_languages(docs, model).select("doc_id", held_out(), F.col("language.lang").alias("lang_pred"),
                                                 F.col("language.score").alias("score"))


# ---------------------------------------------------------------------------------------------- 10

@query("op10_range_coded_ids")
def op10(spark, sf_dir):
    """Every document's place, length and checksum, as read back from range-coded token files."""
    path = scratch_path(spark, "token-files")
    write_token_files(Tables(spark, sf_dir).documents, path, read_tokenizer())
    return read_token_files(spark, path, with_ids=False)


# ---------------------------------------------------------------------------------------------- 11

FIM_SQL = r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us,
        CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
c AS (SELECT *, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
             WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(us[1:a], '') AS prefix, array_to_string(us[a + 1:b], '') AS middle,
        array_to_string(us[b + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""


@query("op11_repeated_capture_fim", FIM_SQL)
def op11(spark, sf_dir):
    """Every document rearranged for fill-in-middle, and restored, as digests."""
    done = fill_in_middle(Tables(spark, sf_dir).documents.select("doc_id", "text"))
    return done.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", sha(F.col("fim.output")).alias("output_sha256"),
                       sha(restore_text(F.col("fim.output"), F.col("fim.form"))).alias("restored_sha256"))


# ---------------------------------------------------------------------------------------------- 12

NEGATIVES_SQL = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
o AS (SELECT anchor_id, id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM p WHERE same),
n AS (SELECT o.anchor_id, o.id AS positive_id, o.score AS positive_score, p.id AS negative_id, p.score AS negative_score,
        row_number() OVER (PARTITION BY o.anchor_id, o.id ORDER BY p.score DESC, p.id) AS r
      FROM o JOIN p ON p.anchor_id = o.anchor_id AND NOT p.same AND 50 * o.score <= 100 * p.score AND 100 * p.score <= 95 * o.score
      WHERE o.r <= 5)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 3"""


@query("op12_secondary_sort_negatives", NEGATIVES_SQL)
def op12(spark, sf_dir):
    """Hard negatives of every anchor (ids divisible by 50) and its first five positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(Tables(spark, sf_dir).embeddings, F.col("vec_id") % 50 == 0, label)


# ---------------------------------------------------------------------------------------------- 13

@query("op13_backtracking_bpe")
def op13(spark, sf_dir):
    """Every document's byte-level BPE ids and the text decoded from them, as digests."""
    tokenizer = read_bpe()
    coded = decode_bpe(encode_bpe(Tables(spark, sf_dir).documents.select("doc_id", "text"), tokenizer), tokenizer)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
                        sha(F.col("decoded")).alias("decoded_sha256"))
