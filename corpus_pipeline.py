"""Corpus pipeline: language ID, near-duplicate removal, benchmark decontamination, secret redaction, tokenization.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a frame that is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import spare, store
from ledgerline.llm.decontaminate import decontaminate
from ledgerline.llm.jaccard_join import jaccard_groups
from ledgerline.llm.langid import UNDETERMINED, predict_languages, train_languages
from ledgerline.llm.pieces import decode_pieces, encode_pieces, read_model
from ledgerline.llm.queries import fold, sha
from ledgerline.llm.secrets import redact_secrets
from ledgerline.plans.tables import Tables


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language can't be determined: null texts and texts without a letter, and all of them when
    there is nothing to learn from.  Repeated rows are decided alike; an empty table stays empty."""
    model = train_languages(docs, (fold() != 1) & F.col("doc_id").isNotNull())
    out = spare(docs, "language")
    return predict_languages(docs, model, out=out).where(F.col(f"{out}.lang") != UNDETERMINED).drop(out)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group linked by Jaccard >= 0.8 of five-word shingles: the one of the smallest id.

    Rows are decided by their texts, each for itself: rows of one id with different texts may all stay, a row without an id
    goes only when a row linked to it stays.  Rows without words link with nothing; of those with the same id, one stays.
    """
    row = spare(docs, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())  # the same at every read of a stored frame
    groups = jaccard_groups(numbered, shingle=5, threshold=80, id_col=row)
    groups = groups.select(F.col("doc_id").alias(row), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("group"))
    alone = F.col("group").isNull()
    first = (numbered.select(row, "doc_id").join(groups, row)
             .groupBy("group", F.when(alone, F.col("doc_id")), F.when(alone & F.col("doc_id").isNull(), F.col(row)))
             .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row))).alias("first")))
    return numbered.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold benchmark text, by the same rule as the query of operator 6.  Null and empty texts hold
    none, an empty benchmark drops nothing; repeated rows are decided alike."""
    return decontaminate(docs, Tables(spark, sf_dir).benchmark)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets, and weak parts whose complements stand near, in the texts; ``n_chars`` follows changed texts.  Every row
    stays, repeated ones too; null and empty texts stay as they are."""
    old = spare(docs, "old")
    clean = redact_secrets(docs.withColumn(old, F.col("text")))
    return clean.withColumn("n_chars", F.when(F.col("text") != F.col(old), F.char_length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids, their number, and digests of ids and decoded text; one row a row, null and empty texts without ids."""
    model = read_model()
    coded = decode_pieces(encode_pieces(docs.select("doc_id", "text"), model), model)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
                        sha(F.col("decoded")).alias("decoded_sha256"), "ids")


STAGES = [("language_id", identify_language), ("near_copies", drop_near_copies), ("decontamination", drop_contaminated),
          ("secrets", redact), ("tokens", tokenize)]

#: SQL can't express language ID and tokenization.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
