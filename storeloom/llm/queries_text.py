"""Queries of the operators that read whole texts in Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.llm import jaccard_join, language_id, lattice_lm, licenses, nn_descent, packing, secrets, warc
from storeloom.llm.registry import query, table
from storeloom.llm.vocabularies import tokenizer_path


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.identify(documents.select("doc_id", "text"), F.col("text"), language_id.train_on_folds(documents))
    doc_id = F.col("row.doc_id")
    return found.select(doc_id, language_id.held_out(doc_id, 4).alias("held_out"), "lang_pred", "score")


@query("op5_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    kept_out = language_id.held_out(F.col("doc_id"), 7)
    scored = lattice_lm.score_documents(documents, F.col("text"), ~kept_out, tokenizer_path("piece_bpe_32k.model"),
                                        keep=("doc_id",))
    doc_id = F.col("row.doc_id")
    return scored.select(doc_id, language_id.held_out(doc_id, 7).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), F.col("text"), tokenizer_path("word_bpe_49k.json"))


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), F.col("text"), keep=("doc_id",))

    def of(kind: str):
        return F.filter("found", lambda s: s["rank"] == secrets.KINDS.index(kind))

    base = F.filter("found", lambda s: s["rank"] < 3)
    return found.select(
        "row.doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(secrets.written(base).cast("binary"), 256).alias("base_sha256"),
        secrets.written(F.col("found")).alias("spans"))


@query("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), F.col("text"), keep=("doc_id",))
    return found.select("row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op6_ngram_jaccard_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
newest AS (SELECT hex, max(page_id) AS newest FROM p GROUP BY hex)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       translate(concat(lpad(to_base(CAST('0x' || hex[1:10] AS BIGINT), 32), 8, '0'),
                        lpad(to_base(CAST('0x' || hex[11:20] AS BIGINT), 32), 8, '0'),
                        lpad(to_base(CAST('0x' || hex[21:30] AS BIGINT), 32), 8, '0'),
                        lpad(to_base(CAST('0x' || hex[31:40] AS BIGINT), 32), 8, '0')),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM p JOIN newest USING (hex)
"""


@query("op1_warc", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_embedding_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))
