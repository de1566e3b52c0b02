"""The numbered queries: each applies its operator to its whole table of a folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    conversations,
    decontaminate,
    embeddings,
    html,
    language,
    merkle,
    pieces,
    quality,
    simhash,
    substrings,
    urls,
    warc,
)
from tidemark.llm.common import bucket, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.read_archive(bundles, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, F.coalesce(bucket(F.col("doc_id"), 3) != 1, F.lit(False)))
    held_out = F.coalesce(bucket(F.col("doc_id"), 3) == 1, F.lit(False))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER)
    return bpe.decode(encoded, TOKENIZER).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.col("readable").cast("binary"), 256).alias("readable_sha256"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = written(quality.measure(table(spark, sf_dir, "documents")), "statistics")
    fold = bucket(F.col("doc_id"), 5)
    model = quality.fit(measured, table(spark, sf_dir, "labels"), F.coalesce(fold != 0, F.lit(False)))
    return quality.score(measured, model).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = merkle.leaves(table(spark, sf_dir, "documents"), merkle.tampered_text())
    return merkle.proofs(merkle.manifest(leaves)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"), PIECES)
    return pieces.decode(encoded, PIECES).select(
        "doc_id",
        "n_tokens",
        "ids_sha256",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_decontamination,
        op3_language_id,
        op4_bpe,
        op5_substring_dedup,
        op6_embedding_dedup,
        op7_quality,
        op8_simhash,
        op9_html_extraction,
        op10_url_filters,
        op11_conversation_repair,
        op12_merkle_manifest,
        op13_sentencepiece,
    )
}
SQL = {
    "op1_warc": warc.SQL,
    "op2_decontamination": decontaminate.SQL,
    "op5_substring_dedup": substrings.SQL,
    "op6_embedding_dedup": embeddings.SQL,
    "op11_conversation_repair": conversations.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
