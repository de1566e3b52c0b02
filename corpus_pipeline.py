"""A corpus from raw documents to tokens: five stages, each over what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, language, simhash, substrings
from tidemark.llm.common import written
from tidemark.llm.queries import TOKENIZER, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents whose language the model rejects."""
    model = language.train(docs, F.lit(True))
    return language.accepted(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave one document of each group of near copies: the one with the smallest id."""
    return simhash.first_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document has; a text that loses nothing stays as it is."""
    return substrings.cut_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text and decode it again, as the tokenizer file does and as running text."""
    return bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.col("readable").cast("binary"), 256).alias("readable_sha256"),
    )


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_each),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("bpe", tokens),
]
#: Language model, components and tokenizer are beyond SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
