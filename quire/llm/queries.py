"""Queries of the training-data operators, one for each, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import ann, bpe, chat, langid, mixing, near_dup, packing, pii, quality, toxicity
from quire.llm.sql import ORACLE

COUNTED, PACKED = "byte_bpe_50k.json", "word_bpe_49k.json"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0, k=5)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decisions(_documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = bpe.token_counts(_documents(spark, sf_dir), public_tokenizers.path(COUNTED))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.toxicity(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_documents(spark, sf_dir), words_per_shingle=3, percent=85)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(_documents(spark, sf_dir), public_tokenizers.path(PACKED))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return langid.languages(docs, langid.train(docs))


def op8_reply_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_ordered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(_documents(spark, sf_dir))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *(F.col(f"quality.{c}").alias(c) for c in names))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_documents(spark, sf_dir))


def queries() -> dict:
    own = (op1_nearest_neighbours, op2_source_mix, op3_token_counts, op4_toxicity, op5_near_duplicates, op6_packing, op7_language, op8_reply_order, op9_quality_rules, op10_personal_data)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
