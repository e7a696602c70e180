"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all that the one before
kept; it is written as Parquet and read again as the next one's docs. All stages
but the last return the columns of documents. Texts are read whole, however long;
empty tables give empty tables; columns besides doc_id, text and source, whatever
their names, pass through. What a stage makes of null and empty texts, null ids,
ties and repeated rows is said at each.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quire.llm import mixing, near_dup, packing, pii, quality
from quire.llm.store import discard, materialise

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go.

    Null and empty texts have no words and go; null ids don't matter; repeated rows are judged alike; there are no ties.
    """
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id.

    Null and empty texts and rows with a null doc_id stay. Of equal rows one stays; rows of one doc_id with unlike texts
    are judged each by its own text.
    """
    return near_dup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind.

    Null texts stay null, empty ones empty; null ids don't matter; repeated rows are rewritten alike; of overlapping
    spans the likelier counts, then the longer and earlier.
    """
    return pii.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated so that sources come near their targets.

    Null and empty texts have no words and go; a null source is one of its own; a null doc_id is a key like any other;
    rows of one doc_id and key stand or fall together, ties go by doc_id.
    """
    return mixing.take(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and where they lie.

    A null or empty text is its end token alone; null ids pass through; repeated rows are packed each; of items of equal
    worth the largest goes first.
    """
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packing", pack),
]

#: Signatures, trees and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)  # a stage's table goes when the next one is written; the input isn't one of them
    return STAGES[-1][1](spark, docs, sf_dir)
