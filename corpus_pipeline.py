"""The corpus pipeline: toxic rows go, then copies and near copies, then sources are mixed and packed into sequences."""

from __future__ import annotations

from dataclasses import replace

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from phaseloom.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from phaseloom.llm.common import stored

#: Four fifths of the tokens that reach the mixture, each document once at most.
MIXTURE = replace(mixing.PRODUCTION, share=(4, 5), max_epochs=1)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that score as toxic go. It learns from the labels of the table folder.

    Null and empty texts have no words and are judged by the rates of the voters alone, so they stay. Rows of one doc_id
    are judged each by its own text; long texts are read whole. Without labels, lexicons and patterns decide. No rows, no result.
    """
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of texts that are equal but for white space the smallest doc_id stays (a null doc_id last; null and empty texts are equal)."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of documents that links of 85 % join, however indirectly, the smallest doc_id stays.

    Null and empty texts and those without words are linked with nothing and stay; rows without doc_id are told by their texts.
    """
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents are drawn to the target weights of MIXTURE; null language or source is a leaf of its own, null and empty texts have no tokens."""
    return mixing.mixed_documents(docs, MIXTURE)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: pieces of at most 2,048 ids; a null or empty text is its end id alone, a long one is cut at the capacity."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classifier, near-duplicate search and tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
