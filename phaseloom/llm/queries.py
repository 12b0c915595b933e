"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phaseloom.llm import chat, exact_dedup, fim, fingerprints, html_text, mixing, near_dedup, packing, sharding, sql, token_store, toxicity, url_filter, whitening
from phaseloom.llm.common import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), 16)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.deduplicate(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.formatted_digest(turns.unionByName(planted))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), path, capacity=2048, end_id=1)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), mixing.PRODUCTION)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


#: The rules of op7.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), RULES)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-store")
    token_store.write_store(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path, end_id=1)
    return token_store.read_store(spark, path)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shards": op1_shards,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_chat": op3_chat,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_fingerprints": op6_fingerprints,
    "op7_url_filter": op7_url_filter,
    "op8_near_dedup": op8_near_dedup,
    "op9_token_store": op9_token_store,
    "op10_toxicity": op10_toxicity,
    "op11_html_text": op11_html_text,
    "op12_whitening": op12_whitening,
    "op13_fim": op13_fim,
}

#: The others need checksums, tokenizers, sketches or models that SQL lacks.
SQL: dict[str, str] = {
    "op2_exact_dedup": sql.OP2,
    "op3_chat": sql.op3(),
    "op5_mixing": sql.op5(mixing.PRODUCTION),
    "op7_url_filter": sql.op7(RULES),
    "op13_fim": sql.op13(fim.Fim()),
}
