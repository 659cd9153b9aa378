"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, media, merkle, mixing, quality, sharding, simhash, spans, suffix, toxicity

#: wanted token totals by domain, as multiples of the present ones
MIX = {"clean": 1.02, "low": 0.2, "toxic": 0.1}
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op3_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that is left, and what went, of every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.dedup(docs).select("row.doc_id", "row.text", "n_units", "n_removed")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(common.table(spark, sf_dir, "documents"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(common.table(spark, sf_dir, "documents"))


def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.with_followers(common.table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    rated = mixing.rate_documents(docs, docs, common.table(spark, sf_dir, "labels"), MIX)
    return rated.drop("h")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(common.table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(common.table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_quality, op3_spans, op4_toxicity, op5_suffix, op6_media, op7_merkle, op8_mixing, op9_bpe, op10_sharding)}

#: none of the ten can be said in SQL as a whole; tests/llm holds them against brute force
ORACLE_SQL: dict[str, str] = {}
