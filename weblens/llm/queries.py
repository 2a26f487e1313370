"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from weblens.llm.common import documents
from weblens.llm.conversations import audited_conversations
from weblens.llm.hamming import nearest_codes, sign_codes
from weblens.llm.mixing import mix
from weblens.llm.neardup import near_duplicates
from weblens.llm.ngram_join import jaccard_components
from weblens.llm.packing import pack_documents
from weblens.llm.pii import surrogate_pii
from weblens.llm.quality import score_quality
from weblens.llm.secret_scan import KINDS, Rule, listed, of_kind, scan_secrets
from weblens.llm.sharding import shard_documents
from weblens.llm.simple8b import binary_output
from weblens.llm.toxicity import score_toxicity
from weblens.llm.whitening import whitened_components

NEAREST = 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"), 0.95)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir), (3, 1, 2), (3, 2), 2)
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                        F.col("_target").alias("target"), (F.col("_size") * F.col("_repeats")).alias("taken"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(documents(spark, sf_dir).select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_output(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), 16)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(documents(spark, sf_dir).select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "examples", "similarities", F.col("terms").alias("evidence"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), 4, 85, 100)


def op8_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = sign_codes(_table(spark, sf_dir, "embeddings"))
    return nearest_codes(codes, codes.filter("vec_id % 20 = 0"), NEAREST)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = surrogate_pii(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "text", "pii_kinds", "pii_spans")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitened_components(_table(spark, sf_dir, "embeddings"), 4)
    return done.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Rule(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    spans = F.col("secrets")
    return scan_secrets(documents(spark, sf_dir).select("doc_id", "text"), rule).select(
        "doc_id", *[of_kind(spans, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(F.filter(spans, lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        listed(spans).alias("spans"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited_conversations(_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_near_duplicates, op2_source_mix, op3_quality, op4_simple8b, op5_shards, op6_toxicity, op7_ngram_jaccard,
    op8_hamming_topk, op9_packing, op10_surrogates, op11_whitening, op12_secret_scan, op13_conversation_repair)}
