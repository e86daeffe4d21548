"""Queries of the corpus operators, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format, exact_dedup, hard_negatives, jaccard_join, language_id, license_scan, line_dedup, mixing, pii, quality,
    sentencepiece_match, substring_dedup, token_alignment,
)
from .common import documents

BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_classes(documents(spark, sf_dir), words=4, percent=85).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id"
    )


@query
def op2_line_dedup(spark, sf_dir):
    return line_dedup.cut_lines(documents(spark, sf_dir), min_lines=2).select(
        F.col("id").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    )


@query
def op3_mix_sources(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), F.col("size").cast("long").alias("size"), "source_size", "target", "taken", "source", "copies"
    )


@query
def op4_substring_dedup(spark, sf_dir):
    return substring_dedup.cut_repeats(documents(spark, sf_dir), window=20).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    )


@query
def op5_language_id(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return language_id.identify(documents(spark, sf_dir), held_out).withColumnRenamed("id", "doc_id")


@query
def op6_chat_format(spark, sf_dir):
    return chat_format.format_pairs(chat_format.neighbours(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


@query
def op7_sentencepiece(spark, sf_dir):
    encoded = sentencepiece_match.encode(documents(spark, sf_dir))
    return sentencepiece_match.decode(encoded).select(
        F.col("id").alias("doc_id"), F.size("ids").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query
def op8_quality_rules(spark, sf_dir):
    return quality.quality(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lang", "log_ppl", "low", "high",
    )


@query
def op9_personal_data(spark, sf_dir):
    return pii.digest(pii.find_personal(documents(spark, sf_dir))).withColumnRenamed("id", "doc_id")


@query
def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query
def op11_license_scan(spark, sf_dir):
    return license_scan.places(license_scan.scan(documents(spark, sf_dir))).select(
        F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op12_token_alignment(spark, sf_dir):
    aligned = token_alignment.align(documents(spark, sf_dir), BYTE_BPE, PIECE_BPE)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return token_alignment.with_link_counts(aligned.withColumn("groups_sha256", digest).drop("groups")).select(
        F.col("id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@query
def op13_hard_negatives(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, label=label)
