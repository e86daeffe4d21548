"""From raw documents to token ids: quality rules, exact dedup, near-duplicate join,
mixing of sources, encoding.

Every stage takes what the one before kept, as Parquet in the shared folder, so a
lost executor or a stopped job repeats one stage at most. All stages but the last
return the columns of ``documents``; a document that the mix takes twice is there twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import exact_dedup, jaccard_join, mixing, quality, sentencepiece_match
from pageloom.llm.common import documents, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or their language's perplexity band go."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest stays, then the smallest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 over five-word shingles the
    smallest doc_id stays."""
    return jaccard_join.keep_one(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share of one and a half times all words asks for."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every row."""
    return sentencepiece_match.encode(docs).select(F.col("id").alias("doc_id"), F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode),
]

# the model, the random rounding and the encoding are beyond SQL; tests/llm has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
