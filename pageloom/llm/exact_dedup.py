"""Exact dedup by a tree merge of sorted digest runs.

Rows are dealt into ``fan_in ** levels`` runs. A run holds one entry per digest,
sorted, with the row that stays and a count. In every round a run exchanges
entries with the ``fan_in - 1`` runs whose number differs from its own in one
digit: entries move to the run that has their digest's digit there, and what
arrives is merged. After the last digit the copies of a text have met in one run.
A frequent text enters the tree at most once per run, so it never meets as
whole rows; the outcome goes back by (run, digest), again once per run.

Entries are merged only when the 256-bit digest, a second hash and the length
all agree.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, free_names, store

KEY = ("digest", "check", "n_norm")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_chars, digest, check, n_norm) per row; null text counts as empty."""
    return (
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .select("id", F.char_length("text").alias("n_chars"), F.regexp_replace("text", SPACES, "").alias("norm"))
        .select(
            "id",
            "n_chars",
            F.unhex(F.sha2(F.encode("norm", "UTF-8"), 256)).alias("digest"),
            F.xxhash64("norm").alias("check"),
            F.char_length("norm").alias("n_norm"),
        )
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 16, run_rows: int = 4096
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest, n_chars.

    Texts are equal when they agree after deleting ASCII space characters. The row
    with the longest original text stays, then the smallest id (null ids last),
    then the first in reading order, so of rows repeated as a whole one stays.
    Null text counts as empty; an empty table gives an empty result.
    """
    base = store(keyed(docs, id_col, text_col).withColumn("pos", F.monotonically_increasing_id()), "digests")
    levels = max(1, math.ceil(math.log(max(1.0, base.count() / run_rows), fan_in)))
    base = base.withColumn("run", F.pmod(F.xxhash64("pos"), F.lit(fan_in**levels)))

    best = F.struct(
        (-F.col("n_chars")).alias("shorter"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("pos").alias("pos")
    )
    first = store(base.groupBy("run", *KEY).agg(F.min(best).alias("best"), F.count("*").alias("n")), "runs")
    merged = first
    for level in range(levels):
        unit = fan_in**level

        def digit(number):
            return F.pmod(F.floor(number / unit).cast("long"), F.lit(fan_in)) * unit

        slot = F.pmod(F.xxhash64("digest"), F.lit(fan_in**levels))
        merged = (
            merged.withColumn("run", F.col("run") - digit(F.col("run")) + digit(slot))
            .groupBy("run", *KEY)
            .agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        )
    # rows of texts that occur once are their own answer
    repeated = merged.where("n > 1").select(*KEY, F.col("best").alias("winner"), F.col("n").alias("group_size"))
    answers = first.select("run", *KEY).join(store(repeated, "repeated"), list(KEY))
    return (
        base.join(answers, ["run", *KEY], "left")
        .select(
            "id",
            F.when(F.col("winner").isNull(), F.col("id")).otherwise(F.col("winner.id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("winner.pos") == F.col("pos"), F.lit(True)).alias("kept"),
            "digest",
            "n_chars",
        )
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    digest, key, nth, kept_digest, kept_key = free_names(docs, "digest", "key", "nth", "kept_digest", "kept_key")
    kept = exact_groups(docs, id_col, text_col).where("kept").select(
        F.col("digest").alias(kept_digest), F.col("id").alias(kept_key)
    )
    normal = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, "")
    rows = docs.withColumn(digest, F.unhex(F.sha2(F.encode(normal, "UTF-8"), 256))).withColumn(key, F.col(id_col))
    # rows that repeat id and text as well: the longest, then any of the alike
    order = Window.partitionBy(digest, key).orderBy(F.char_length(F.coalesce(F.col(text_col), F.lit(""))).desc())
    same = (F.col(digest) == F.col(kept_digest)) & F.col(key).eqNullSafe(F.col(kept_key))
    return (
        rows.join(kept, same, "left_semi").withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*docs.columns)
    )
