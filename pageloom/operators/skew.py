"""Joins whose left side may have very frequent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

ROWS_PER_TASK = 1_000_000
BROADCAST_KEYS = 100_000  # more frequent keys than this are joined by shuffle


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """Keys with more rows than one task should get, as (key, n_parts).

    Returns None if there are none. Counting uses partial aggregation, so a
    frequent key does not hurt here.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return hot_keys_of_counts(counts, key, rows_per_task)


def hot_keys_of_counts(counts: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """:func:`hot_keys` when (key, n_rows) is already known.

    Every key above ``rows_per_task`` is in the result, which stays a table:
    it has at most rows / ``rows_per_task`` rows.
    """
    hot = cut_lineage(
        counts.where(F.col("n_rows") > rows_per_task).select(
            key, F.ceil(F.col("n_rows") / rows_per_task).cast("int").alias("n_parts")
        )
    )
    return None if hot.isEmpty() else hot


def split_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    hot: DataFrame | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Equi-join on ``key`` that spreads the rows of frequent left keys.

    ``hot`` comes from :func:`hot_keys` on the left side. Left rows of a
    frequent key get one of ``n_parts`` part numbers from a hash of
    ``spread_by``; right rows of such a key are repeated once per part. Other
    keys are joined as usual, so nothing is copied without need. ``how`` may be
    inner, left, left_semi or left_anti. ``hot`` is broadcast only if it is small.
    """
    if hot is None:
        return left.join(right, key, how)
    if hot.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    spread = F.xxhash64(*([spread_by] if spread_by else left.columns))
    left_parts = left.join(hot, key, "left").withColumn(
        "_part", F.when(F.col("n_parts").isNull(), F.lit(0)).otherwise(F.pmod(spread, F.col("n_parts")).cast("int"))
    ).drop("n_parts")
    right_parts = right.join(hot, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n_parts"), F.lit(1)) - 1))
    ).drop("n_parts")
    return left_parts.join(right_parts, [key, "_part"], how).drop("_part")
