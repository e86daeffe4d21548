"""Content deduplication by text fingerprint."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def nonempty(df: DataFrame, text: str = "merged_text") -> DataFrame:
    """Rows whose text is not blank and not made of punctuation only."""
    # an empty comparison form includes the blank case
    return df.where(T.normalize_text(text) != "")


def dedup_text(
    df: DataFrame, text: str = "merged_text", order_by: str = "page_id", fingerprint: str = "fp"
) -> DataFrame:
    """One row per text fingerprint: the one with the smallest ``order_by``,
    which must be unique.

    Only (fingerprint, order_by) goes through the aggregation, with partial
    results per task, so neither wide rows nor a text held by a third of all
    rows pile up in one place. The winners then pick their rows by the unique
    column and bring the fingerprint along, so it is computed once.
    """
    key = F.col(fingerprint) if fingerprint in df.columns else T.text_fingerprint(text)
    winners = df.select(key.alias(fingerprint), order_by).groupBy(fingerprint).agg(F.min(order_by).alias(order_by))
    return df.drop(fingerprint).join(winners, order_by).select(
        *[c for c in df.columns if c != fingerprint], fingerprint
    )


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``seen``."""
    return df.join(seen.select(key), key, "left_anti")


History = DataFrame | Callable[[DataFrame], DataFrame]


def unseen_small(df: DataFrame, seen: History, key: str) -> DataFrame:
    """:func:`unseen` for a small, already materialised ``df`` and a long history.

    The history is first reduced to the keys at hand. That lets Spark broadcast
    the small side and scan the history without shuffling it, while a plain
    anti join would shuffle all of it for every small batch. A history that can be looked up is a
    function from the keys at hand to the rows that may hold them; the rest of it is not read.
    """
    history = seen(df.select(key)) if callable(seen) else seen
    known = history.select(key).join(df.select(key), key, "left_semi").distinct()
    return df.join(known, key, "left_anti")


def unseen_by_all(df: DataFrame, histories: list[History | None], key: str, small: bool = False) -> DataFrame:
    """Rows whose key is in none of the histories: one join for all, or one lookup each if ``df`` is small."""
    present = [h for h in histories if h is not None]
    if small:
        for history in present:
            df = unseen_small(df, history, key)
        return df
    keys = [h.select(key) for h in present]
    return unseen(df, reduce(DataFrame.unionByName, keys), key) if keys else df


def dedup_history(
    df: DataFrame,
    seen: DataFrame,
    text: str = "merged_text",
    order_by: str = "page_id",
    fingerprint: str = "fp",
) -> tuple[DataFrame, DataFrame]:
    """Deduplicate ``df`` in itself and against the fingerprints in ``seen``.

    Returns the surviving rows and the fingerprints they add to the history.
    """
    kept = unseen(dedup_text(df, text, order_by, fingerprint), seen, fingerprint)
    return kept, kept.select(fingerprint)
