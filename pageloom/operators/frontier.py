"""Admission of links, pending URLs and the link graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.expr import column, filter_array
from ..session import cut_lineage, materialise
from .dedup import History, unseen, unseen_by_all
from .growing import Growing
from .rules import exclude_urls
from .skew import BROADCAST_KEYS, ROWS_PER_TASK, hot_keys


def depth_at_most(df: DataFrame, max_depth: int | None) -> DataFrame:
    """Rows up to a depth; None keeps all."""
    return df if max_depth is None else df.where(F.col("depth") <= max_depth)


def _absolute_or_none(url: str) -> str:
    """Array with the canonical URL, empty unless it has a network location."""
    return filter_array(f"array({U.normalize_url_sql(url)})", lambda u: f"{U.netloc_sql(u)} <> ''")


def admit(
    candidates: DataFrame,
    visited: DataFrame | list[History | None],
    parsed: History | None = None,
    rules: DataFrame | None = None,
    max_depth: int | None = None,
    known_keys: DataFrame | list[History | None] | None = None,
    small_batch: bool = False,
) -> DataFrame:
    """New pending URLs (url, depth, content_key) from candidates (url, depth).

    URLs are made canonical, filtered (absolute, depth, rules), reduced to one
    per content key (smallest depth, then URL), and dropped if visited, parsed
    or of a known content key. Cheap row-local filters come first; a link that
    occurs very often is reduced by partial aggregates before any join. Several tables of known URLs or keys
    are given as lists; in a ``small_batch`` they may be lookups (:func:`unseen_small`).
    """
    found = (
        candidates.transform(depth_at_most, max_depth)
        # the test sits in the row: as a filter it would compute the URL twice
        .select(F.explode(column(_absolute_or_none("url"))).alias("url"), "depth")
        # equal links first: fewer rows for the costlier columns below
        .groupBy("url")
        .agg(F.min("depth").alias("depth"))
    )
    if rules is not None:
        found = exclude_urls(found, "url", rules)
    best = (
        found.withColumn("content_key", U.content_key("url"))
        .groupBy("content_key")
        .agg(F.min(F.struct("depth", "url")).alias("best"))
        .select("best.url", "best.depth", "content_key")
    )
    if small_batch:
        best = cut_lineage(best)
    new = unseen_by_all(best, [*_listed(visited), parsed], "url", small_batch)
    return unseen_by_all(new, _listed(known_keys), "content_key", small_batch)


def _listed(history) -> list[History | None]:
    return history if isinstance(history, list) else [history]


def merge_links(
    frontier: DataFrame,
    extra: DataFrame,
    visited: DataFrame,
    parsed: DataFrame,
    max_depth: int | None = None,
) -> DataFrame:
    """Frontier plus an extra link list (url, depth).

    Extra links are made canonical and must be new and not too deep; exclusion
    rules and content keys do not apply to them. A missing depth is 0.
    """
    added = (
        extra.select(U.normalize_url("coalesce(url, '')").alias("url"), F.coalesce("depth", F.lit(0)).alias("depth"))
        .where("url <> ''")
        .transform(depth_at_most, max_depth)
        .groupBy("url")
        .agg(F.min("depth").alias("depth"))
    )
    history = visited.select("url").unionByName(parsed.select("url")).unionByName(frontier.select("url"))
    return frontier.select("url", "depth").unionByName(unseen(added, history, "url"))


def link_depths(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Shortest number of hops from any seed (url) over edges (src, dst).

    One job per level. The edges are dealt out by source once, persisted, and stay where they are
    (:func:`placed_edges`): only the level moves. Each level is written to the shared folder, so plans stay short and a
    lost executor does not restart the walk; targets are reduced by partial aggregates.
    """
    edges = materialise(edges.select(F.col("src").alias("url"), "dst").where("url <> dst").distinct(), "edges")
    hot = hot_keys(edges, "url", rows_per_task)
    if hot is not None and hot.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    placed = placed_edges(edges, hot)
    level = materialise(seeds.select("url").distinct().withColumn("depth", F.lit(0)), "level")
    known = Growing(edges.sparkSession, "url string, depth int", "reached")
    known.add(level)
    depth = 0
    while (max_depth is None or depth < max_depth) and not level.isEmpty():
        depth += 1
        targets = edges_of(level, placed, hot).select(F.col("dst").alias("url")).distinct()
        level = materialise(targets.join(known.rows().select("url"), "url", "left_anti").withColumn("depth", F.lit(depth)), "level")
        known.add(level)
    placed.unpersist()
    return known.rows()


def placed_edges(edges: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Edges (url, dst), dealt out and sorted by source and kept so.

    If there are frequent sources (:func:`hot_keys`), their edges are spread over parts, and ``part`` is a second key.
    """
    n, keys = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["url"]
    if hot is not None:
        keys = ["url", "part"]
        part = F.when(F.col("n_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("dst"), F.col("n_parts")).cast("int"))
        edges = edges.join(hot, "url", "left").select("url", part.alias("part"), "dst")
    placed = edges.repartition(n, *keys).sortWithinPartitions(*keys).persist()
    placed.count()  # Spark knows how a persisted table is dealt out once it is there
    return placed


def edges_of(level: DataFrame, placed: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Edges whose source is in a level. Nothing of ``placed`` is shuffled or sorted again; a frequent
    source asks all of its parts."""
    asking, keys = level.select("url"), ["url"]
    if hot is not None:
        keys = ["url", "part"]
        parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n_parts"), F.lit(1)) - 1))
        asking = asking.join(hot, "url", "left").select("url", parts.alias("part"))
    return placed.join(asking.hint("merge"), keys, "left_semi")


def next_batch(frontier: DataFrame, n: int) -> DataFrame:
    """The ``n`` URLs to take next: by depth, then arrival (``seq``)."""
    return frontier.orderBy("depth", "seq").limit(n)


def link_log(admitted: DataFrame) -> DataFrame:
    """Admitted URLs as log rows."""
    return admitted.select("url", "depth")
