"""The walk over a site: from seeds, level by level, through a table of fetched pages."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import grid, visible
from ..functions import urls as U
from ..functions.expr import column
from ..functions.pieces import Cutter
from ..functions.text import normalize_text
from ..functions.urls import Resolver
from ..operators.dedup import unseen
from ..operators.folds import fold
from ..operators.frontier import admit, merge_links
from ..operators.growing import Growing
from ..operators.records import build_records, text_reader
from ..session import materialise

STATE = "url string, depth int, content_key string"


class WalkResult(NamedTuple):
    """What a walk produces.

    ``records``: page_id, depth, fp and the record fields of surviving pages.
    ``visited``: url, depth and content_key of all URLs that were admitted. ``unfetched``:
    those without a page. ``seen``: fp added. ``parsed``: url of the surviving pages.
    """

    records: DataFrame
    visited: DataFrame
    unfetched: DataFrame
    seen: DataFrame
    parsed: DataFrame


def _page_reader() -> Callable[[pa.Array, pa.Array, pa.Array], pa.Array]:
    """Markup, address and domain of pages to their texts and different links."""
    cut, text = Cutter(grid.tag_reader(), grid.NO_TAG), text_reader()

    def read(html: pa.Array, url: pa.Array, base_domain: pa.Array) -> pa.Array:
        texts, links = [], []
        for page, address, domain in zip(html.to_pylist(), url.to_pylist(), base_domain.to_pylist()):
            plain = None if page is None else cut.plain(page)
            texts.append(text(page, plain))
            if page is None:
                links.append(None)
                continue
            tags = cut.other_tags(page) if plain is None else plain
            links.append(visible.links(visible.hrefs(tags), Resolver(U.link_base_of(address)), domain))
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(links, pa.list_(pa.string()))], ["merged_text", "links"])

    return read


def read_once(pages: DataFrame, base_domain: str) -> DataFrame:
    """page_id, url (canonical), merged_text, fp (NULL without text) and links of every
    page: one scan, inside the row, written once."""
    given = pages.select(
        "page_id", U.normalize_url("url").alias("url"), "html", F.col("url").alias("_base"), column(base_domain).cast("string").alias("_domain")
    )
    made = T.StructType.fromDDL("merged_text string, links array<string>")
    read = fold(given, _page_reader, ("html", "_base", "_domain"), "_made", made).select(
        "page_id", "url", "_made.merged_text", "_made.links"
    ).withColumn("_normal", normalize_text("merged_text"))
    return materialise(
        read.select("page_id", "url", "merged_text", F.expr("IF(_normal <> '', sha2(_normal, 256), NULL)").alias("fp"), "links"),
        "walk-pages",
    )


def by_url(facts: DataFrame) -> DataFrame:
    """One page per canonical URL (smallest page_id), dealt out and sorted by URL and kept so.

    The result is persisted: every level joins it where it lies, so only the level moves. It has no
    page bodies. Lost blocks are made again from the written table.
    """
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = facts.select("url", "page_id", "fp", "links").repartition(parts, "url")
    first = F.row_number().over(Window.partitionBy("url").orderBy("page_id"))
    nodes = placed.withColumn("_nth", first).where("_nth = 1").drop("_nth").persist()
    nodes.count()  # Spark knows how a persisted table is dealt out once it is there
    return nodes


def fetch(frontier: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pages of a frontier. Nothing of ``nodes`` is shuffled or sorted again."""
    return frontier.hint("merge").join(nodes, "url")


def run_walk(
    pages: DataFrame,
    seeds: DataFrame,
    base_domain: str,
    rules: DataFrame | None = None,
    max_depth: int | None = None,
    extra: DataFrame | None = None,
    seen: DataFrame | None = None,
    visited: DataFrame | None = None,
    parsed: DataFrame | None = None,
    known_keys: DataFrame | None = None,
) -> WalkResult:
    """Walk from ``seeds`` (url) over ``pages`` (page_id, url, html) until no new link is left.

    A level is the set of URLs admitted together. Its pages are looked up by canonical URL; those
    with blank text or a text seen before (on an earlier level, or on a page of this level with a smaller id) are
    dropped with their links. The links of the others are admitted (:func:`admit`) one hop deeper, and make the next level.
    ``extra`` (url, depth) is a further link list that joins the seeds, see :func:`merge_links`; what it says
    about depth counts. ``seen`` (fp), ``visited`` (url), ``parsed`` (url) and ``known_keys`` (content_key) are the
    state that earlier passes left; it is read, never rewritten.

    Every page is read once, before the loop. The loop moves URLs, keys and fingerprints of the
    current level only; what is known grows by one part per level. Page bodies move once, when the
    records of the surviving pages are made.
    """
    spark = pages.sparkSession
    facts = read_once(pages, base_domain)
    nodes = by_url(facts)
    urls_before = None
    for history in (visited, parsed):
        if history is not None:
            urls_before = history.select("url") if urls_before is None else urls_before.unionByName(history.select("url"))
    known_urls = Growing(spark, "url string", "walk-urls", urls_before)
    keys = Growing(spark, "content_key string", "walk-keys", known_keys)
    texts = Growing(spark, "fp string", "walk-texts", seen)
    reached = Growing(spark, STATE, "walk-visited")
    kept = Growing(spark, "page_id long, url string, depth int, fp string", "walk-kept")

    def admitted(links: DataFrame) -> DataFrame:
        return admit(links, known_urls.rows(), None, rules, max_depth, keys.rows())

    start = admitted(seeds.select("url", F.lit(0).alias("depth")))
    if extra is not None:
        listed = materialise(start, "walk-seeds")
        everything = merge_links(listed, extra, known_urls.rows(), known_urls.empty, max_depth)
        # a listed URL has no content key: it is neither checked against those known nor added to them
        start = everything.join(listed.select("url", "content_key"), "url", "left")
    level = materialise(start, "walk-level")
    while not level.isEmpty():
        for state in (known_urls, reached):
            state.add(level)
        keys.add(level.where("content_key IS NOT NULL"))
        fetched = materialise(fetch(level.select("url", "depth"), nodes), "walk-fetched")
        # (fingerprint, page) only, reduced per task before the shuffle
        winners = fetched.where("fp IS NOT NULL").groupBy("fp").agg(F.min("page_id").alias("page_id"))
        new = unseen(winners, texts.rows(), "fp").select("page_id")
        survivors = materialise(fetched.join(new, "page_id", "left_semi"), "walk-survivors")
        texts.add(survivors)
        kept.add(survivors)
        links = survivors.select(F.explode("links").alias("url"), (F.col("depth") + 1).alias("depth"))
        level = materialise(admitted(links), "walk-level")
    nodes.unpersist()

    found = kept.added()
    # the texts are read again from their column; each side moves once
    bodies = pages.select("page_id", "url", "html").join(found.select("page_id", "depth", "fp"), "page_id").join(
        facts.select("page_id", "merged_text"), "page_id"
    )
    return WalkResult(
        records=build_records(bodies, base_domain, keep=("depth", "fp")),
        visited=reached.added(),
        unfetched=reached.added().join(facts.select("url"), "url", "left_anti"),
        seen=found.select("fp"),
        parsed=found.select("url"),
    )
