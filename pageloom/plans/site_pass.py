"""One pass over fetched pages: records, new links, and the state they add."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..operators.blocks import page_text
from ..operators.dedup import History, unseen_by_all
from ..operators.frontier import admit
from ..operators.markup import extract_links
from ..operators.records import build_records
from ..session import cut_lineage


class PassResult(NamedTuple):
    """What a pass produces.

    ``records``: page_id, depth, fp and the record fields of surviving pages.
    ``frontier``: url, depth, content_key of newly admitted links.
    ``seen``: fp added. ``parsed``: url of the surviving pages. ``fetched``:
    url and content_key of all pages of the pass.
    """

    records: DataFrame
    frontier: DataFrame
    seen: DataFrame
    parsed: DataFrame
    fetched: DataFrame


def run_pass(
    pages: DataFrame,
    base_domain: str,
    seen: History | None = None,
    visited: History | None = None,
    parsed: History | None = None,
    known_keys: History | None = None,
    rules: DataFrame | None = None,
    max_depth: int | None = None,
    small_batch: bool = False,
) -> PassResult:
    """Process pages (page_id, url, html, depth).

    ``base_domain`` is an expression: a quoted name, or one computed per page.

    Cheap work first: text and fingerprint of every page, then only the pages
    that survive deduplication are searched for links, files, images and
    tables. Texts are materialised once in the shared folder, because both the
    deduplication and the records need them and parsing is the costly part.
    A page with blank or repeated text is dropped with its links. A link to a
    page of this pass, or to its content, is not new. ``small_batch`` suits few
    pages against a long history, which may then be given as lookups.
    """
    texts = cut_lineage(
        pages.select("page_id", page_text("html").alias("merged_text"))
        .withColumn("_normal", T.normalize_text("merged_text"))
        .where("_normal <> ''")
        .select("page_id", "merged_text", F.sha2("_normal", 256).alias("fp"))
    )
    # (fingerprint, page) only, reduced per task before the shuffle
    winners = unseen_by_all(texts.groupBy("fp").agg(F.min("page_id").alias("page_id")), [seen], "fp", small_batch)
    kept = cut_lineage(winners.join(texts.select("page_id", "merged_text"), "page_id"))
    surviving = pages.join(kept, "page_id")
    fetched = pages.select(U.normalize_url("url").alias("url")).withColumn("content_key", U.content_key("url"))
    links = extract_links(surviving, base_domain, keep=("depth",)).select(
        F.col("target").alias("url"), (F.col("depth") + 1).alias("depth")
    )
    frontier = admit(
        links,
        [fetched, visited],
        parsed,
        rules,
        max_depth,
        [fetched, known_keys],
        small_batch,
    )
    return PassResult(
        records=build_records(surviving, base_domain, keep=("depth", "fp")),
        frontier=frontier,
        seen=kept.select("fp"),
        parsed=surviving.select(U.normalize_url("url").alias("url")),
        fetched=fetched,
    )
