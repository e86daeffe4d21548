"""HTML as relations: tokens, element spans, containment, links, files, images.

Links, files and images need no nesting and are read inside the page row, so
they cause no shuffle. Nesting is answered with window functions over the token
table. Pages are shuffled once by ``page_id`` before they are split into
tokens; all later windows and groups are keyed by ``page_id`` (plus more), so
they reuse that partitioning. One group is one page, that is, what fitted in
one row before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import urls as U
from ..functions.expr import column, filter_array, let, map_array, quote

# Columns and windows need a session, so they are made when used.


def is_open() -> Column:
    return F.col("kind") == "open"


def is_close() -> Column:
    return F.col("kind") == "close"


def is_text() -> Column:
    return F.col("kind") == "text"


def is_void() -> Column:
    return F.coalesce(F.col("tag").isin(*H.VOID_TAGS), F.lit(False))


def tokenize(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """page_id, pos, kind (open, close, text), tag, raw, text.

    ``raw`` is the tag as written, ``text`` the decoded text. Comments, scripts,
    style sheets and declarations are left out. Columns in ``keep`` are carried
    along.
    """
    exploded = pages.select("page_id", *keep, F.posexplode(H.token_array("html")).alias("pos", "token"))
    token = F.col("token")
    kind = (
        F.when(token.rlike(r"^</[A-Za-z]"), "close")
        .when(token.rlike(r"^<[A-Za-z]"), "open")
        .when(token.rlike(r"(?s)^<[!?].*>$"), "declaration")
        .otherwise("text")
    )
    return (
        exploded.withColumn("kind", kind)
        .where("kind <> 'declaration'")
        .select(
            "page_id", *keep, "pos", "kind",
            F.when(~is_text(), F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s/>]*)", 1))).alias("tag"),
            F.when(~is_text(), token).alias("raw"),
            F.when(is_text(), H.decode_entities("token")).alias("text"),
        )
    )


def page_tokens(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Tokens of pages that were first shuffled by ``page_id``.

    Shuffling whole pages moves far fewer bytes and rows than shuffling their
    tokens for the first window. The number of partitions is fixed, because
    parsing makes much more of a page than its stored size suggests, and
    adaptive merging of small partitions goes by that size.
    """
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tokenize(pages.select("page_id", *keep, "html").repartition(parts, "page_id"), keep)


def _floor_zero(total: Column, low: Column) -> Column:
    """Depth that ignores closing tags without an opening one."""
    return total - F.least(low, F.lit(0))


def with_ends(tokens: DataFrame) -> DataFrame:
    """Add ``tag_level`` (nesting depth among elements of the same tag) and, at
    opening tags, ``end`` (position of the closing tag, NULL if there is none)."""
    per_tag = Window.partitionBy("page_id", "tag").orderBy("pos")
    so_far = per_tag.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.when(is_void(), 0).when(is_open(), 1).when(is_close(), -1).otherwise(0)
    leveled = tokens.withColumn("_s", F.sum(step).over(so_far)).withColumn(
        "tag_level",
        (_floor_zero(F.col("_s"), F.min("_s").over(so_far)) + F.when(is_close() & ~is_void(), 1).otherwise(0)).cast("int"),
    )
    partner = F.lead("pos").over(Window.partitionBy("page_id", "tag", "tag_level").orderBy("pos"))
    return leveled.drop("_s").withColumn("end", F.when(is_open() & ~is_void(), partner))


def spans(tokens: DataFrame) -> DataFrame:
    """Elements as page_id, tag, start, end, level. Void elements have none."""
    return (
        with_ends(tokens.where(~is_text() & ~is_void()))
        .where(is_open())
        .select("page_id", "tag", F.col("pos").alias("start"), "end", F.col("tag_level").alias("level"))
    )


def contained(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """Pairs of inner rows (page_id, pos, …) with all outer elements around them.

    ``outer`` needs page_id, start, end of properly nested elements; an element
    without end reaches to the end of its page. Adds ``outer_start`` and
    ``nearest``. The work is a running depth plus one "last opened at this
    depth" window, so it costs one sort per page plus the size of the result,
    where an interval join would compare all pairs of a page.
    """
    payload = F.struct(*inner.columns)
    marks = outer.select(
        "page_id",
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.col("start").alias("at"), F.lit(1).alias("delta"), F.col("start").alias("start")),
                    F.struct(F.col("end").alias("at"), F.lit(-1).alias("delta"), F.col("start").alias("start")),
                ),
                lambda m: m["at"].isNotNull(),
            )
        ).alias("m"),
    ).select("page_id", "m.*")
    points = inner.select("page_id", F.col("pos").alias("at"), F.lit(0).alias("delta"), payload.alias("payload"))
    events = marks.unionByName(points, allowMissingColumns=True)
    # at equal positions the inner row comes first: an element is not inside itself
    order = [F.col("at"), F.abs("delta")]
    depth = F.sum("delta").over(
        Window.partitionBy("page_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    leveled = events.withColumn("depth", depth.cast("int")).where("delta >= 0 and depth > 0")
    levels = F.when(F.col("delta") == 0, F.sequence(F.lit(1), F.col("depth"))).otherwise(F.array("depth"))
    at_level = leveled.withColumn("level", F.explode(levels))
    opened = F.last(F.when(F.col("delta") == 1, F.col("start")), ignorenulls=True).over(
        Window.partitionBy("page_id", "level").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        at_level.withColumn("outer_start", opened)
        .where("delta = 0")
        .select("payload.*", "outer_start", (F.col("level") == F.col("depth")).alias("nearest"))
    )


# --- row-local extraction -------------------------------------------------
# ``base_domain`` is an expression: a quoted name, or one computed per page.


def _in_scope(target: str, base_domain: str) -> str:
    return let(
        U.url_parts_sql(target),
        lambda p: f"({p}.scheme IN ('http', 'https') AND {U.within_domain_sql(f'{p}.netloc', base_domain)})",
    )


def link_array_sql(html: str, url: str, base_domain: str) -> str:
    """Array of struct(pos, part, target): see :func:`extract_links`."""
    hrefs = filter_array(
        H.link_hrefs_sql(html),
        lambda h: f"NOT startswith({h}, 'mailto:') AND NOT startswith({h}, 'javascript:')"
        f" AND NOT contains(lower({h}), 'download.jsp')",
    )
    # the base is split once per page, not once per link
    base = let(U.link_base_sql(url), lambda b: f"named_struct('url', {b}, 'parts', {U.url_parts_sql(b)})")

    def targets(b: str) -> str:
        split = f"transform({hrefs}, (h, i) -> transform({H.split_whitespace_sql('h')}, (piece, k) -> named_struct('pos', i, 'part', k, 'target', {U.resolve_from_sql(f'{b}.url', f'{b}.parts', 'piece')})))"
        return filter_array(f"flatten({split})", lambda t: _in_scope(f"{t}.target", base_domain))

    return let(base, targets)


def extract_links(pages: DataFrame, base_domain: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """page_id, pos, part, target: links worth following.

    ``mailto:``, ``javascript:`` and download scripts are skipped, an href with
    spaces is several links, targets outside the domain or not on http(s) are
    dropped; order and duplicates are kept. Columns in ``keep`` are carried
    along. The scope test runs inside the page row, so a filter on the target
    does not repeat the work.
    """
    return pages.select(
        "page_id", *keep, F.inline(column(link_array_sql("html", "url", base_domain)))
    )


def file_array(html: str, base: str, base_domain: str) -> Column:
    """Absolute addresses of linked files inside the domain, in page order."""
    # what is neither written in the markup nor made by decoding or taking out is in no link
    possible = quote(f"{H.FILE_HREF}|&|{H.HIDDEN_MARK}")
    hrefs = filter_array(H.link_hrefs_sql(html), lambda h: f"rlike({h}, {quote(H.FILE_HREF)})")
    none = f"IF({html} IS NULL, NULL, cast(array() AS array<string>))"

    def absolute(b: str) -> str:
        targets = map_array(f"IF(rlike({html}, {possible}), {hrefs}, {none})", lambda h: U.resolve_from_sql(base, b, h))
        return filter_array(targets, lambda t: _in_scope(t, base_domain))

    return column(let(U.url_parts_sql(base), absolute))


def extract_files(pages: DataFrame, base_domain: str) -> DataFrame:
    """page_id, pos, target: links to documents, archives and downloads."""
    return pages.select("page_id", F.posexplode(file_array("html", "url", base_domain)).alias("pos", "target"))


def image_array(html: str, base: str) -> Column:
    """Distinct absolute image addresses with an image suffix, sorted."""

    def absolute(b: str) -> str:
        targets = map_array(H.image_sources_sql(html), lambda s: U.resolve_from_sql(base, b, s))
        return filter_array(targets, lambda t: f"rlike({t}, {quote(H.IMAGE_URL)})")

    return column(f"array_sort(array_distinct({let(U.url_parts_sql(base), absolute)}))")


def extract_images(pages: DataFrame) -> DataFrame:
    """page_id, target: the images of each page, once each."""
    return pages.select("page_id", F.explode(image_array("html", "url")).alias("target"))
