"""Registered queries: one per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions import urls as U
from ..operators import blocks, dedup, fetchlog, frontier, markup, notices, records, rules, tables
from ..operators import text as text_ops
from ..operators import urls as url_ops
from ..session import scratch_dir
from ..sources import jsonl, pages as page_source, state
from ..streaming import queries as streams
from ..streaming.feed import Feed, stream_feed
from ..streaming.state import BatchStore
from . import inputs as I
from .site_pass import run_pass
from .site_walk import run_walk

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _digest(*cols: str):
    """md5 over long or nested values, so results stay small to compare."""
    return F.md5(F.concat_ws("|", *cols))


def _list(col: str):
    return F.array_join(col, "|")


# --- S: sources and sinks ---------------------------------------------------

RECORD_FIELDS = "url string, merged_text string, images array<string>, files array<string>"


@query
def page_source_(spark, sf):
    return page_source.read_pages(spark, f"{sf}/pages.parquet", depth=0).select(
        "page_id", "url", "depth", F.md5("html").alias("html_md5")
    )


@query
def jsonl_source(spark, sf):
    path = scratch_dir(spark, "jsonl")
    # a blank line after every record
    I.document_records(spark, sf).select(F.concat(F.to_json(F.struct("*")), F.lit("\n"))).write.text(path)
    return jsonl.read_jsonl(spark, path, RECORD_FIELDS).select("url", "merged_text", F.size("images").alias("n_images"))


@query
def jsonl_append(spark, sf):
    path = scratch_dir(spark, "append")
    docs = I.document_records(spark, sf)
    english = F.col("merged_text").contains(" the ")
    jsonl.append_jsonl(docs.where(english), path)
    jsonl.append_jsonl(docs.where(~english), path)
    # the NULL field must be absent from the text
    lines = spark.read.text(path).where(F.col("value").contains('"tables"')).select(F.lit("tables").alias("url"), "value")
    back = jsonl.read_jsonl(spark, path, RECORD_FIELDS).select("url", F.col("merged_text").alias("value"))
    return back.unionByName(lines)


@query
def size_bounded_write(spark, sf):
    path = scratch_dir(spark, "bounded")
    jsonl.write_bounded(I.document_records(spark, sf), path, target_bytes=1 << 20)
    return jsonl.read_jsonl(spark, path, RECORD_FIELDS).select("url", "merged_text")


@query
def bounded_file_sizes(spark, sf):
    """Records written, and files above the bound that hold more than one record: there must be none."""
    path, bound = scratch_dir(spark, "bounded"), 1 << 16
    jsonl.write_bounded(I.document_records(spark, sf), path, target_bytes=bound)
    too_large = (F.col("n_bytes") > bound) & (F.col("n_records") > 1)
    return jsonl.file_sizes(spark, path).agg(F.sum("n_records").alias("n_records"), F.count_if(too_large).alias("n_too_large"))


@query
def year_partitioned_notices(spark, sf):
    path = scratch_dir(spark, "years")
    jsonl.write_by_year(I.articles(spark, sf), path)
    return jsonl.read_by_year(spark, path, "article_no string, url string, category string").select("article_no", "url", "category", "notice_year")


def _write_state_files(spark, sf) -> str:
    """State files in the foreign format, one object for every 100 pages."""
    path = scratch_dir(spark, "state")
    page = I.pages_with_depth(spark, sf).withColumn("norm", U.normalize_url("url"))
    depth = F.col("depth").cast("string")
    files = page.groupBy(F.floor(F.col("page_id") / 100).alias("file")).agg(
        F.collect_list(F.array("url", depth)).alias("fetching_queue"),
        F.collect_list(F.array("url", F.base64(F.encode("html", "UTF-8")), depth)).alias("parsing_queue"),
        F.collect_list("norm").alias("visited"),
        F.collect_list("url").alias("parsed"),
        F.collect_list(F.sha2("html", 256)).alias("seen_texts"),
        F.collect_list(U.content_key("norm")).alias("visited_identifiers"),
    )
    files.select("file", F.to_json(F.struct(*[c for c in files.columns if c != "file"])).alias("value")).write.partitionBy(
        "file"
    ).text(path)
    return f"{path}/*/*.txt"


def _state_rows(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        tables["frontier"].select(F.lit("frontier").alias("state"), F.col("url").alias("item"), F.col("depth").cast("string").alias("detail")),
        tables["pending_pages"].select(F.lit("pending_pages"), "url", F.md5("html")),
        tables["visited"].select(F.lit("visited"), "url", F.lit("")),
        tables["parsed"].select(F.lit("parsed"), "url", F.lit("")),
        tables["seen"].select(F.lit("seen"), "fp", F.lit("")),
        tables["identities"].select(F.lit("identities"), "content_key", F.lit("")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@query
def crawl_state_tables(spark, sf):
    return _state_rows(state.read_state(spark, _write_state_files(spark, sf)))


@query
def crawl_state_snapshot(spark, sf):
    path = scratch_dir(spark, "snapshots")
    page = I.pages_with_depth(spark, sf).withColumn("norm", U.normalize_url("url"))
    made = {
        "frontier": page.select("url", "depth", F.col("page_id").cast("int").alias("seq")),
        "pending_pages": page.select("url", "html", "depth", F.col("page_id").cast("int").alias("seq")),
        "visited": page.select(F.col("norm").alias("url")).distinct(),
        "parsed": page.select("url"),
        "seen": page.select(F.sha2("html", 256).alias("fp")).distinct(),
        "identities": page.select(U.content_key("norm").alias("content_key")).distinct(),
    }
    state.write_state({**made, "frontier": made["frontier"].where("depth = 0")}, path, 1)
    state.write_state(made, path, 2)
    return _state_rows(state.read_snapshot(spark, path))


def _landing(spark, sf, name: str, by: str, parts: int = 3) -> tuple[str, list[DataFrame]]:
    """The whole table in parts that arrive one after the other, by key range: see :func:`_first_landed`."""
    source = I.table(spark, sf, name)
    low, high = source.agg(F.min(by), F.max(by)).first()
    width = (high - low) // parts + 1
    ranges = [F.col(by).between(low + k * width, low + (k + 1) * width - 1) for k in range(parts)]
    return _first_landed([source.where(r) for r in ranges], name)


def _first_landed(parts: list[DataFrame], name: str) -> tuple[str, list[DataFrame]]:
    """A folder that holds the first part, and the parts to come. A part has as many files as it has tasks."""
    path = scratch_dir(parts[0].sparkSession, f"landing-{name}")
    parts[0].write.parquet(path)
    return path, parts[1:]


def _arrive(landing: str, to_come: list[DataFrame], writer) -> None:
    """Run a stream after each part, so that every part is one batch, however many files it has."""
    checkpoint = f"{landing}-checkpoint"
    streams.resume(writer, checkpoint)
    for part in to_come:
        part.write.mode("append").parquet(landing)
        streams.resume(writer, checkpoint)


def _run_stream(landing: str, to_come: list[DataFrame], sdf, name: str) -> DataFrame:
    out = scratch_dir(sdf.sparkSession, f"{name}-out")
    _arrive(landing, to_come, sdf.writeStream.format("parquet").option("path", out))
    return sdf.sparkSession.read.schema(sdf.schema).parquet(out)


@query
def page_stream_source(spark, sf):
    landing, to_come = _landing(spark, sf, "pages", "page_id")
    sdf = page_source.stream_pages(spark, landing)
    return _run_stream(landing, to_come, sdf.select("page_id", "url", F.md5("html").alias("html_md5")), "pages")


# --- U: URL columns ----------------------------------------------------------


@query
def url_parts(spark, sf):
    return url_ops.split_url(I.web_urls(spark, sf))


@query
def normalize_url(spark, sf):
    return I.web_urls(spark, sf).withColumn("normalized", U.normalize_url("url"))


@query
def url_query_params(spark, sf):
    return url_ops.query_params(I.web_urls(spark, sf))


@query
def content_key(spark, sf):
    return I.web_urls(spark, sf).select("url", U.content_key(U.normalize_url_sql("url")).alias("content_key"))


def _hrefs(spark, sf) -> DataFrame:
    return I.spread_table(spark, sf, "orders").selectExpr("o_orderkey", f"{I.ORDER_BASE} AS base", f"{I.ORDER_HREF} AS href")


@query
def absolute_urls(spark, sf):
    urls = I.web_urls(spark, sf).unionByName(_hrefs(spark, sf).select(F.col("href").alias("url")))
    return url_ops.absolute_only(urls)


@query
def in_domain(spark, sf):
    return url_ops.in_domain(I.web_urls(spark, sf), "url", "'example.com'")


@query
def http_only(spark, sf):
    urls = I.web_urls(spark, sf).unionByName(
        I.table(spark, sf, "orders").selectExpr(
            "CASE o_orderstatus WHEN 'F' THEN 'ftp://h/' WHEN 'O' THEN 'mailto:' ELSE 'https:' END "
            "|| cast(o_orderkey as string) AS url"
        )
    )
    return url_ops.http_only(urls)


@query
def exclude_by_rules(spark, sf):
    return rules.exclude_urls(
        I.web_urls(spark, sf).select(U.normalize_url("url").alias("url")), "url", I.rules(spark)
    )


@query
def exclude_by_many_rules(spark, sf):
    """As many rules as a seventh of the orders and a fifth of the pages."""
    return rules.exclude_urls(I.web_urls(spark, sf).select(U.normalize_url("url").alias("url")), "url", I.many_rules(spark, sf))


@query
def resolve_links(spark, sf):
    return url_ops.resolve(_hrefs(spark, sf), "base", "href")


@query
def link_base(spark, sf):
    return I.web_urls(spark, sf).withColumn("base", U.link_base("url"))


# --- X: HTML to relations ------------------------------------------------------


@query
def html_tokens(spark, sf):
    return markup.tokenize(I.spread_table(spark, sf, "pages"))


@query
def element_spans(spark, sf):
    return markup.spans(markup.page_tokens(I.spread_table(spark, sf, "pages")))


@query
def contained_elements(spark, sf):
    tokens = markup.page_tokens(I.spread_table(spark, sf, "pages"))
    outer = markup.spans(tokens).where("tag IN ('nav', 'ul', 'li', 'article') AND end IS NOT NULL")
    inner = tokens.where("kind = 'open' AND tag IN ('a', 'li', 'p', 'h1')").select("page_id", "pos", "tag")
    return markup.contained(outer, inner)


@query
def page_links(spark, sf):
    return markup.extract_links(I.spread_table(spark, sf, "pages"), "'example.com'").select("page_id", "pos", "target")


@query
def page_files(spark, sf):
    return markup.extract_files(I.order_pages(spark, sf), "'example.com'")


@query
def page_images(spark, sf):
    return markup.extract_images(I.order_pages(spark, sf))


@query
def table_cells(spark, sf):
    return tables.table_cells(I.table_pages(spark, sf)).select(
        "page_id", "table_no", "cell_no", "row", "col", "colspan", "rowspan", "text"
    )


@query
def table_cell_links(spark, sf):
    return tables.cell_links(tables.table_cells(I.table_pages(spark, sf)))


@query
def table_cell_images(spark, sf):
    return tables.cell_images(tables.table_cells(I.table_pages(spark, sf)))


@query
def page_text_blocks(spark, sf):
    return blocks.text_blocks(I.spread_table(spark, sf, "pages"))


@query
def page_records(spark, sf):
    """Both kinds of rendered pages; nested values as counts and joined text."""
    pages = I.order_pages(spark, sf).select((-1 - F.col("page_id")).alias("page_id"), "url", "html").unionByName(
        I.table_pages(spark, sf)
    )
    made = records.build_records(pages, "'example.com'")
    return made.select(
        "page_id", "url", "merged_text", _list("images").alias("images"), _list("files").alias("files"),
        F.size("tables").alias("n_tables"),
        F.coalesce(
            F.aggregate("tables", F.lit(0), lambda acc, t: acc + F.size(t["table"])), F.lit(0)
        ).alias("n_cells"),
    )


# --- T: text columns ------------------------------------------------------------


def _documents(spark, sf) -> DataFrame:
    return I.spread_table(spark, sf, "documents", "doc_id", "text")


@query
def clean_text(spark, sf):
    return _documents(spark, sf).select("doc_id", TX.clean_text("text").alias("clean"))


@query
def normalize_text(spark, sf):
    return _documents(spark, sf).select("doc_id", TX.normalize_text("text").alias("normal"))


@query
def text_fingerprint(spark, sf):
    return _documents(spark, sf).select("doc_id", TX.text_fingerprint("text").alias("fp"))


@query
def word_shingles(spark, sf):
    return _documents(spark, sf).withColumn("s", TX.word_shingles("text")).select(
        "doc_id", F.size("s").cast("bigint").alias("n_shingles"), F.md5(_list("s")).alias("shingles_md5")
    )


@query
def stitch_extracts(spark, sf):
    return text_ops.stitch(I.two_extracts(spark, sf), "a", "b").select("doc_id", "merged_text")


@query
def lead_in_text(spark, sf):
    return text_ops.lead_in(I.two_extracts(spark, sf), "a", "b").select("doc_id", "lead_in")


# --- D: deduplication, admission, link graph --------------------------------------


@query
def nonempty_records(spark, sf):
    return dedup.nonempty(_documents(spark, sf), "text").select("doc_id")


@query
def dedup_by_text(spark, sf):
    return dedup.dedup_text(_documents(spark, sf), "text", "doc_id").select("doc_id", "fp")


@query
def dedup_against_history(spark, sf):
    docs = I.spread_table(spark, sf, "documents", "doc_id", "text", "source")
    seen = docs.where("source IN ('src1', 'src2', 'src3')").select(TX.text_fingerprint("text").alias("fp")).distinct()
    kept, new_seen = dedup.dedup_history(docs.where("source NOT IN ('src1', 'src2', 'src3')"), seen, "text", "doc_id")
    return kept.select("doc_id", "fp")


def _candidates(spark, sf) -> DataFrame:
    pages = I.pages_with_depth(spark, sf)
    links = markup.extract_links(pages, U.netloc_sql("url"), keep=("depth",)).select(
        F.col("target").alias("url"), (F.col("depth") + 1).alias("depth")
    )
    return pages.select("url", "depth").unionByName(links)


def _history(spark, sf) -> tuple[DataFrame, DataFrame]:
    urls = I.spread_table(spark, sf, "pages").select("url", U.normalize_url("url").alias("norm"))
    return (
        urls.where("url LIKE 'http://%'").select(F.col("norm").alias("url")),
        urls.where("url LIKE '%.html'").select(F.col("norm").alias("url")),
    )


def _admitted(spark, sf) -> DataFrame:
    visited, parsed = _history(spark, sf)
    return frontier.admit(_candidates(spark, sf), visited, parsed, I.rules(spark), max_depth=2)


@query
def admit_urls(spark, sf):
    return _admitted(spark, sf)


@query
def merge_extra_links(spark, sf):
    visited, parsed = _history(spark, sf)
    extra = I.web_urls(spark, sf).select("url", F.lit(None).cast("int").alias("depth")).unionByName(
        I.spread_table(spark, sf, "pages").select("url", F.lit(5).alias("depth"))
    )
    waiting = I.pages_with_depth(spark, sf).where("url LIKE '%#top'").select(U.normalize_url("url").alias("url"), "depth")
    return frontier.merge_links(waiting, extra, visited, parsed, max_depth=4)


@query
def link_depths(spark, sf):
    graph = I.edges(spark, sf)
    return frontier.link_depths(graph, graph.agg(F.min("src").alias("url")))


@query
def depth_filter(spark, sf):
    return frontier.depth_at_most(I.pages_with_depth(spark, sf), 2).select("page_id", "url", "depth")


@query
def next_batch(spark, sf):
    pending = I.pages_with_depth(spark, sf).select("url", "depth", F.col("page_id").alias("seq"))
    return frontier.next_batch(pending, 100)


@query
def link_log(spark, sf):
    path = scratch_dir(spark, "links")
    jsonl.append_jsonl(frontier.link_log(_admitted(spark, sf)), path)
    return jsonl.read_jsonl(spark, path, "url string, depth int")


@query
def site_pass(spark, sf):
    """Flagship: records and new links of one pass, as (kind, url, depth, key)."""
    result = run_pass(I.pages_with_depth(spark, sf), U.netloc_sql("url"), rules=I.rules(spark), max_depth=3)
    return result.records.select(F.lit("record").alias("kind"), "url", "depth", F.col("fp").alias("key")).unionByName(
        result.frontier.select(F.lit("link").alias("kind"), "url", "depth", F.col("content_key").alias("key"))
    )


@query
def site_walk(spark, sf):
    """Records and unfetched links of a walk from seeds to where no link is new, as (kind, url, depth, merged_text)."""
    result = run_walk(I.site_pages(spark, sf), I.site_seeds(spark), "'shop.example.com'", rules=I.walk_rules(spark))
    return result.records.select(F.lit("record").alias("kind"), "url", "depth", "merged_text").unionByName(
        result.unfetched.select(F.lit("link").alias("kind"), "url", "depth", F.lit(None).cast("string").alias("merged_text"))
    )


# --- N: notices ----------------------------------------------------------------------


@query
def notice_fields(spark, sf):
    return notices.notice_fields(I.notice_pages(spark, sf))


@query
def notice_records(spark, sf):
    made = notices.notice_records(I.notice_pages(spark, sf), I.BOARD_URL)
    return made.select(
        "page_id", "url", "merged_text", _list("images").alias("images"), _list("files").alias("files"),
        F.size("tables").alias("n_tables"),
        F.array_join(F.transform(F.flatten(F.transform("tables", lambda t: t["table"])), lambda c: c["text"]), "|").alias("cells"),
        "category", "title", "notice_date", "notice_year", "article_no",
    )


@query
def article_no(spark, sf):
    return I.web_urls(spark, sf).withColumn("article_no", notices.article_no("url"))


@query
def feed_high_water(spark, sf):
    return notices.high_water(I.articles(spark, sf))


@query
def new_notices(spark, sf):
    # numbers with a letter behind them are no numbers
    candidates = I.articles(spark, sf).withColumn(
        "article_no", F.when(F.col("category") == "5-LOW", F.concat("article_no", F.lit("a"))).otherwise(F.col("article_no"))
    )
    return notices.new_notices(candidates, I.mid_mark(spark, sf)).select("article_no", "url")


@query
def next_notice_link(spark, sf):
    return notices.next_link(I.notice_pages(spark, sf), I.BOARD_URL)


@query
def notice_chain(spark, sf):
    orders = I.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    links = orders.select(
        I.notice_url(key.cast("string")).alias("url"),
        F.when(~F.expr(I.ENDS_CHAIN), I.notice_url((key + 1).cast("string"))).alias("next_url"),
    )
    starts = links.select("url").join(links.select(F.col("next_url").alias("url")), "url", "left_anti")
    return notices.walk_chain(links, starts)


# --- R: streaming ------------------------------------------------------------------------


@query
def stream_dedup_text(spark, sf):
    landing, to_come = _landing(spark, sf, "documents", "doc_id")
    sdf = page_source.stream_pages(spark, landing, I.table(spark, sf, "documents").schema)
    return _run_stream(landing, to_come, streams.stream_dedup(sdf, "text").select("fp"), "dedup")


@query
def stream_new_notices(spark, sf):
    landing, to_come = _landing(spark, sf, "orders", "o_orderkey")
    sdf = page_source.stream_pages(spark, landing, I.table(spark, sf, "orders").schema).select(
        F.col("o_orderkey").cast("string").alias("article_no"), I.notice_url(F.col("o_orderkey").cast("string")).alias("url")
    )
    path = scratch_dir(spark, "new-notices")
    _arrive(landing, to_come, streams.stream_new_notices(sdf, path, I.mid_mark(spark, sf)))
    store = BatchStore(spark, path)
    marks = spark.createDataFrame([(store.note[0], "mark")], "article_no string, kind string")
    return store.read("notices", sdf.schema).select("article_no", F.lit("notice").alias("kind")).unionByName(marks)


@query
def notice_feed(spark, sf):
    """Every notice of a chain that arrives in three parts, from the year files and the typed records, and the last mark."""
    parts, first = I.feed_parts(spark, sf)
    landing, to_come = _first_landed(parts, "feed")
    sdf = page_source.stream_pages(spark, landing)
    path = scratch_dir(spark, "feed")
    _arrive(landing, to_come, stream_feed(sdf, path, I.BOARD_URL, first))
    feed = Feed(spark, path)
    records = feed.records().select("url", "notice_year", "merged_text", "article_no", F.lit("record").alias("kind"))
    lines = feed.files().select("url", "notice_year", "merged_text", F.lit(None).cast("long").alias("article_no"), F.lit("line").alias("kind"))
    mark = spark.createDataFrame(
        [(feed.mark()["last_page_url"], None, None, int(feed.mark()["last_article_no"]), "mark")], records.schema
    )
    return records.unionByName(lines).unionByName(mark)


@query
def stream_site_pass(spark, sf):
    landing, to_come = _landing(spark, sf, "pages", "page_id")
    sdf = page_source.stream_pages(spark, landing).withColumn("depth", F.expr(I.PAGE_DEPTH))
    path = scratch_dir(spark, "site-pass")
    writer = streams.stream_pass(sdf, path, U.netloc_sql("url"), rules=I.rules(spark), max_depth=3, buckets=16)
    _arrive(landing, to_come, writer)
    store = BatchStore(spark, path)
    return store.read("records", "url string, fp string").select(
        F.lit("record").alias("kind"), "url", F.col("fp").alias("key")
    ).unionByName(
        store.read("frontier", streams.FRONTIER_SCHEMA).select(F.lit("link").alias("kind"), "url", F.col("content_key").alias("key"))
    )


@query
def stream_resume(spark, sf):
    """Two runs on one checkpoint; the second sees only what came later."""
    landing = scratch_dir(spark, "landing")
    docs = I.table(spark, sf, "documents")
    out, checkpoint = scratch_dir(spark, "resume-out"), scratch_dir(spark, "checkpoint")
    for part in (docs.where("lang = 'en'"), docs.where("lang <> 'en' OR lang IS NULL")):
        part.write.mode("append").parquet(landing)
        sdf = page_source.stream_pages(spark, landing, docs.schema).select("doc_id", F.md5("text").alias("text_md5"))
        streams.resume(sdf.writeStream.format("parquet").option("path", out), checkpoint)
    return spark.read.parquet(out)


# --- G: fetch log -----------------------------------------------------------------------------


@query
def admit_responses(spark, sf):
    labeled = fetchlog.label_responses(I.fetch_log(spark, sf)).select("event_id", "url", "outcome")
    admitted = fetchlog.admit_responses(I.fetch_log(spark, sf)).select("event_id", "url", F.lit("admitted").alias("outcome"))
    return labeled.where("outcome <> 'ok'").unionByName(admitted)


@query
def fetch_outcomes(spark, sf):
    return fetchlog.fetch_outcomes(I.fetch_log(spark, sf), order_by=("ts", "event_id"))


@query
def pass_progress(spark, sf):
    state_rows = I.table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("pass"), F.expr(I.EVENT_STATE).alias("state")
    )
    return fetchlog.progress(state_rows)


@query
def activity_sessions(spark, sf):
    events = I.table(spark, sf, "events")
    per_user = fetchlog.sessions(events, "ts", "user_id")
    overall = fetchlog.sessions(events, "ts").withColumn("user_id", F.lit(-1).cast("long"))
    return per_user.unionByName(overall).select(
        "user_id", "session_no", fetchlog.micros("started", True).alias("started_us"), fetchlog.micros("ended", True).alias("ended_us"), "n_rows"
    )


QUERIES["page_source"] = QUERIES.pop("page_source_")
