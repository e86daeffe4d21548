"""Inputs of the registered queries, derived from the given tables.

The page table has no images, files, tables or notices, so those pages are
rendered from order rows: one page per order, one table row per line item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import normalize_url
from ..session import spread

# SQL expressions that mean the same in Spark and in the checking engine.
ORDER_URL = (
    "'HTTP://WWW.' || o_orderstatus || '.Orders.example.com:8080/Sc/' || o_orderpriority || '//view.jsp/;v=' || "
    "o_orderstatus || '?lang=en&q=' || replace(o_orderpriority, ' ', '+') || '%26x&b=&article_no=' || "
    "cast(o_orderkey as string) || '&mid=n' || cast(o_custkey as string) || '&a=50%25%&idx#top'"
)
ORDER_HREF = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN '../a/./' || cast(o_orderkey as string) || '?x=1#f' "
    "WHEN '2-HIGH' THEN '/b//' || cast(o_orderkey as string) WHEN '3-MEDIUM' THEN '?p=' || cast(o_orderkey as string) "
    "WHEN '4-NOT SPECIFIED' THEN '//other.example.org/' || cast(o_orderkey as string) || '/..' "
    "ELSE 'c/../../' || cast(o_orderkey as string) || '/' END"
)
ORDER_BASE = "'https://www.shop.example.com/s/' || o_orderstatus || '/v.jsp?id=1'"
PAGE_DEPTH = "CASE WHEN url LIKE '%ref=x%' THEN 3 ELSE 0 END"
ENDS_CHAIN = "(o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')"
EVENT_STATUS = "CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 404 WHEN 'click' THEN NULL ELSE 200 END"
EVENT_TYPE = "CASE event_type WHEN 'purchase' THEN 'application/pdf' ELSE 'Text/HTML; charset=utf-8' END"
EVENT_STATE = (
    "CASE event_type WHEN 'view' THEN 'visited' WHEN 'click' THEN 'pending' WHEN 'signup' THEN 'new' "
    "WHEN 'purchase' THEN 'parsed' ELSE 'seen' END"
)
EXTRACT_A = (
    "CASE lang WHEN 'fr' THEN upper(text) WHEN 'es' THEN regexp_extract(text, '^[^\\n]*', 0) "
    "ELSE regexp_replace(text, '^[^\\n]*\\n', '') END"
)
CUSTOMER_TEXT = (
    "CASE WHEN c_custkey % 5 = 0 THEN 'This customer page is under construction and will be filled with content some time soon' "
    "ELSE 'Customer ' || cast(c_custkey as string) || ' of nation ' || cast(c_nationkey as string) || ' belongs to the market segment ' || "
    "c_mktsegment || ' and has placed some orders here' END"
)
ORDER_TEXT = (
    "CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '5-LOW' THEN 'An order of low priority by customer ' || "
    "cast(o_custkey as string) || ' whose details are to be had from our service staff' "
    "ELSE 'Order ' || cast(o_orderkey as string) || ' was placed by customer ' || cast(o_custkey as string) || "
    "' and has been handled by our staff with due care' END"
)
BOARD_URL = "https://www.board.example.com/sc/notice.jsp"
RULES = [
    ("url", None, "https://spam-farm.example.org/"),
    ("path", None, "/the"),
    ("param", "page", "2"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table, with work for all cores even if it is one file."""
    return spread(table(spark, sf_dir, name).select(*(columns or ["*"])))


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "kind string, param string, value string")


def many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule for every seventh order and every fifth page; rules of orders also hit longer numbers that begin alike."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 7 = 3").selectExpr(
        "'param' AS kind", "'article_no' AS param", "cast(o_orderkey AS string) AS value"
    )
    pages = table(spark, sf_dir, "pages").where("page_id % 5 = 0").select(
        F.lit("url").alias("kind"), F.lit(None).cast("string").alias("param"), normalize_url("url").alias("value")
    )
    return orders.unionByName(pages)


def web_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url: the page addresses and one address with odd parts per order."""
    orders = table(spark, sf_dir, "orders").selectExpr(f"{ORDER_URL} AS url")
    return spread(table(spark, sf_dir, "pages").select("url")).unionByName(spread(orders))


def pages_with_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_table(spark, sf_dir, "pages").withColumn("depth", F.expr(PAGE_DEPTH))


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order: links to files, and images in several notations."""
    key = F.col("o_orderkey").cast("string")
    html = F.format_string(
        '<html><body><p>Order %1$s</p><a href="doc/%1$s.PDF">a</a> <a href=\'/Download?id=%1$s&amp;s=%2$s\'>b</a>'
        '<a href="http://other.example.org/%1$s.zip">c</a><a href="/plain/%1$s">d</a>'
        '<!-- <a href="hidden.pdf">x</a> --><img src="/i/%1$s.jpg"><img data-src="i/%1$s.PNG" src="">'
        '<img data-original=../o/%1$s.gif><img src="/i/%1$s.jpg"><img src="/v/%1$s.png?v=1"><img alt="none"></body></html>',
        key, F.col("o_orderstatus"),
    )
    return spread_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").select(
        F.col("o_orderkey").alias("page_id"),
        F.concat(F.lit("https://www.shop.example.com/s/"), "o_orderstatus", F.lit("/v.jsp?id="), key).alias("url"),
        html.alias("html"),
    )


def table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order with tables made of its line items: a plain
    one with links and images, one whose first cell spans all rows, and on
    longer orders one with a table inside a cell."""
    item = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("l_quantity")
    )
    # a fixed number of parts: the grouped rows are small, the pages made of them are not
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = (
        table(spark, sf_dir, "lineitem")
        .repartition(parts, "l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
    )
    plain = F.transform(
        "items",
        lambda i: F.format_string(
            '<tr><td><img src="/f/%1$s.PNG"></td>\n<td>Part &amp; <b>%1$s</b>\n <a href="part/%1$s">part  %1$s</a></td>'
            "<td>%2$s</td></tr>",
            i["l_partkey"].cast("string"), i["l_quantity"].cast("string"),
        ),
    )
    spanned = F.transform(
        "items",
        lambda i, n: F.concat(
            F.lit("<tr>"),
            F.when(n == 0, F.concat(F.lit('<td rowspan="'), F.size("items").cast("string"), F.lit('">all</td>'))).otherwise(""),
            F.lit("<td>"), i["l_suppkey"].cast("string"), F.lit("</td></tr>"),
        ),
    )
    key = F.col("l_orderkey").cast("string")
    html = F.concat(
        F.lit("<html><body><h1>Order "), key, F.lit('</h1><table><tr><th colspan="2">Order '), key,
        F.lit("</th><th>Quantity</th></tr>"), F.array_join(plain, ""), F.lit("</table><TABLE>"),
        F.array_join(spanned, ""), F.lit("</TABLE>"),
        # more than seven items: a table with another one in a cell
        F.when(F.size("items") > 7, F.concat(
            F.lit("<table><tr><td>outer <table><tr><td>inner "), key,
            F.lit("</td></tr></table></td><td>end</td></tr></table>"),
        )).otherwise(""),
        F.lit("</body></html>"),
    )
    return orders.select(
        F.col("l_orderkey").alias("page_id"),
        F.concat(F.lit("https://www.shop.example.com/o/"), key, F.lit("/view.jsp?lang=en")).alias("url"),
        html.alias("html"),
    )


def notice_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One notice per order; the next notice is the next order number, and
    some orders end their chain."""
    return _rendered_notices(spread_table(spark, sf_dir, "orders"), F.expr(ENDS_CHAIN))


def feed_parts(spark: SparkSession, sf_dir: str, parts: int = 3) -> tuple[list[DataFrame], str]:
    """Notices of all orders as pages that arrive in parts by key range, and the address of the first one.

    The last page of a part has no following notice yet; it is there again in the next part, now with its link.
    """
    orders = table(spark, sf_dir, "orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    width = (high - low) // parts + 1
    made = []
    for k in range(parts):
        first, last = low + k * width, min(low + (k + 1) * width - 1, high)
        part = orders.where(F.col("o_orderkey").between(max(first - 1, low), last))
        made.append(_rendered_notices(spread(part), F.col("o_orderkey") == last))
    return made, f"{BOARD_URL}?mode=view&article_no={low}"


def _rendered_notices(orders: DataFrame, ends_chain) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    next_href = F.when(ends_chain, F.lit("javascript:alert('last')")).otherwise(
        F.concat(F.lit("?mode=view&amp;article_no="), (F.col("o_orderkey") + 1).cast("string"))
    )
    html = F.format_string(
        '<html><body><div id="jwxe_main_content"><div class="jwxe_board x"><div><div class="title_area">'
        '<span class="title"> %2$s </span></div><dl class="board_view"><dt><strong>\n Order %1$s &amp; <i>more</i> </strong>'
        '</dt></dl><span class="info date"> %3$s </span><a href="files/%1$s.hwp">f</a>'
        '<div class="fr-view"><p> First %1$s </p><div>By <b>%4$s</b><img src="/i/%1$s.png"></div><p> </p>'
        "<table><tr><td>customer</td><td>%4$s</td></tr></table>"
        '<p><img src="http://cdn.example.com/%1$s.gif"><br>end</p><img src="tail/%1$s.jpg"><span>ignored<img src="no.png"></span></div>'
        '<ul><li><a href="%5$s">next</a></li><li><a href="?article_no=0">first</a></li></ul></div></div></div></body></html>',
        key, F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy.M.d"), F.col("o_custkey").cast("string"), next_href,
    )
    return orders.select(
        F.col("o_orderkey").alias("page_id"), notice_url(key).alias("url"), html.alias("html")
    )


def notice_url(key):
    return F.concat(F.lit(BOARD_URL + "?mode=view&article_no="), key)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """article_no (text), url, notice_year, category of every order."""
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        key.alias("article_no"), notice_url(key).alias("url"),
        F.year("o_orderdate").alias("notice_year"), F.col("o_orderpriority").alias("category"),
    )


def mid_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A high-water mark in the middle of the order numbers."""
    return table(spark, sf_dir, "orders").agg(
        F.floor(F.avg("o_orderkey")).cast("string").alias("last_article_no"), F.lit("").alias("last_page_url")
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between orders and the parts in them, in both directions."""
    pair = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("o/"), F.col("l_orderkey").cast("string")).alias("a"),
        F.concat(F.lit("p/"), F.col("l_partkey").cast("string")).alias("b"),
    )
    both = F.explode(
        F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
                F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))
    )
    return pair.select(both.alias("e")).select("e.*")


def two_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, a, b: the whole text, and a second extract of it."""
    return spread_table(spark, sf_dir, "documents", "doc_id", "text", "lang").select(
        "doc_id", F.expr(EXTRACT_A.replace("\\n", "\\\\n")).alias("a"), F.col("text").alias("b")
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attempt per event; the user stands for the URL."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("https://h/"), F.col("user_id").cast("string")).alias("url"),
        "ts", "event_id",
        F.expr(EVENT_STATUS).alias("status"),
        F.expr(EVENT_TYPE).alias("content_type"),
        F.col("value").cast("decimal(12,2)").alias("elapsed"),
    )


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as page records without images, files and tables."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("https://docs.example.com/d/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("merged_text"),
        F.array().cast("array<string>").alias("images"),
        F.array().cast("array<string>").alias("files"),
        F.lit(None).cast("string").alias("tables"),
    )


SHOP = "https://www.shop.example.com"
WALK_RULES = [("path", None, "/private")]


def walk_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WALK_RULES, "kind string, param string, value string")


def site_seeds(spark: SparkSession) -> DataFrame:
    return spark.range(1, 10).select(F.concat(F.lit(f"{SHOP}/c/"), F.col("id").cast("string"), F.lit("#top")).alias("url"))


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site with one page per customer and per order.

    Customer k links to customers 10k to 10k + 9, to its orders, and to a page that the rules forbid; an order
    links back to its customer and to a page that was never fetched. Some customers share one text, as do a
    customer's orders of low priority; some orders have no text.
    """
    customer, order = F.col("c_custkey").cast("string"), F.col("o_orderkey").cast("string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    anchors = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.array_join(F.sort_array(F.collect_list(F.concat(F.lit('<a href="/o/'), order, F.lit('#top">order</a> ')))), "").alias("anchors")
    )
    children = F.array_join(
        F.transform(
            F.sequence(F.col("c_custkey") * 10, F.col("c_custkey") * 10 + 9),
            lambda k: F.concat(F.lit('<li><a href="../c/'), k.cast("string"), F.lit('">next</a></li>')),
        ),
        "",
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").join(anchors, "c_custkey", "left").select(
        (F.col("c_custkey") * 2).alias("page_id"),
        F.concat(F.lit(f"{SHOP}/c/"), customer).alias("url"),
        F.concat(
            F.lit("<html><body><p>"), F.expr(CUSTOMER_TEXT), F.lit("</p><ul>"), children, F.lit('</ul><div><a href="/private/'), customer,
            F.lit('">account</a> '), F.coalesce("anchors", F.lit("")), F.lit("</div></body></html>"),
        ).alias("html"),
    )
    order_pages = orders.select(
        (F.col("o_orderkey") * 2 + 1).alias("page_id"),
        F.concat(F.lit(f"{SHOP}/o/"), order).alias("url"),
        F.concat(
            F.lit("<html><body><p>"), F.coalesce(F.expr(ORDER_TEXT), F.lit("")), F.lit('</p><div><a href="/c/'),
            F.col("o_custkey").cast("string"), F.lit('#orders">back</a> <a href="/p/'), (F.col("o_orderkey") % 1000).cast("string"),
            F.lit('">part</a></div></body></html>'),
        ).alias("html"),
    )
    return spread(customers.unionByName(order_pages))
