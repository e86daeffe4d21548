"""What the folds read from whole pages against the column expressions, also on broken markup."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from pageloom.functions import grid, visible
from pageloom.functions import html as H
from pageloom.functions import urls as U
from pageloom.functions.expr import column
from pageloom.functions.pieces import Cutter
from pageloom.functions.text import stitch_sql
from pageloom.operators import blocks, markup, notices, records, tables
from pageloom.operators.regions import HIDDEN
from pageloom.plans.site_walk import read_once

TAGS = ["table", "tr", "td", "a", "a", "img", "p", "div", "b", "li", "head", "header", "script", "style", "A", "h1", "br"]
ATTRIBUTES = [
    "", "", "", ' href="/x/1.pdf"', " href=y.doc?q=1", " href='/Download?id=1&amp;s=2'", ' href="http://o.org/a.zip"', ' href="//www.a.com/../b/./c.xls"',
    ' href="mailto:a@b.c"', ' href=" /sp ace.pdf\t"', ' href=""', ' href="?p=1"', ' href="a;b=1/c;d.pdf"', ' href="../../x.pdf/.."', ' href="HTTP://WWW.A.com/d.zip"',
    ' src="/i/1.jpg"', ' src="" data-src="i/2.PNG"', " data-original=../o/3.gif", ' src="a>b.png"', " title='<b>'", ' alt="un', ' src="data:x.png\n"', ' src="/a.gif\u0085"', ' colspan="2"',
]
TEXTS = [
    "one ", "two words", "&amp;", "&am", "p; x", "\n \t", "a  b\xa0", "é", "this is a rather long text of more than ten words in one block", "this is a rather long text",
    "<", " < 5 > 3 ", "﷑", "﷒x", "<!-- c -->", "<!doctype html>", "<!-- <a href=h.pdf> -->", "<script>var a='<td>';</script>", "<style>p</style >", "<?x?>", "<!", "<!-->", "<scripted>", "</", "&copy", "<é>",
]
URLS = ["https://www.a.com/s/v.jsp?id=1", "http://a.com", "https://www.a.com/s//d/", "https://www.a.com/s/../t/x;p?q#f", None, "", "a/b", "ftp://a.com/x", " \nhttps://www.a.com/ q/\t"]


def _page(rng: random.Random) -> str:
    clean, out = rng.random() < 0.4, ["<html><head><title>t</title></head><body>"] if rng.random() < 0.5 else []
    for _ in range(rng.choice([3, 20, 60])):
        tag, kind = rng.choice(TAGS), rng.random()
        if kind < 0.4:
            attributes = rng.choice(ATTRIBUTES[:18] if clean else ATTRIBUTES)
            out.append(f"<{tag}{attributes}{rng.choice(['', '', '/', ' '])}>")
        else:
            out.append(f"</{tag}{rng.choice(['', ' '])}>" if kind < 0.6 else rng.choice(TEXTS[:10] if clean else TEXTS))
    return "".join(out)


def _pages(spark):
    rng = random.Random(21)
    rows = [(i, rng.choice(URLS), _page(rng)) for i in range(700)] + [(900, URLS[0], None), (901, None, None), (902, URLS[0], "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)


def _by_page(rows):
    return {r.page_id: tuple(r)[1:] for r in rows}


def test_records_and_links_equal_column_expressions(spark):
    pages = _pages(spark)
    made = _by_page(records.build_records(pages, "'a.com'").select("page_id", "merged_text", "images", "files").collect())
    want = _by_page(pages.select("page_id", blocks.page_text("html"), markup.image_array("html", "url"), markup.file_array("html", "url", "'a.com'")).collect())
    assert made == want and any(t and i for t, i, _ in want.values()) and any(f for _, _, f in want.values())
    quoted = "'a.com'"
    links = column(f"array_distinct(transform({markup.link_array_sql('html', 'url', quoted)}, t -> t.target))")
    want = _by_page(pages.select("page_id", links, blocks.page_text("html")).collect())
    assert _by_page(read_once(pages, quoted).select("page_id", "links", "merged_text").collect()) == want
    assert any(found for found, _ in want.values())


def test_pieces_equal_tokens(spark):
    rows = _pages(spark).select("html", H.token_array("html").alias("t"), column(H.token_array_sql("html", HIDDEN)).alias("m")).where("html is not null").collect()
    cut = Cutter(lambda tag: (tag,), ("",))
    for html, *cuts in rows:
        for instead, tokens in zip(("", HIDDEN), cuts):
            want = "".join("" if t.startswith(("<!", "<?")) else t for t in tokens)
            made = cut.plain(html)
            for found in (cut.other(html, instead), *([made] if made is not None else [])):
                assert "".join(tag + text for (tag,), _, text in found) == want


def test_addresses_equal_column_expressions(spark):
    rng = random.Random(22)
    parts = ["http:", "https:", "mailto:", "//", "/", "www.a.com", ":80", ".", "..", "/x_1", "a.b", "~y", "#f", "?q=1&r=%41", "?", ";p", " ", "\n", "é", " ", ""]
    made = list(dict.fromkeys("".join(rng.choice(parts) for _ in range(rng.randrange(1, 7))) for _ in range(1500)))
    bases = [*URLS, "https://a.com/s/.x/..", "https://a.com/a//b", "http://a.com/x/.. ", "/only", "//h/p"]
    rows = spark.createDataFrame([(u, b) for u in made for b in bases], "u string, b string").repartition(8).select("u", "b", U.resolve_url("b", "u").alias("r"))
    resolvers = {b: U.Resolver(b) for b in bases}
    assert [r for r in rows.collect() if resolvers[r.b](r.u) != r.r] == []


def test_stitching_equals_the_column_expression(spark):
    rng = random.Random(23)
    rows = [tuple(" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 14))) for _ in range(2)) for _ in range(500)]
    made = spark.createDataFrame(rows, "a string, b string").select("a", "b", F.expr(stitch_sql('a', 'b')).alias("s")).collect()
    assert [r for r in made if visible.stitched(r.a, r.b) != r.s] == []


def test_tags_are_not_cut_by_column_expressions(spark):
    pages = spark.createDataFrame([(1, "https://a.com/", "<p>x</p>")], "page_id long, url string, html string")
    for made in (tables.table_cells(pages), records.build_records(pages, "'a.com'"), notices.notice_records(pages, "https://a.com/"), notices.next_link(pages, "https://a.com/")):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "regexp_extract_all" not in plan and "posexplode" not in plan


def test_cells_are_flat_rows_in_order(spark):
    html = "<table><tr><td>a<td>b</table><p>x</p><table></table><table><tr><td rowspan=2>c <a href=k>l</a></td></tr></table>"
    pages = spark.createDataFrame([(1, "https://a.com/", html), (2, "u", None), (3, "https://a.com/", "<TABLE><tr><td>d")], "page_id long, url string, html string").coalesce(1)
    rows = tables.table_cells(pages).collect()
    assert [(r.page_id, r.table_no, r.cell_no, r.row, r.col, r.text) for r in rows] == [(1, 0, 0, 0, 0, "ab"), (1, 2, 0, 0, 0, "c l"), (3, 0, 0, 0, 0, "d")]
    assert rows[1].rowspan == 2 and [tuple(x) for x in rows[1].links] == [("https://a.com/k", "l")]


def test_a_task_remembers_a_bounded_number_of_pieces(monkeypatch):
    monkeypatch.setattr("pageloom.functions.pieces.MOST_PIECES", 10)
    cut = Cutter(grid.tag_reader(), grid.NO_TAG)
    for i in range(100):
        assert [text for _, text, _ in cut.plain(f"<b>{i}<i x={i}>" + "t" * 500)] == [str(i), "t" * 500]
        assert max(map(len, (cut.shown, cut.tags, cut.any))) <= 10 and all(len(p) <= 200 for p in cut.shown)


def test_a_tag_with_one_attribute_is_read_as_any_other(monkeypatch):
    rng = random.Random(24)
    names = ["a", "A", "img", "td", "th", "p", "DIV", "head", "header", "br", "table", "tr", "x1"]
    kinds = ["href", "SRC", "src", "data-src", "data-original", "colspan", "rowspan", "class", "id", "title"]
    tags = [f'<{rng.choice(names)} {rng.choice(kinds)}="{rng.choice(["", "2", " 3 ", "x", "a b", "/i/1.png", "é"])}">' for _ in range(800)]
    plain = list(map(grid.tag_reader(lambda *what: what), tags))
    monkeypatch.setattr(grid, "_ONE_ATTRIBUTE", re.compile("(?!)"))
    assert plain == list(map(grid.tag_reader(lambda *what: what), tags))
