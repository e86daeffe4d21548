"""The fold over a page's tokens against a tree and a matrix, also on broken markup."""

from __future__ import annotations

import random
import re
from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from pageloom.functions import grid
from pageloom.functions import html as H
from pageloom.functions.html import VOID_TAGS
from pageloom.operators import tables


class Node:
    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, dict(attrs), parent, []

    def below(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.below()

    def text(self):
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)


class Tree(HTMLParser):
    def __init__(self, page):
        super().__init__()
        self.root = self.at = Node("", [], None)
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in VOID_TAGS:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, attrs, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def clean(text):
    return re.sub(r"\s+", " ", text).strip()


def by_matrix(page):
    """Tables as the contract says: a matrix of cells, filled row by row."""
    out = {}
    for number, table in enumerate(n for n in Tree(page).root.below() if n.tag == "table"):
        rows = [[c for c in tr.children if isinstance(c, Node) and c.tag in ("td", "th")] for tr in table.below() if tr.tag == "tr"]
        try:
            spans = {id(c): (int(c.attrs.get("colspan", 1)), int(c.attrs.get("rowspan", 1))) for row in rows for c in row}
        except ValueError:
            continue
        width = max((sum(spans[id(c)][0] for c in row) for row in rows), default=0)
        taken, cells = set(), []
        for n, row in enumerate(rows):
            col = 0
            for c in row:
                while (n, col) in taken:
                    col += 1
                if col >= width:
                    break
                cols, high = spans[id(c)]
                images = [i for i in c.below() if i.tag == "img"]
                links = [a for a in c.below() if a.tag == "a"]
                cells.append((
                    n, col, clean(c.text()), cols if cols > 1 else None, high if high > 1 else None,
                    [i.attrs["src"] for i in images if i.attrs.get("src")] if images else None,
                    [(a.attrs["href"], clean(a.text())) for a in links if a.attrs.get("href")] if links else None,
                ))
                taken |= {(n + i, col + j) for i in range(high) for j in range(cols) if col + j < width}
                col += cols
        out[number] = cells
    return out


PARTS = (
    "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", '<td colspan="2">', '<td rowspan="2">', '<th rowspan="3" colspan="2">', "</th>",
    "<td/>", "<div>", "</div>", '<a href="u">', "</a>", '<img src="i">', "<img>", "<br>", "one ", "two", "<p>", "<td rowspan=x>",
)


def soup(rng, n):
    """Mostly tables, sometimes broken."""
    out = ["<table>"]
    for _ in range(n):
        out.append(rng.choices(PARTS, [2, 2, 9, 6, 12, 9, 4, 4, 2, 2, 1, 2, 2, 3, 3, 2, 1, 1, 8, 8, 2, 0.2])[0])
    return "".join(out)


def test_fold_equals_tree_and_matrix(spark):
    rng = random.Random(6)
    pages = [(i, "", soup(rng, rng.choice([5, 20, 60, 150]))) for i in range(400)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    got = {}
    for r in tables.extract_tables(df).collect():
        got.setdefault(r.page_id, {})[r.table_no] = [
            (c.row, c.col, c.text, c.colspan, c.rowspan, c.img_links, None if c.links is None else [tuple(x) for x in c.links]) for c in r.cells
        ]
    for i, _, page in pages:
        assert got.get(i, {}) == by_matrix(page), page


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), max_size=6), max_size=8))
def test_intervals_equal_a_matrix(spans):
    rows = [[grid.Cell(c, r, (0, 0, 0)) for c, r in row] for row in spans]
    taken, want = set(), []
    width = max((sum(c for c, _ in row) for row in spans), default=0)
    for n, row in enumerate(spans):
        col = 0
        for k, (cols, high) in enumerate(row):
            while (n, col) in taken:
                col += 1
            if col >= width:
                break
            want.append((n, col, k))
            taken |= {(n + i, col + j) for i in range(high) for j in range(cols) if col + j < width}
            col += cols
    assert [(n, col, rows[n].index(cell)) for n, col, cell in grid.placed(rows)] == want


def test_one_scan_without_shuffle_or_window(spark):
    df = spark.createDataFrame([(1, "", "<table></table>")], "page_id long, url string, html string")
    plan = tables.extract_tables(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and plan.count("MapInArrow") == 1 and plan.count("Scan ") == 1


def test_a_large_page_takes_linear_time(spark):
    row = "<tr>" + "<td rowspan=2>a</td><td>b</td>" * 10 + "</tr>"
    page = "<table>" + row * 10_000 + "</table>"
    df = spark.createDataFrame([(1, "", page)], "page_id long, url string, html string")
    assert len(tables.extract_tables(df).first().cells) > 100_000


def test_the_fold_reads_tokens_as_the_column_expressions_do(spark):
    tags = [
        """<a title="x > href=no" HREF='/q?a=1&amp;b=2&copy=3&lt;&eacute' data-href="n" checked>""", "<a href>", "<a href = x href=y>", "<img src=&#65;.png/>",
        "<td colspan=' 2 ' rowspan=x>", "<td colspan=&#50;>", "<a data-href=x>", "<a href=\"\">", "<a href='a\"'>", "<td rowspan>",
    ]
    names = ["href", "src", "colspan", "rowspan", "title"]
    texts = ["a &amp;lt; b", "&nbsp;&quot;&hellip;", "&copy 1 &amp;", "&#x41;&#0;&#64976;", "x & y &", "&notit; &notin;", "&unknown; &AMP", "&lt;&", "&amp;#65;"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tags + texts)], "i int, t string")
    exprs = ", ".join(H.attribute_sql("t", n) for n in names)
    rows = df.selectExpr("i", f"array({exprs}) AS a", f"{H.decode_entities_sql('t')} AS d", f"{H.decode_entities_sql('t', True)} AS e").orderBy("i").collect()
    assert [r.a for r in rows[: len(tags)]] == [H.attributes(t, names) for t in tags]
    assert [(r.d, r.e) for r in rows] == [(H.decoded(t), H.decoded(t, True)) for t in tags + texts]


def test_spans_are_read_as_numbers_are_cast(spark):
    spans = ["2", " +3 ", "-1", "2.5", "x", "", "\t4\n", "2147483648", "-2147483648", "٢", "1e1"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(spans)], "i int, v string")
    cast = [r.c for r in df.selectExpr("i", "try_cast(trim(v) AS int) AS c").orderBy("i").collect()]
    assert [grid._span(v) for v in spans] == [grid.BAD if c is None else c for c in cast]


def test_no_token_is_made_a_struct_by_column_expressions(spark):
    pages = spark.createDataFrame([(1, "http://h/", "<table><tr><td>x</table>")], "page_id long, url string, html string")
    plan = tables.with_tables(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "str_to_map" not in plan and "try_cast" not in plan
