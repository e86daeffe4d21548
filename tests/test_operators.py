"""Operators: edge cases, frequent keys, equality of the alternative ways."""

from __future__ import annotations

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from pageloom.functions import html, urls
from pageloom.operators import blocks, dedup, fetchlog, frontier, markup, notices, skew, tables
from pageloom.operators import urls as url_ops
from pageloom.plans.site_pass import run_pass
from pageloom.sources import jsonl, state

PAGE = "page_id long, url string, html string"
NESTED = (
    '<table><tr><th colspan=2>Head</th></tr><tr><td rowspan="2">A &amp; B</td><td>x <a href="n/1">li<b>nk</b></a>'
    '<img src="/f/1.PNG"></td></tr><tr><td>y<table><tr><td>in1</td><td>in2</td></tr></table></td><td>drop</td></tr>'
    '<tr><td></td><td><a>q</a></td></tr></table><table></table><table><tr><td colspan="x">bad</td></tr></table>'
)
PLAIN = (
    '<TABLE class="<td>"><thead><tr><th colspan=2>H</th><th>I</th></tr></thead><tr><td rowspan="3">a</td><td colspan="2">b &lt; c</td></tr>'
    '<tr><td>d</td><td>e</td><td>too many</td></tr><tr><td><a href="k"> l </a><a href="">m</a></td><td><img src="i.png"><img></td></tr></TABLE>'
    '<table><tr><td rowspan="z">bad</td></tr></table><table></table>'
)


def cells_of(df):
    return {
        (r.table_no, c.row, c.col): (c.text, c.colspan, c.rowspan, c.img_links, [tuple(l) for l in c.links] if c.links is not None else None)
        for r in df.collect()
        for c in r.cells
    }


def test_nested_tables(spark):
    pages = spark.createDataFrame([(1, "https://a.com/s/v", NESTED)], PAGE)
    got = cells_of(tables.extract_tables(pages))
    assert got[(0, 0, 0)] == ("Head", 2, None, None, None)
    assert got[(0, 1, 0)] == ("A & B", None, 2, None, None)
    assert got[(0, 1, 1)] == ("x link", None, None, ["https://a.com/f/1.PNG"], [("https://a.com/s/n/1", "link")])
    assert got[(0, 2, 1)][0] == "yin1in2" and (0, 2, 2) not in got  # no room beside the row span
    assert got[(0, 4, 1)] == ("q", None, None, None, [])
    assert got[(1, 0, 1)][0] == "in2"
    numbers = [r.table_no for r in tables.extract_tables(pages).orderBy("table_no").collect()]
    assert numbers == [0, 1, 2]  # the last table has a bad span


def test_plain_tables(spark):
    pages = spark.createDataFrame([(1, "https://a.com/s/v", PLAIN), (2, "https://a.com/", None), (3, "https://a.com/", "")], PAGE)
    cells = cells_of(tables.extract_tables(pages))
    assert cells[(0, 2, 1)][0] == "d" and cells[(0, 1, 1)][0] == "b < c"
    assert cells[(0, 3, 1)][4] == [("https://a.com/s/k", "l")]
    assert cells[(0, 3, 2)][3] == ["https://a.com/s/i.png"] and len(cells) == 8


def test_links_and_scope(spark):
    page = '<a href=" /a /b ">x</a><a href="mailto:q">m</a><a href="JAVASCRIPT:x">j</a><a href="/Download.jsp?x">d</a><a href="http://b.com/">o</a>'
    pages = spark.createDataFrame([(1, "https://a.com/s/v?q=1", page)], PAGE)
    got = [r.target for r in markup.extract_links(pages, "'a.com'").orderBy("pos", "part").collect()]
    # blank pieces stand for the page itself
    assert got == ["https://www.a.com/s/v", "https://www.a.com/a", "https://www.a.com/b", "https://www.a.com/s/v"]


def test_spans_ignore_stray_ends(spark):
    tokens = markup.tokenize(spark.createDataFrame([(1, "u", "</p><p>a<p>b</p></p></p><p>c</p>")], PAGE))
    got = sorted((r.start, r.end, r.level) for r in markup.spans(tokens).collect())
    assert got == [(1, 6, 1), (3, 5, 2), (8, 10, 1)]


def rule_rows(spark, rows):
    return spark.createDataFrame(rows, url_ops.RULE_SCHEMA)


# a literal, pages that are broadcast, pages that are joined by shuffle with frequent ones split
INDEXES = [{}, {"inline_bytes": 0, "page": 1}, {"inline_bytes": 0, "broadcast_bytes": 0, "page": 2, "rows_per_task": 3}]


@pytest.mark.parametrize("index", INDEXES)
def test_rules(spark, index):
    urls = ["https://a.com/wx", "https://a.com/wxyz", "https://b.com/p?mid=n1", "https://b.com/p?mid=m1&mid=n1", "https://c.com/in/x", "https://c.com/", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rules = rule_rows(spark, [("path", None, "/wxy"), ("param", "mid", "n"), ("url", None, "https://c.com/in"), ("path", None, "/wx/")])
    kept = {r.url for r in url_ops.exclude_urls(df, "url", rules, **index).collect()}
    assert kept == {"https://a.com/wx", "https://b.com/p?mid=m1&mid=n1", "https://c.com/", None}
    assert url_ops.exclude_urls(df, "url", rules.limit(0), **index).count() == len(urls)


@pytest.mark.parametrize("index", INDEXES)
def test_many_rules_against_all_pairs(spark, index):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("ab'\\é/") for _ in range(rng.randrange(n)))
    urls = [f"https://{rng.choice('ab')}.com/{word(5)}?x={rng.choice('ab')}{rng.choice('ab1')}&y={word(3)}&x=b" for _ in range(150)]
    rows = [("path", None, "/" + word(4)) for _ in range(25)] + [("url", "x", f"https://a.com/{word(4)}") for _ in range(25)]
    rows = [r for r in rows if r[2] not in ("/", "https://a.com/")]
    rows += [("param", "x", "ab"), ("param", "y", "é"), ("param", "z", ""), ("param", None, "a"), ("other", "x", "a"), ("path", None, None)] + rows[:3]
    df = spark.createDataFrame([(u,) for u in [*urls, urls[0]]], "url string")

    def hit(url):
        path, query = re.match(r"https://[^/]*(/[^?]*)\?(.*)", url).groups()
        values = {}
        for name, value in (p.split("=", 1) for p in query.split("&")):
            if value:
                values.setdefault(name, value)
        texts = {"url": lambda p: url, "path": lambda p: path, "param": values.get}
        return any(k in texts and v is not None and (texts[k](p) or "").startswith(v) and texts[k](p) is not None for k, p, v in rows)

    kept = [r.url for r in url_ops.exclude_urls(df, "url", rule_rows(spark, rows), **index).collect()]
    expected = [u for u in [*urls, urls[0]] if not hit(u)]
    assert 10 < len(expected) < 140 and sorted(kept) == sorted(expected)


def test_longer_rules_are_found_within_pages(spark):
    """Only the beginnings of a page's first rule are looked up, so a beginning that all rules share is no frequent key."""
    from pageloom.operators import rules as index

    texts = sorted({f"param2:ab{n}" for n in range(3, 3000, 7)} | {"path0:/é", "path0:/éa", "url0:x", "url0:x\\y"}, key=str.encode)
    cut = [(texts[k], texts[k : k + 5]) for k in range(0, len(texts), 5)]
    pages = spark.createDataFrame(cut, "first string, rules array<string>")
    kept = sorted(r for p in index._without_longer(pages).collect() for r in p.rules)
    assert kept == sorted(r for r in texts if not any(r != s and r.startswith(s) for s in texts))
    assert index.shortest(["a", "ab", "b", "ba", "c"], before="a") == ["b", "c"]


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti", "left"])
def test_split_join_equals_plain_join(spark, how):
    left = spark.range(300).select(F.when(F.col("id") < 100, 7).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(0, 200, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(spark.createDataFrame([(7, 1)], "k long, v long"))
    hot = skew.hot_keys(left, "k", rows_per_task=10)
    assert [tuple(r) for r in hot.collect()] == [(7, 10)]
    split = skew.split_join(left, right, "k", how, hot, spread_by="id")
    plain = left.join(right, "k", how)
    assert sorted(map(tuple, split.select(plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_dedup_keeps_the_smallest_key_of_a_frequent_text(spark):
    df = spark.range(60).select("id", F.when(F.col("id") % 3 == 0, "Same, text!").otherwise(F.concat(F.lit("t"), "id")).alias("t"))
    kept = dedup.dedup_text(df, "t", "id")
    assert kept.count() == 41 and kept.where("t = 'Same, text!'").first().id == 0
    history = kept.where("id = 0").select("fp")
    again, added = dedup.dedup_history(df, history, "t", "id")
    assert again.count() == 40 and added.count() == 40
    assert dedup.unseen_small(kept, history, "fp").count() == 40


def test_template_blocks_with_frequent_key(spark):
    rows = [(i, f"https://h/{i}", f"<p>menu of the site</p><p>own text {i}</p>") for i in range(30)]
    pages = spark.createDataFrame(rows, PAGE)
    for limit in (3, 1_000_000):
        got = blocks.text_blocks(pages, rows_per_task=limit)
        assert {r.text for r in got.collect()} == {f"own text {i}" for i in range(30)}


def test_link_depths_with_frequent_source(spark):
    edges = [("a", f"n{i}") for i in range(40)] + [("n1", "z"), ("z", "a"), ("y", "q")]
    graph = spark.createDataFrame(edges, "src string, dst string")
    seed = spark.createDataFrame([("a",)], "url string")
    got = {r.url: r.depth for r in frontier.link_depths(graph, seed, rows_per_task=5).collect()}
    assert got == {"a": 0, "z": 2, **{f"n{i}": 1 for i in range(40)}}
    assert frontier.link_depths(graph, seed, max_depth=1).count() == 41


@pytest.mark.parametrize("limit", [5, 1000])
def test_edges_stay_where_they_are(spark, limit):
    """Inside the loop neither an exchange nor a sort of the edges, with and without a frequent source."""
    edges = spark.createDataFrame([("a", f"n{i}") for i in range(40)] + [("n1", "z"), ("z", "a")], "url string, dst string")
    hot = skew.hot_keys(edges, "url", limit)
    placed = frontier.placed_edges(edges, hot)
    level = spark.createDataFrame([("a",), ("z",)], "url string")
    found = frontier.edges_of(level, placed, hot)
    plan = found._jdf.queryExecution().executedPlan().toString()
    joined = plan.split("InMemoryTableScan")[0]  # the left side; below stands how it was made
    assert "SortMergeJoin" in joined and "Exchange" not in joined and "Sort [" not in joined
    assert sorted(r.dst for r in found.collect()) == sorted(["a", *[f"n{i}" for i in range(40)]])
    if hot is not None:
        assert placed.select("part").distinct().count() == 8
    placed.unpersist()


def test_chain_with_cycle_and_missing_page(spark):
    links = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("x", "y"), ("y", "gone"), ("p", "y")]
    df = spark.createDataFrame(links, "url string, next_url string")
    start = spark.createDataFrame([("a",), ("x",), ("none",)], "url string")
    got = sorted((r.start, r.pos, r.url) for r in notices.walk_chain(df, start, rows_per_task=1).collect())
    assert got == [("a", 0, "a"), ("a", 1, "b"), ("a", 2, "c"), ("a", 3, "d"), ("x", 0, "x"), ("x", 1, "y")]


def test_chain_with_converging_starts(spark):
    # s2 joins the chain of s1, both and s3 end in a cycle, and many pages point to one
    links = [("s1", "b"), ("b", "c"), ("s2", "c"), ("c", "d"), ("d", "e"), ("e", "c"), ("s3", "d")] + [(f"m{i}", "e") for i in range(50)]
    df = spark.createDataFrame(links, "url string, next_url string")
    start = spark.createDataFrame([("s1",), ("s2",), ("s3",), ("s2",), *[(f"m{i}",) for i in range(50)]], "url string")
    got = {r.url: (r.start, r.pos) for r in notices.walk_chain(df, start, rows_per_task=1).collect()}
    want = {"s1": ("s1", 0), "s2": ("s2", 0), "s3": ("s3", 0), "b": ("s1", 1), "c": ("s2", 1), "d": ("s3", 1), "e": ("m0", 1)}
    assert got == want | {f"m{i}": (f"m{i}", 0) for i in range(50)}
    assert notices.walk_chain(df, start.limit(0)).count() == 0


def test_new_notices_edges(spark):
    rows = spark.createDataFrame([("101",), ("100",), ("12a",), (None,)], "article_no string")
    mark = lambda v: spark.createDataFrame([(v, "")], "last_article_no string, last_page_url string")
    assert [r[0] for r in notices.new_notices(rows, mark("100")).collect()] == ["101"]
    assert notices.new_notices(rows, mark(None)).count() == 0
    assert notices.new_notices(rows, mark("100").limit(0)).count() == 4  # nothing was loaded yet


def test_bad_notice_gives_nulls(spark):
    page = '<span class="date">soon</span><dl class="board_view"><dt><strong>T</strong></dt></dl>'
    row = notices.notice_fields(spark.createDataFrame([(1, "u", page)], PAGE)).first()
    assert (row.title, row.date_text, row.category, row.notice_date) == ("T", "soon", None, None)
    good = page.replace("soon", "2024.1.5")
    assert notices.notice_fields(spark.createDataFrame([(1, "u", good)], PAGE)).first().notice_date == datetime.date(2024, 1, 5)


def test_fetch_outcomes(spark):
    def tries(url, *pairs):
        return [(url, i, status, seconds, "text/html") for i, (status, seconds) in enumerate(pairs)]

    rows = (
        tries("ok", (503, 1.0), (503, 1.0), (None, 1.0), (200, 1.0), (200, 1.0))
        + tries("gone", (404, 1.0), (200, 1.0))
        + tries("ten", *[(503, 1.0)] * 12)
        + tries("slow", (503, 150.0), (503, 60.0), (200, 1.0))
    )
    log = spark.createDataFrame(rows, "url string, attempt int, status int, elapsed double, content_type string")
    df = fetchlog.fetch_outcomes(log)
    got = {r.url: (r.outcome, r.attempts, r.total_seconds) for r in df.collect()}
    assert got == {"ok": ("ok", 4, 4.0), "gone": ("fail", 1, 1.0), "ten": ("fail", 10, 10.0), "slow": ("fail", 2, 210.0)}
    # the limit on attempts is applied before the shuffle
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange") < plan.rindex("WindowGroupLimit")


def test_link_extraction_and_urls_need_no_shuffle(spark):
    pages = spark.createDataFrame([(1, "https://a.com/", NESTED)], PAGE)
    for df in (markup.extract_links(pages, "'a.com'"), markup.extract_files(pages, "'a.com'"), markup.extract_images(pages)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("nested", ["", "<table><tr><td>in</td></tr></table>"])
def test_huge_spans_cost_nothing(spark, nested):
    plain = f"<table><tr><td>a{nested}</td></tr></table>"

    def cells(page):
        rows = tables.extract_tables(spark.createDataFrame([(1, "https://a.com/", page + plain)], PAGE)).collect()
        return {(r.table_no, c.row, c.col): c.text for r in rows for c in r.cells}

    wide = cells('<table><tr><td rowspan="2" colspan="200000000">x</td><td>y</td></tr><tr><td>z</td></tr></table>')
    assert wide[0, 0, 200_000_000] == "y" and wide[0, 1, 200_000_000] == "z" and wide[1, 0, 0].startswith("a")
    # columns that a number cannot hold: their table goes, the others stay
    beyond = cells(f"<table><tr>{'<td colspan=2147483647>x</td>' * 3}</tr><tr><td>y</td></tr></table>")
    assert not any(t == 0 for t, _, _ in beyond) and beyond[1, 0, 0].startswith("a")
    tall = cells('<table><tr><td rowspan="2147483647">t</td></tr><tr><td>u</td><td>w</td></tr></table>')
    assert tall[0, 0, 0] == "t" and tall[0, 1, 1] == "u" and (0, 1, 2) not in tall


def test_literal_marks_are_no_structure(spark):
    row = spark.createDataFrame([("https://a.com/\ufdd0x", "one\ufdd1two")], "u string, h string").select(
        html.block_array("h").alias("b"), urls.netloc("u").alias("host")
    ).first()
    assert [b.text for b in row.b] == ["onetwo"] and row.host == "a.com"


def test_state_body_in_another_encoding(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"parsing_queue": [["w", "yPm+/A==", 1]]}')
    assert len(state.read_state(spark, str(tmp_path))["pending_pages"].collect()) == 1


def test_every_frequent_key_is_split(spark):
    left = spark.range(12_000).select((F.col("id") % 1200).alias("k"))
    assert skew.hot_keys(left, "k", rows_per_task=9).count() == 1200


def test_state_file(spark, tmp_path):
    good = '{"fetching_queue": [["u", 2], ["v", 0]],\n "parsing_queue": [["w", "PGI+", 1]], "visited": ["u"]}'
    (tmp_path / "good.json").write_text(good)
    (tmp_path / "torn.json").write_text('{"visited": ["x"')
    got = state.read_state(spark, str(tmp_path))
    assert sorted(map(tuple, got["frontier"].collect())) == [("u", 2, 0), ("v", 0, 1)]
    assert [tuple(r) for r in got["pending_pages"].collect()] == [("w", "<b>", 1, 0)]
    assert [r.url for r in got["visited"].collect()] == ["u"] and got["seen"].count() == 0
    assert state.read_state(spark, str(tmp_path / "none"))["parsed"].count() == 0


def test_snapshot_without_manifest_is_ignored(spark, tmp_path):
    path = str(tmp_path)
    assert state.read_snapshot(spark, path)["visited"].count() == 0
    state.write_state({"visited": spark.createDataFrame([("u",)], "url string")}, path, 1)
    spark.createDataFrame([("torn",)], "url string").write.parquet(f"{path}/snapshot=2/visited")
    assert [r.url for r in state.read_snapshot(spark, path)["visited"].collect()] == ["u"]


def test_jsonl(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    assert jsonl.read_jsonl(spark, str(path), "a string").count() == 0
    path.write_text('{"a": "é"}\n\n{"a": "b"}\n')
    assert jsonl.read_jsonl(spark, str(path), "a string").count() == 2
    path.write_text('{"a": "é"}\n{"a": \n')
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(path), "a string").collect()


def test_pass_follows_only_surviving_pages(spark):
    text = "<p>" + " ".join(f"word{i}" for i in range(12)) + "</p>"
    rows = [
        (1, "https://a.com/1", text + '<a href="/x">x</a><a href="/2">known</a>', 0),
        (2, "https://a.com/2", text + '<a href="/y">y</a>', 0),  # same text: dropped with its links
        (3, "https://a.com/3", '<a href="/z">z</a>', 0),  # no text but a link
    ]
    pages = spark.createDataFrame(rows, PAGE + ", depth int")
    result = run_pass(pages, "'a.com'")
    assert [r.page_id for r in result.records.collect()] == [1]
    assert sorted((r.url, r.depth) for r in result.frontier.collect()) == [("https://a.com/x", 1)]
    again = run_pass(pages, "'a.com'", seen=result.seen, small_batch=True)
    assert again.records.count() == 0 and again.frontier.count() == 0


def test_files_stay_below_the_bound(spark, tmp_path):
    rows = [(i, "é" * (i % 50), "b") for i in range(500)] + [(1000, "x" * 3000, None), (1001, None, None)]
    df = spark.createDataFrame(rows, "n int, bytes string, part string").repartition(3)
    path = str(tmp_path / "out")
    for _ in range(2):  # the second call adds files of its own
        jsonl.write_bounded(df, path, target_bytes=1000)
    files = jsonl.file_sizes(spark, path).collect()
    assert all(f.n_bytes <= 1000 or f.n_records == 1 for f in files) and sum(f.n_bytes > 1000 for f in files) == 2
    # no file could have taken the first record of the next one
    assert len(files) <= 2 * sum(f.n_bytes for f in files) / 1000 + 6
    back = jsonl.read_jsonl(spark, path, "n int, bytes string, part string")
    assert sorted(back.collect(), key=repr) == sorted([*df.collect(), *df.collect()], key=repr)
    jsonl.write_bounded(df.limit(0), str(tmp_path / "none"), target_bytes=1000)
    assert jsonl.read_jsonl(spark, str(tmp_path / "none"), "n int").count() == 0


@pytest.mark.parametrize("key", [None, "who"])
@pytest.mark.parametrize("slots_per_range", [1, 3, 4096])
def test_sessions_across_ranges(spark, key, slots_per_range):
    base, step = datetime.datetime(2024, 1, 1), [0, 5, 9, 10, 11, 40, 41, 49, 59, 60, 200, 209, 219, 229, 239, 240, 300, 311]
    rows = [(base + datetime.timedelta(seconds=s), who) for who in ("a", None) for s in step] + [(base, "b"), (None, "b")]
    log = spark.createDataFrame(rows, "ts timestamp, who string")
    got = fetchlog.sessions(log, key=key, gap_seconds=10, slots_per_range=slots_per_range).collect()
    want = []
    for who in {w for _, w in rows} if key else {""}:
        number, last = 0, None
        for t in sorted(t for t, w in rows if t is not None and (not key or w == who)):
            if last is None or (t - last).total_seconds() >= 10:
                number += 1
                want.append([who, number, t, t, 0])
            want[-1][3], want[-1][4], last = t, want[-1][4] + 1, t
    found = [((r[key] if key else ""), r.session_no, r.started, r.ended, r.n_rows) for r in got]
    assert sorted(found, key=repr) == sorted(map(tuple, want), key=repr)


def test_no_task_sees_all_slots(spark):
    log = spark.range(10).select(F.timestamp_seconds("id").alias("ts"))
    plan = fetchlog.sessions(log)._jdf.queryExecution().executedPlan().toString()
    single = plan.index("Exchange SinglePartition")
    # what meets in one task are ranges, already aggregated
    assert plan.count("Exchange SinglePartition") == 1 and "_range" in plan[single:].split("HashAggregate", 2)[1]
