"""The walk from seeds on small sites, and what it moves."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from pageloom.operators.growing import FAN_IN, Growing
from pageloom.plans.site_walk import by_url, fetch, read_once, run_walk

HOST = "https://a.example.com"
WORDS = "one two three four five six seven eight nine ten eleven "


def page(page_id, path, text, *links):
    anchors = " ".join(f'<a href="{link}">x</a>' for link in links)
    paragraph = f"<p>{WORDS}{text}</p>" if text else ""
    return page_id, f"{HOST}{path}", f"<html><body>{paragraph}<div>{anchors}</div></body></html>"


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def urls(spark, *paths, more="url string"):
    return spark.createDataFrame([(f"{HOST}{p}",) for p in paths], more)


def walked(result):
    records = {r["url"].removeprefix(HOST): r["depth"] for r in result.records.select("url", "depth").collect()}
    unfetched = {r["url"].removeprefix(HOST): r["depth"] for r in result.unfetched.collect()}
    return records, unfetched


SITE = [
    page(1, "/", "start", "/b", "/c#x", "/gone", "http://other.example.org/z"),
    page(2, "/b", "bee", "/d", "/"),
    page(3, "/c", "sea", "/e", "/dup"),
    page(4, "/d", "dee", "/f"),
    page(5, "/e", "bee", "/hidden"),  # the text of /b, one level later: dropped with its links
    page(6, "/dup", "dee", "/hidden"),  # the text of /d on the same level, larger id
    page(7, "/f", "eff", "/b", "/private/x", "/late"),
    page(8, "/hidden", "hidden"),
    page(9, "/late", None, "/hidden"),  # no text
    page(10, "/island", "island", "/hidden"),
    page(11, "/c#again", "another copy of the address", "/hidden"),
]


def test_walk_goes_level_by_level(spark):
    result = run_walk(frame(spark, SITE), urls(spark, "/"), "'example.com'", spark.createDataFrame(
        [("path", None, "/private")], "kind string, param string, value string"))
    records, unfetched = walked(result)
    assert records == {"/": 0, "/b": 1, "/c": 1, "/d": 2, "/f": 3}
    assert unfetched == {"/gone": 1}
    assert {r["url"].removeprefix(HOST) for r in result.visited.collect()} >= {"/b", "/c", "/d", "/e", "/dup", "/f", "/late", "/gone"}
    assert result.seen.count() == result.parsed.count() == 5


def test_walk_stops_at_a_depth(spark):
    records, unfetched = walked(run_walk(frame(spark, SITE), urls(spark, "/"), "'example.com'", max_depth=1))
    assert sorted(records.values()) == [0, 1, 1] and unfetched == {"/gone": 1}


def test_history_is_respected(spark):
    first = run_walk(frame(spark, SITE), urls(spark, "/"), "'example.com'", max_depth=1)
    again = run_walk(
        frame(spark, SITE), urls(spark, "/d", "/b"), "'example.com'", visited=first.visited, parsed=first.parsed, seen=first.seen,
        known_keys=first.visited.select("content_key"),
    )
    # /b is known, /e has a known text
    assert walked(again)[0] == {"/d": 0, "/f": 1} and again.visited.where(F.col("url").endswith("/b")).isEmpty()


def test_extra_links_join_the_seeds(spark):
    extra = spark.createDataFrame([(f"{HOST}/island", 7), (f"{HOST}/", 3), (None, 0), (f"{HOST}/b", 99)], "url string, depth int")
    records, _ = walked(run_walk(frame(spark, SITE), urls(spark, "/"), "'example.com'", max_depth=9, extra=extra))
    assert records["/island"] == 7 and records["/hidden"] == 8 and records["/"] == 0 and records["/b"] == 1


@pytest.mark.parametrize("rows, seeds", [([], ["/"]), (SITE, []), (SITE, ["/nowhere"])])
def test_nothing_to_walk(spark, rows, seeds):
    result = run_walk(frame(spark, rows), urls(spark, *seeds), "'example.com'")
    assert result.records.count() == result.seen.count() == 0
    assert result.unfetched.count() == len(seeds)


def test_cycles_end_and_long_chains_keep_few_parts(spark):
    n = 12
    site = [page(i, f"/{i}", f"page {i}", f"/{i + 1}", f"/{i // 2}", "/0") for i in range(n)]
    result = run_walk(frame(spark, site), urls(spark, "/0"), "'example.com'")
    assert walked(result) == ({f"/{i}": i for i in range(n)}, {f"/{n}": n})


def test_pages_stay_where_they_are(spark):
    """A level joins the pages without an exchange or a sort of theirs."""
    nodes = by_url(read_once(frame(spark, SITE), "'example.com'"))
    plan = fetch(urls(spark, "/b").withColumn("depth", F.lit(0)), nodes)._jdf.queryExecution().executedPlan().toString()
    joined = plan.split("InMemoryTableScan")[0]  # below it stands how the cached table was made
    assert "SortMergeJoin" in joined and len(re.findall(r"Exchange hashpartitioning\(url", joined)) == 1 and joined.count("Sort [url") == 1
    assert "html" not in joined
    nodes.unpersist()


def test_growing_state_has_few_parts(spark):
    state = Growing(spark, "n long", "grown", spark.range(100, 102).toDF("n"))
    for i in range(3 * FAN_IN + 2):
        state.add(spark.range(i, i + 1).toDF("n"))
    assert [rank for rank, _ in state.parts] == [1, 1, 1, 0, 0]
    assert sorted(r["n"] for r in state.rows().collect()) == [*range(3 * FAN_IN + 2), 100, 101]
    assert Growing(spark, "n long", "grown").rows().count() == 0
