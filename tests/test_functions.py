"""Column functions: fixed cases and comparison with the standard library."""

from __future__ import annotations

import html as html_lib
import random
from urllib.parse import urljoin, urlparse

from pageloom.functions import html as H
from pageloom.functions import text as T
from pageloom.functions import urls as U
from pageloom.functions.expr import column, quote


def values(spark, rows, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*exprs).collect()]


def test_canonical_urls(spark):
    cases = {
        "http://www.A.com/X//?b=2&a=1&lang=en#f": "https://a.com/X?a=1&b=2",
        "http://www.www.a.com/": "https://www.a.com",
        "http://a.com:443/x?": "https://a.com:443/x",
        "http://a.com/p/;v=1?x=1": "https://a.com/p;v=1?x=1",
        "https://a.com/q?a=&b=1&c": "https://a.com/q?b=1",
        "https://a.com/q?a=1&a=0": "https://a.com/q?a=0&a=1",
        "https://a.com/q?q=a%26b&r=c+d": "https://a.com/q?q=a&b&r=c d",
        "https://a.com/q?z=100%25%&y=%zz%41": "https://a.com/q?y=%zzA&z=100%%",
        "//a.com/x": "https://a.com/x",
    }
    got = values(spark, [(u,) for u in cases], "url string", U.normalize_url("url"))
    assert [g[0] for g in got] == list(cases.values())
    assert values(spark, [(None,)], "url string", U.normalize_url("url")) == [(None,)]


def test_content_keys(spark):
    cases = {
        "https://a.com/v?idx=3&idx=4": "a.com/v?idx=4",
        "https://a.com/v?article_no=9&idx=1": "a.com/v?article_no=9",
        "https://a.com/v?x=1": "https://a.com/v?x=1",
    }
    got = values(spark, [(u,) for u in cases], "url string", U.content_key("url"))
    assert [g[0] for g in got] == list(cases.values())


def test_parts_and_joins_agree_with_the_standard_library(spark):
    rng = random.Random(7)
    bits = ["a", "b.c", "..", ".", "", "/", "//", "?q=1", "#f", ";p", "x y", "http:", "mailto:", "%41", "é", ":", "&", "=", "\t"]
    urls = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 6))) for _ in range(600)]
    bases = ["https://www.a.com/s/v.jsp", "http://a.com", "http://a.com/x/y/?q=1#z", "https://h:8/p;a=1/q;b"]
    rows = [(rng.choice(bases), u) for u in urls]
    got = values(spark, rows, "base string, url string", U.url_parts("url"), U.resolve_url("base", "url"))
    for (base, url), (parts, joined) in zip(rows, got):
        assert tuple(parts) == tuple(urlparse(url)), url
        assert joined == urljoin(base, url), (base, url)


def test_domain_scope(spark):
    hosts = {"a.com": True, "x.a.com": True, "A.com": True, "ba.com": False, "a.com:80": False, "a.com.org": False}
    got = values(spark, [(h,) for h in hosts], "h string", column(U.within_domain_sql("h", "'a.com'")))
    assert [g[0] for g in got] == list(hosts.values())


def test_text_forms(spark):
    cases = [(None, "", ""), ("A - B", "A - B", "a  b"), ("!!!", "!!!", ""), ("연세, é_1!", "연세, é_1!", "연세 é_1"), (" a　\n b ", "a b", "a b")]
    got = values(spark, [(c[0],) for c in cases], "t string", T.clean_text("t"), T.normalize_text("t"))
    assert got == [c[1:] for c in cases]


def test_stitch(spark):
    cases = [
        ("a b c d e z", "lead in a b c d e", "lead in a b c d e z"),
        ("x y a b c d e", "lead in a b c d e", "x y lead in a b c d e"),
        ("a b c d e z", "a b c d e", " a b c d e z"),
        ("a b c d e z", "q", "a b c d e z"),
        ("a b c", "a b c d e", "a b c"),
        ("a b c d e z", "", "a b c d e z"),
    ]
    got = values(spark, [c[:2] for c in cases], "a string, b string", T.stitch("a", "b"))
    assert [g[0] for g in got] == [c[2] for c in cases]


def test_stitch_against_brute_force(spark):
    def expected(a, b, n=5):
        words, text = a.split(), " ".join(b.split())
        for i in range(len(words) - n + 1):
            at = text.find(" ".join(words[i : i + n])) if text else -1
            if at >= 0:
                return " ".join(words[:i] + [text[:at].strip()] + words[i:])
        return " ".join(words)

    rng = random.Random(3)
    # few different, overlapping words: matches inside longer words occur
    pick = lambda k: " ".join(rng.choice(["a", "ab", "b", "ba", "aab"]) for _ in range(k))
    rows = [(pick(rng.randint(0, 12)), pick(rng.randint(0, 40))) for _ in range(400)]
    got = values(spark, rows, "a string, b string", T.stitch("a", "b"))
    assert [g[0] for g in got] == [expected(a, b) for a, b in rows]


def test_entities(spark):
    texts = ["a &amp; b", "&#44032;&#x41;", "&lt;p&gt; &amp;lt;", "&quot;&copy;&middot;", "&am", "100 & 1", "&#x1F600;"]
    got = values(spark, [(t,) for t in texts], "t string", H.decode_entities("t"))
    assert [g[0] for g in got] == [html_lib.unescape(t) for t in texts]


def test_attributes(spark):
    tag = """<a title="x > href=no" HREF='/q?a=1&amp;b=2' data-href="n" checked class=x>"""
    got = values(spark, [(tag,)], "t string", *[H.attribute("t", n) for n in ("href", "title", "checked", "src", "class")])
    assert got == [("/q?a=1&b=2", "x > href=no", "", None, "x")]


def test_links_skip_hidden_markup(spark):
    page = """<!-- <a href="no"> --><script>'<a href="no">'</script><a title="a>b" href="/y">t</a><a>n</a><A HREF=z>"""
    assert values(spark, [(page,)], "h string", H.link_hrefs("h")) == [(["/y", "z"],)]


def test_quote_round_trip(spark):
    text = "it's \\d \" \n ok"
    assert values(spark, [(1,)], "i int", column(quote(text)))[0][0] == text
