"""Cheap ways for plain addresses, tags and texts give what the general ones give."""

import random

from pageloom.functions import html as H
from pageloom.functions import text as T
from pageloom.functions import urls as U
from pyspark.sql import functions as F


def _addresses(n: int) -> list[str | None]:
    rng = random.Random(11)
    pieces = ["http:", "https:", "//", "/", "www.", "a.com", "B.org", ":80", ".", "..", "/x_1", "~y", "#", "#f-1", "?q=1", ";p", "%41", " ", "\n", "é", "www./"]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 7))) for _ in range(n)]
    made += [f"{s}://{h}{p}{f}" for s in ("http", "https", "HTTP") for h in ("www.a.com", "a.com", "www.", "A.com:80", "")
             for p in ("", "/", "//", "/x", "/x/", "//x///", "/./x", "/x.y/z") for f in ("", "#", "#top", "\n", "#a#b")]
    made += [f"/{p}{q}{f}" for p in ("c", "~y/x_1", "-", "a//b") for q in ("", "/", "/z", "/.", ".x") for f in ("", "#", "#f-1", "#a#b")]
    return [*dict.fromkeys(made), "", None]


def test_plain_addresses(spark, monkeypatch):
    rows = spark.createDataFrame([(u,) for u in _addresses(3000)], "u string").repartition(8)
    bases = "array('https://www.a.com/s/v.jsp', 'ftp://a.com/x', 'a/b', '')"

    def columns(prefix):
        return [
            F.expr(U.url_parts_sql("u")).alias(f"{prefix}_parts"),
            F.expr(U.normalize_url_sql("u")).alias(f"{prefix}_normal"),
            F.expr(f"transform({bases}, b -> {U.resolve_url_sql('b', 'u')})").alias(f"{prefix}_resolved"),
        ]

    plain = columns("plain")
    for name in ("_PLAIN_PATH", "_PLAIN_URL", "_PLAIN_PAGE", "_ROOTED"):
        pattern = getattr(U, name)
        # the patterns do meet addresses, and then never match
        assert rows.where(F.col("u").rlike(pattern)).count() > 10
        monkeypatch.setattr(U, name, "(?!)" + pattern)
    both = rows.select("u", *plain, *columns("any")).collect()
    for kind in ("parts", "normal", "resolved"):
        assert [r.u for r in both if r[f"plain_{kind}"] != r[f"any_{kind}"]] == []


def test_plain_tags_and_texts(spark, monkeypatch):
    rng = random.Random(12)
    ends = ['"', "'", "", "&", " ", "=", ">", "x", "é", "/"]
    tags = [f'<{rng.choice(["a", "A", "img"])} {rng.choice(["href", "HREF", "data-href", "href "])}="{rng.choice(ends)}v{rng.choice(ends)}"{rng.choice(["", " ", "/", " href=2"])}>' for _ in range(600)]
    rows = spark.createDataFrame([(t,) for t in [*dict.fromkeys(tags), None]], "t string")
    lone = F.expr(H.attribute_sql("t", "href")).alias("lone")
    assert rows.where(F.col("t").rlike(H.LONE_ATTRIBUTE % "href")).count() > 5
    monkeypatch.setattr(H, "LONE_ATTRIBUTE", "(?!)()%s")
    found = rows.select("t", lone, F.expr(H.attribute_sql("t", "href")).alias("scanned")).collect()
    assert [r for r in found if r.lone != r.scanned] == []

    texts = ["", " ", "a  b", " a b ", "a\tb", "a\xa0b", "plain words", "a\x1cb ", None]
    texts = spark.createDataFrame([(t,) for t in texts], "t string").select(T.clean_text("t").alias("c")).collect()
    assert [r.c for r in texts] == ["", "", "a b", "a b", "a b", "a b", "plain words", "a b", ""]


def test_hidden_parts_make_tags(spark):
    html = "<i<!-- -->mg src='/i.png'><<script>x</script>a href='/f.p<style>y</style>df'>z</a>"
    rows = spark.createDataFrame([(html,), ("<b>no tags of these</b>",), (None,)], "html string")
    got = rows.select(H.image_sources("html").alias("i"), H.link_hrefs("html").alias("h")).collect()
    assert [tuple(r) for r in got] == [(["/i.png"], ["/f.pdf"]), ([], []), (None, None)]
