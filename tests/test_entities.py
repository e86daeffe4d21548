"""Character references against the language's own decoder."""

from __future__ import annotations

import html as reference
from html.entities import html5

from pageloom.functions import html as H

TEXTS = [
    "a &amp; b", "&amp;lt; &amp;amp; &amp;eacute;", "&#38;lt; &#x26;amp;", "&lt;td&gt; &quot;q&quot; &apos;", "&eacute;&Eacute;&ouml;&ThickSpace;|",
    "&copy 2024 &copyright; &copy; &copy", "&notit; &notin; &not; &not", "&unknown; &x; & &; &&amp;", "&AMP;&LT;&GT", "&NotEqualTilde;&fjlig;&Tab;&NewLine;|",
    "&#8364;&#x20AC;&hellip;&nbsp;|", "&ampamp; &amplt;", "no reference", "", "&frac12;&frac12", "&sup1;&sup1a",
]


def decoded(spark, texts, **settings):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.selectExpr("i", f"{H.decode_entities_sql('t', **settings)} AS d").collect()
    return [r.d for r in sorted(rows)]


def test_texts_are_decoded_as_by_the_language(spark):
    assert decoded(spark, TEXTS) == [reference.unescape(t) for t in TEXTS]


def test_every_name(spark):
    texts = [f"x&{n} y" for n in html5]
    assert decoded(spark, texts) == [reference.unescape(t) for t in texts]


def test_addresses_keep_their_parameters(spark):
    texts = ["?a=1&copy=2&section=3&lt", "?a=1&amp;copy=2", "?x&eacute;=&notit", "&copy", "&copy;right"]
    assert decoded(spark, texts, in_attribute=True) == ["?a=1&copy=2&section=3<", "?a=1&copy=2", "?xé=&notit", "©", "©right"]
