"""Exclusion rules as a sorted index of prefixes, searched by halving.

A rule is one text: its kind, the length and name of its parameter, and its value. A URL has one probe of that
form for itself, for its path and for the first value of each of its parameters; it is excluded if a rule is a prefix of a probe. Rules that
continue another rule are dropped first. Then no rule is a prefix of another one, and the only
rule that can be a prefix of a probe is the last one that is not greater. That one is found by halving.

The sorted rules are cut into pages, and the first rules of the pages form the upper level of the index. Few rules are one
page, a literal in the filter. Otherwise the upper level is the literal, every probe is joined with its page,
and searched there. Pages hold about the square root of all rules, so neither level is large.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.expr import column, filter_array, fresh, let, map_array, quote
from ..session import materialise
from .folds import fold
from .skew import ROWS_PER_TASK, hot_keys, split_join

RULE_SCHEMA = "kind string, param string, value string"
PAGE = 1000  # rules of a page, at least
INLINE_BYTES = 20_000  # of all rules together, for one literal
BROADCAST_BYTES = 32 << 20  # of all rules together; larger indexes are joined by shuffle


def _rule_text() -> Column:
    param = F.when(F.col("kind") == "param", F.coalesce("param", F.lit(""))).otherwise(F.lit(""))
    return F.concat("kind", F.length(param).cast("string"), F.lit(":"), param, "value")


def probes_sql(url: str) -> str:
    """The texts that a rule on this URL would be a prefix of."""

    def of_params(pairs: str) -> str:
        x, i, y = fresh(), fresh(), fresh()
        first = f"filter({pairs}, ({x}, {i}) -> NOT exists(slice({pairs}, 1, {i}), {y} -> {y}.name = {x}.name))"
        return map_array(first, lambda p: f"'param' || length({p}.name) || ':' || {p}.name || {p}.value")

    def of_parts(p: str) -> str:
        pairs = f"IF({p}.query <> '', {U.query_pairs_sql(f'{p}.query')}, cast(array() AS array<struct<name:string,value:string>>))"
        return f"concat(array('path0:' || {p}.path), {let(pairs, of_params)})"

    return let(url, lambda u: f"concat(array('url0:' || {u}), coalesce({let(U.url_parts_sql(u), of_parts)}, cast(array() AS array<string>)))")


def last_at_most_sql(keys: str, probe: str, longest: int) -> str:
    """Place of the last of the sorted ``keys`` (at most ``longest``) that is not greater, 0 if all are."""
    a, i = fresh(), fresh()
    halve = let(
        f"shiftright({a}.lo + {a}.hi + 1, 1)",
        lambda m: f"IF({a}.lo >= {a}.hi, {a}, IF(element_at({keys}, greatest({m}, 1)) <= {probe},"
        f" named_struct('lo', {m}, 'hi', {a}.hi), named_struct('lo', {a}.lo, 'hi', {m} - 1)))",
    )
    return f"aggregate(sequence(1, {max(1, longest.bit_length())}), named_struct('lo', 0, 'hi', size({keys})), ({a}, {i}) -> {halve}, {a} -> {a}.lo)"


def _begins_sql(keys: str, probe: str, longest: int) -> str:
    """True if one of the sorted keys, none a prefix of another, is a prefix of the probe."""
    return let(
        last_at_most_sql(keys, probe, longest),
        lambda at: f"coalesce({at} > 0 AND startswith({probe}, element_at({keys}, greatest({at}, 1))), false)",
    )


def shortest(rules: Iterable[str], before: str | None = None) -> list[str]:
    """Of sorted rules, those that do not continue another one, nor the one ``before`` them. What continues a rule stands right behind it."""
    kept: list[str] = []
    for rule in rules:
        if before is None or not rule.startswith(before):
            kept.append(rule)
            before = rule
    return kept


def _shortest_of_pages(pages: pa.Array) -> pa.Array:
    return pa.array((shortest(page) for page in pages.to_pylist()), pages.type)


def _without_longer(pages: DataFrame) -> DataFrame:
    """Pages (first, rules) of sorted rules without those that continue another one; a page may end up with none.

    Within a page that is one look at each rule. A rule of an earlier page can only be continued by the rules at the
    beginning of a page, the first one among them: so it is a beginning of a first rule, and looked up as such.
    """
    cut = materialise(fold(pages, lambda: _shortest_of_pages, ("rules",), "rules", pages.schema["rules"].dataType), "rule-pages")
    begins = cut.select("first", F.explode(F.expr("sequence(0, length(first) - 1)")).alias("n")).select(
        "first", F.expr("substring(first, 1, n)").alias("rule")
    ).where("length(first) > 0")
    # of a first rule's beginnings the shortest is a beginning of the others
    known = cut.select(F.explode("rules").alias("rule"))
    heads = begins.join(known, "rule").groupBy("first").agg(F.min("rule").alias("head"))
    kept = F.expr("IF(head IS NULL, rules, filter(rules, r -> NOT startswith(r, head)))")
    return cut.join(heads, "first", "left").select("first", kept.alias("rules"))


def exclude_urls(
    df: DataFrame,
    url: str,
    rules: DataFrame,
    inline_bytes: int = INLINE_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
    page: int = PAGE,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Drop URLs hit by a rule of the table (kind, param, value).

    ``url``: the URL starts with value. ``path``: its path starts with value.
    ``param``: the first value of query parameter ``param`` starts with value; blank values do not count.
    Prefixes are literal, an empty one hits everything of its kind. Rules without a value or of another kind do nothing. A NULL URL stays.

    What the driver reads is the rules themselves if they are few, and otherwise the first rule of every page.
    """
    texts = rules.where("value IS NOT NULL AND kind IN ('url', 'path', 'param')").select(_rule_text().alias("rule"))
    different = materialise(texts.distinct(), "rules")
    n_rules, n_bytes = different.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("rule")), F.lit(0))).first()
    if not n_rules:
        return df
    if n_bytes <= inline_bytes:
        few = shortest(sorted((r.rule for r in different.collect()), key=str.encode))
        hit = let(f"array({', '.join(map(quote, few))})", lambda k: f"exists({probes_sql(url)}, p -> {_begins_sql(k, 'p', n_rules)})")
        return df.where(~column(f"coalesce({hit}, false)"))

    page = max(page, math.isqrt(n_rules))
    # sorted over all parts, and numbered within a part: the number of a part stands above that of a row
    ordered = different.repartitionByRange("rule").sortWithinPartitions("rule")
    cut = (
        ordered.withColumn("page", F.floor(F.monotonically_increasing_id() / page))
        .groupBy("page")
        .agg(F.min("rule").alias("first"), F.sort_array(F.collect_list("rule")).alias("rules"))
        .select("first", "rules")
    )
    # a page without its first rule begins with the next one it has
    pages = materialise(
        _without_longer(cut).where("size(rules) > 0").select(F.expr("rules[0]").alias("first"), "rules"), "rule-pages"
    )
    firsts = sorted((r.first for r in pages.select("first").collect()), key=str.encode)
    upper = f"array({', '.join(map(quote, firsts))})"

    def placed(keys: str) -> str:
        found = map_array(
            probes_sql(url),
            lambda p: let(
                last_at_most_sql(keys, p, len(firsts)),
                lambda at: f"named_struct('first', IF({at} > 0, element_at({keys}, greatest({at}, 1)), NULL), 'probe', {p})",
            ),
        )
        return filter_array(found, lambda x: f"{x}.first IS NOT NULL")

    probes = df.select(url).distinct().select(F.col(url).alias("url"), F.inline(column(let(upper, placed))))
    if n_bytes <= broadcast_bytes:
        met = probes.join(F.broadcast(pages), "first")
    else:
        probes = materialise(probes, "probes")
        met = split_join(probes, pages, "first", "inner", hot_keys(probes, "first", rows_per_task), spread_by="url")
    hits = met.where(column(_begins_sql("rules", "probe", 2 * page))).select("url").distinct()
    return df.join(hits.select(F.col("url").alias(url)), url, "left_anti")
