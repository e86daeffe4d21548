"""License scan by diagonal voting.

Every text and every license template is a list of words. The hashes of all rolling word k-grams
of the texts are joined with those of the templates; a hit at text position p and template position q lies on
the diagonal p - q. Votes are counted per diagonal. Neighbouring diagonals, which come from
inserted or missing words, are merged into one span, and every span is verified: the text's own words
are compared with the template's, and the share of the template that really stands there is its score.

Short templates (phrases) are joined by 2-grams and have to be there word by word; so each
of their places is a span of its own.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import store

GRAM = 4  # words of a gram: two neighbouring phrase grams
PHRASE_GRAM = 2  # the same for templates below LONG words
LONG = 8
SLACK = 12  # words by which neighbouring diagonals may differ
LEAST_SHARE = 0.6  # of a template's words
BROADCAST_ROWS = 1_000_000  # more documents with spans, or grams of templates, than this are joined by shuffle
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template(NamedTuple):
    label: str
    text: str
    base: bool = False


# fixed values: the phrases that base labels are defined by, and notices by which works are commonly put under a license
TEMPLATES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("agpl", "GNU Affero General Public License"),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ),
    Template("bsd", "BSD license"),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    Template("mpl", "Mozilla Public License"),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    Template("cc-by", "under CC BY 4.0"),
    Template("cc-by-sa", "under CC BY-SA"),
    Template("cc-by-nc", "under CC BY-NC"),
    Template("cc-by-nd", "under CC BY-ND"),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike"),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial"),
    Template("all-rights-reserved", "all rights reserved"),
)


def words_of(text: Column) -> Column:
    """Words in lower case (A-Z only); no words for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN_WORDS, -1), "")


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _paired(hashes: Column, step: int) -> Column:
    """The hash of each element and the one ``step`` behind it, where there is one."""
    both = F.transform(hashes, lambda x, i: F.xxhash64(F.lit(step), x, F.get(hashes, i + step)))
    return F.slice(both, F.lit(1), F.greatest(F.size(hashes) - step, F.lit(0)))


def _grams(words: Column, lengths: list[int]) -> Column:
    """The hashes of all rolling grams of each length, one list per length."""

    def rolled(single: Column) -> Column:
        return _bound(
            _paired(single, 1),
            lambda double: F.array(*[{1: single, PHRASE_GRAM: double, GRAM: _paired(double, PHRASE_GRAM)}[n] for n in lengths]),
        )

    return _bound(F.transform(words, lambda w: F.xxhash64(w)), rolled)


def _gram_rows(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """The other columns with pos and hash: one row per gram."""
    others = [c for c in rows.columns if c != "words"]
    listed = rows.select(*others, _grams(F.col("words"), lengths).alias("grams"))
    # where the list of each length begins in the row of all lists
    begins = [sum((F.size(F.get("grams", F.lit(k))) for k in range(i)), F.lit(0)) for i in range(len(lengths))]
    every = listed.select(*others, *[b.alias(f"begin_{i}") for i, b in enumerate(begins)], F.posexplode(F.flatten("grams")).alias("at", "hash"))
    begin = F.greatest(F.lit(0), *[F.when(F.col("at") >= F.col(f"begin_{i}"), F.col(f"begin_{i}")) for i in range(len(lengths))])
    return every.select(*others, (F.col("at") - begin).alias("pos"), "hash")


def _gram_length(n_words: Column | int):
    if isinstance(n_words, int):
        return min(PHRASE_GRAM, n_words) if n_words < LONG else GRAM
    return F.when(n_words >= LONG, GRAM).otherwise(F.least(F.lit(PHRASE_GRAM), n_words))


def template_words(spark: SparkSession, templates: tuple[Template, ...]) -> list[list[str]]:
    """The words of every template, cut by the same expression as the texts."""
    table = spark.createDataFrame([(i, t.text) for i, t in enumerate(templates)], "template int, text string")
    found = dict(table.select("template", words_of(F.col("text")).alias("words")).collect())
    return [found[i] for i in range(len(templates))]


def _template_grams(spark: SparkSession, words: list[list[str]]) -> DataFrame:
    """template, tpos, hash; broadcast if it is proven small."""
    table = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "template int, words array<string>")
    parts = [
        _gram_rows(table.where(_gram_length(F.size("words")) == n), [n]) for n in sorted({_gram_length(len(w)) for w in words if w})
    ]
    grams = parts[0]
    for part in parts[1:]:
        grams = grams.unionByName(part)
    grams = grams.withColumnRenamed("pos", "tpos")
    return F.broadcast(grams) if sum(map(len, words)) <= BROADCAST_ROWS else grams


def diagonals(rows: DataFrame, words: list[list[str]]) -> DataFrame:
    """(row, words) -> row, template, diagonal, first, last, votes: the first and last
    template position that a hit on the diagonal covers."""
    lengths = sorted({_gram_length(len(w)) for w in words if w})
    grams = _gram_rows(rows.select("row", "words"), lengths)
    of_template = F.element_at(F.lit([_gram_length(len(w)) for w in words]), F.col("template") + 1)
    return (
        grams.join(_template_grams(rows.sparkSession, words), "hash")
        .groupBy("row", "template", (F.col("pos") - F.col("tpos")).alias("diagonal"))
        .agg(F.min("tpos").alias("first"), F.max("tpos").alias("last"), F.count(F.lit(1)).alias("votes"))
        .withColumn("last", F.col("last") + of_template - 1)
    )


def merged(found: DataFrame, words: list[list[str]], slack: int = SLACK) -> DataFrame:
    """One row per span: row, template, votes, and its diagonals. Diagonals of a long
    template that are at most ``slack`` apart are one span."""
    apart = F.lit([slack if len(w) >= LONG else 0 for w in words])
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > F.element_at(apart, F.col("template") + 1), F.lit(True))
    return (
        found.withColumn("opens", opens.cast("int")).withColumn("span", F.sum("opens").over(order))
        .groupBy("row", "template", "span")
        .agg(F.sum("votes").alias("votes"), F.sort_array(F.collect_list(F.struct("diagonal", "first", "last"))).alias("diagonals"))
    )


def _verified(words: Column, span: Column, expected: Column) -> Column:
    """start, end (words of the text) and share of the template's words that stand on the span's diagonals."""
    there = F.transform(
        span["diagonals"],
        lambda d: F.struct(
            F.filter(
                F.sequence(d["first"], d["last"]),
                lambda j: F.get(words, d["diagonal"] + j) == F.get(expected, j),
            ).alias("places"),
            d["diagonal"].alias("diagonal"),
        ),
    )

    def read(found: Column) -> Column:
        places = F.flatten(F.transform(found, lambda f: F.transform(f["places"], lambda j: f["diagonal"] + j)))
        covered = F.array_distinct(F.flatten(F.transform(found, lambda f: f["places"])))
        return F.struct(
            span["template"].alias("template"),
            F.array_min(places).alias("start"), (F.array_max(places) + 1).alias("end"),
            (F.size(covered) / F.size(expected)).alias("share"),
            span["votes"].alias("votes"),
        )

    return F.get(F.transform(F.array(there), read), F.lit(0))


def _joined_labels(spans: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def scan(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_share: float = LEAST_SHARE,
    slack: int = SLACK,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per input row: id, n_words, spans, base_labels, labels, score.

    ``spans`` has template, label, base, start, end, share and votes of every verified span, in order of its
    words: all words of a phrase (templates below LONG words), at least ``least_share`` of the words of a long
    template. ``labels`` are the distinct labels of all spans, ``base_labels`` those of base templates,
    sorted and joined by commas. ``score`` is the best share of any span, 0 without one. Null and
    empty texts have no words and no spans. Every row is scanned on its own, so rows that repeat an id keep a row each. Templates
    without a word find nothing.
    """
    spark = docs.sparkSession
    words = template_words(spark, templates)
    rows = store(
        docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col).cast("string")).alias("words")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "scanned-words",
    )
    spans = store(merged(diagonals(rows, words), words, slack), "license-spans")
    # a document's spans stand beside its words and are never more than these
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("template", "votes", "diagonals")).alias("found"))
    hit = spans.select("row").distinct()
    if hit.limit(broadcast_rows + 1).count() <= broadcast_rows:
        hit = F.broadcast(hit)
    expected, labels = F.lit(words), F.lit([t.label for t in templates])
    needed = F.lit([least_share if len(w) >= LONG else 1.0 for w in words])

    def at(table: Column, span: Column) -> Column:
        return F.element_at(table, span["template"] + 1)

    verified = F.transform("found", lambda s: _verified(F.col("words"), s, at(expected, s)))
    kept = F.filter(verified, lambda s: s["share"] >= at(needed, s))
    named = F.transform(
        kept,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["template"].alias("template"), at(labels, s).alias("label"),
            at(F.lit([t.base for t in templates]), s).alias("base"), s["share"].alias("share"), s["votes"].alias("votes"),
        ),
    )
    # only the words of documents with spans move
    checked = rows.select("row", "words").join(hit, "row", "left_semi").join(by_row, "row").select("row", F.sort_array(named).alias("spans"))
    out = rows.select("row", "id", F.size("words").cast("long").alias("n_words")).join(checked, "row", "left")
    none = F.array().cast(checked.schema["spans"].dataType)
    return out.withColumn("spans", F.coalesce("spans", none)).select(
        "id", "n_words", "spans",
        _joined_labels(F.filter("spans", lambda s: s["base"])).alias("base_labels"),
        _joined_labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )


def places(scanned: DataFrame) -> DataFrame:
    """Add n_base, first_word and last_word: number, smallest and largest start of the spans of base templates."""
    starts = F.transform(F.filter("spans", lambda s: s["base"]), lambda s: s["start"].cast("long"))
    return scanned.withColumns(
        {"n_base": F.size(starts).cast("long"), "first_word": F.array_min(starts), "last_word": F.array_max(starts)}
    )
