"""Markup columns: tags, attributes, entities and visible text blocks.

All functions work inside one row. Page-wide questions that need element
nesting are answered by windows in :mod:`pageloom.operators.markup`.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column

from .expr import column, filter_array, fresh, let, map_array, quote
from .text import WHITESPACE, clean_text_sql

# Markup patterns. Quoted attribute values may contain '>', so
# they are matched as units; possessive groups keep matching linear.
HIDDEN_MARK = r"<!--|<script|<style"
REMOVED = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
TAG = r"(?s)</?[A-Za-z](?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>|</?[A-Za-z][^>]*>"
TOKEN = TAG + r"|<[!?][^>]*>|[^<]+|<"
LONE_ATTRIBUTE = r"(?i)^<[a-z][a-z0-9]*+ +%s=\"([!#-%%(-;=?-~]*+)\">\z"  # without quotes or references in its value
ATTRIBUTE = r"(?s)(?<=[\s\"'/])([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]*))?"

# Elements without content, and elements that end a text block.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
)
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main",
    "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul",
)

# Named character references come from the language's own table. Frequent ones stand first, as Spark looks
# through a map from its start.
_FREQUENT = ("amp", "nbsp", "lt", "gt", "quot", "apos", "copy", "middot", "hellip", "ndash", "mdash", "rsquo", "laquo", "raquo")
_KEY, _END = "\x01", "\x02"
_NAMES = {n[:-1]: v for n, v in html5.items() if n.endswith(";")}


def _named_map_sql() -> str:
    """Map from name to characters, one literal."""
    ordered = [*_FREQUENT, *sorted(set(_NAMES) - set(_FREQUENT))]
    listed = _END.join(f"{n}{_KEY}{_NAMES[n]}" for n in ordered)
    return f"str_to_map({quote(listed)}, {quote(_END)}, {quote(_KEY)})"


NAMED = _named_map_sql()
# names that are also known without a semicolon, the longest first
SHORT = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))

# Addresses that are files, addresses that are images.
FILE_HREF = r"(?i)\.pdf|\.doc|\.xls|\.zip|\.hwp|download"
IMAGE_URL = r"(?i)\.(jpg|jpeg|png|gif|bmp|svg|webp|tiff|ico)$"

# Markers used while text blocks are cut; never part of text.
TEXT_MARKS = _BREAK, _LINK_ON, _LINK_OFF = "\ufdd1", "\ufdd2", "\ufdd3"


def decode_entities_sql(e: str, in_attribute: bool = False) -> str:
    """Replace all named and numeric character references.

    ``e`` is used several times, so it should be a name. Text without ``&``
    (nearly all of it) is passed on untouched. A name without semicolon counts if it is one of those that may
    lack it; in an attribute only if neither ``=`` nor a letter or digit follows, as in addresses.
    """

    def char(code: str) -> str:
        # neither surrogates nor the code points used as marks
        valid = f"({code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 64975 OR {code} BETWEEN 65008 AND 1114111)"
        return f"decode(unhex(lpad(hex(IF({valid}, {code}, 65533)), 8, '0')), 'UTF-32')"

    def numeric(ref: str) -> str:
        digits = f"regexp_extract({ref}, '([0-9a-fA-F]+)', 1)"
        return let(f"cast(conv({digits}, IF(rlike({ref}, '[xX]'), 16, 10), 10) AS int)", char)

    def named(ref: str, names: str) -> str:
        def begins(short_name: str) -> str:
            return f"coalesce(element_at({names}, {short_name}) || substr({ref}, length({short_name}) + 2), {ref})"

        begun = let(f"regexp_extract({ref}, {quote(f'^&({SHORT})')}, 1)", begins)
        if in_attribute:
            begun = f"IF(endswith({ref}, ';'), {ref}, {begun})"
        return f"coalesce(element_at({names}, regexp_extract({ref}, '^&([A-Za-z0-9]+);$', 1)), {begun})"

    name = f"[A-Za-z][A-Za-z0-9]*+;|(?:{SHORT})(?![=A-Za-z0-9;])" if in_attribute else "[A-Za-z][A-Za-z0-9]*+;?"
    pieces = f"regexp_extract_all({e}, {quote(f'&(?:#(?:[0-9]{{1,7}}|[xX][0-9a-fA-F]{{1,6}});|{name})|[^&]+|&')}, 0)"

    def joined(names: str) -> str:
        decoded = map_array(
            pieces,
            lambda p: f"CASE WHEN NOT startswith({p}, '&') OR {p} = '&' THEN {p} WHEN startswith({p}, '&#') THEN {numeric(p)}"
            f" ELSE {named(p, names)} END",
        )
        return f"array_join({decoded}, '')"

    # frequent names alone need no map: none of their characters can begin another reference, but &, which comes last
    simple = e
    for frequent in (*_FREQUENT[1:], _FREQUENT[0]):
        simple = f"replace({simple}, '&{frequent};', {quote(_NAMES[frequent])})"
    other = quote(f"&(?!(?:{'|'.join(_FREQUENT)});)[A-Za-z#]")
    # otherwise one pass over the pieces, so nothing is decoded twice; the map is bound once per text
    return f"CASE WHEN NOT contains({e}, '&') THEN {e} WHEN NOT rlike({e}, {other}) THEN {simple} ELSE {let(NAMED, joined)} END"


def without_hidden_sql(html: str, instead: str = "") -> str:
    """Markup without comments, scripts and style sheets."""
    # to see that there are none is cheaper than to look for their ends
    return let(
        html,
        lambda h: f"IF(rlike({h}, {quote(f'(?i){HIDDEN_MARK}')}), regexp_replace({h}, {quote(REMOVED)}, {quote(instead)}), {h})",
    )


def token_array_sql(html: str, instead: str = "") -> str:
    """All tags and text runs of a page, in order. With ``<!>`` in place of hidden parts these end a text run."""
    return f"regexp_extract_all({without_hidden_sql(html, instead)}, {quote(TOKEN)}, 0)"


def tags_named_sql(html: str, name: str) -> str:
    """Opening tags of one element, in order."""
    wanted = quote(rf"(?i)^<{name}(?=[\s/>])")

    def tags(h: str) -> str:
        found = f"regexp_extract_all({without_hidden_sql(h)}, {quote(TAG)}, 0)"
        # a tag that is not there as written can only be made by taking out what is hidden
        possible = quote(rf"(?i)<{name}[\s/>]|{HIDDEN_MARK}")
        none = f"IF({h} IS NULL, NULL, cast(array() AS array<string>))"
        return f"IF(rlike({h}, {possible}), {filter_array(found, lambda t: f'rlike({t}, {wanted})')}, {none})"

    return let(html, tags)


def attribute_sql(tag: str, name: str) -> str:
    """Decoded value of an attribute: the last one if repeated, "" if it has
    no value, NULL if absent."""

    def scan(t: str) -> str:
        pairs = filter_array(
            f"regexp_extract_all({t}, {quote(ATTRIBUTE)}, 0)",
            lambda p: f"rlike({p}, {quote(rf'(?is)^{name}(\s*=.*)?$')})",
        )
        return let(f"try_element_at({pairs}, -1)", value)

    def value(pair: str) -> str:
        raw = f"regexp_extract({pair}, {quote(r'(?s)^[^=]*=\s*(.*)$')}, 1)"
        quotes = quote("^[\"']|[\"']$")
        bare = f"regexp_replace({raw}, {quotes}, '')"
        return f"IF({pair} IS NOT NULL, {let(bare, lambda v: decode_entities_sql(v, in_attribute=True))}, NULL)"

    # cheap tests spare the scan for the many tags without the attribute, or with no other one
    lone = quote(LONE_ATTRIBUTE % name)
    return let(
        tag,
        lambda t: f"CASE WHEN NOT contains(lower({t}), {quote(name)}) THEN NULL"
        f" WHEN rlike({t}, {lone}) THEN regexp_extract({t}, {lone}, 1) ELSE {scan(t)} END",
    )


def link_hrefs_sql(html: str) -> str:
    """``href`` of every anchor that has one, in order, duplicates kept."""
    return filter_array(
        map_array(tags_named_sql(html, "a"), lambda t: attribute_sql(t, "href")), lambda h: f"{h} IS NOT NULL"
    )


def image_sources_sql(html: str) -> str:
    """Address of every image: ``src``, else ``data-src``, else ``data-original``."""

    def source(tag: str) -> str:
        options = [f"nullif({attribute_sql(tag, name)}, '')" for name in ("src", "data-src", "data-original")]
        return f"coalesce({', '.join(options)})"

    return filter_array(map_array(tags_named_sql(html, "img"), source), lambda s: f"{s} IS NOT NULL")


def block_array_sql(html: str) -> str:
    """Visible text blocks: array of struct(text, n_words, n_link_words).

    A block ends at every block-level tag, open or close, so unclosed
    paragraphs do no harm. Words inside anchors count as link words.
    """
    marked = without_hidden_sql(html)
    for mark in (_BREAK, _LINK_ON, _LINK_OFF):
        marked = f"replace({marked}, {quote(mark)}, '')"
    for pattern, mark in (
        (r"(?is)<head\b.*?</head\s*>", ""),
        (r"(?is)</?(?:" + "|".join(BLOCK_TAGS) + r")(?=[\s/>])[^>]*>", _BREAK),
        (r"(?i)<a(?=[\s/>])[^>]*>", _LINK_ON),
        (r"(?i)</a\s*>", _LINK_OFF),
        (r"<[/!?A-Za-z][^>]*>", ""),
    ):
        marked = f"regexp_replace({marked}, {quote(pattern)}, {quote(mark)})"

    def word_count(text: str) -> str:
        return f"IF({text} = '', 0, size(split({text}, ' ')))"

    def describe(raw: str) -> str:
        plain = clean_text_sql(let(f"replace(replace({raw}, {quote(_LINK_ON)}, ''), {quote(_LINK_OFF)}, '')", decode_entities_sql))
        links = f"regexp_extract_all({raw}, {quote(f'{_LINK_ON}([^{_LINK_ON}{_LINK_OFF}]*)')}, 1)"
        linked = clean_text_sql(let(f"array_join({links}, ' ')", decode_entities_sql))
        return let(
            f"named_struct('t', {plain}, 'l', IF(contains({raw}, {quote(_LINK_ON)}), {linked}, ''))",
            lambda b: f"named_struct('text', {b}.t, 'n_words', {word_count(f'{b}.t')}, 'n_link_words', {word_count(f'{b}.l')})",
        )

    # tags that follow each other leave nothing between them
    pieces = filter_array(f"split({marked}, {quote(_BREAK)})", lambda raw: f"{raw} <> ''")
    return filter_array(map_array(pieces, describe), lambda b: f"{b}.text <> ''")


def select_text_sql(blocks: str, max_link_share: float, min_words: int) -> str:
    """Text of the blocks that are long enough and not mostly links."""
    kept = filter_array(
        blocks,
        lambda b: f"{b}.n_words >= {min_words} AND {b}.n_link_words <= {b}.n_words * {max_link_share}D",
    )
    return f"array_join({map_array(kept, lambda b: f'{b}.text')}, ' ')"


def split_whitespace_sql(e: str) -> str:
    """Pieces between whitespace runs, empty ones included."""
    return let(e, lambda t: f"IF(rlike({t}, '[^!-~]'), split({t}, {quote(WHITESPACE + '+')}, -1), array({t}))")


# --- the same inside the folds, where a tag or text that is repeated is read once per batch ---

_REFERENCE = r"&(?:#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});|%s)"
_TEXT_REFERENCE = re.compile(_REFERENCE % "[A-Za-z][A-Za-z0-9]*+;?")
_ATTRIBUTE_REFERENCE = re.compile(_REFERENCE % f"(?:[A-Za-z][A-Za-z0-9]*+;|(?:{SHORT})(?![=A-Za-z0-9;]))")
_SHORT_NAME = re.compile(SHORT)
_ATTRIBUTE = re.compile(ATTRIBUTE, re.ASCII)
_QUOTES = re.compile("^[\"']|[\"']$")


def _referred(found: re.Match, in_attribute: bool) -> str:
    ref = found[0]
    if ref[1] == "#":
        code = int(ref[3:-1], 16) if ref[2] in "xX" else int(ref[2:-1])
        valid = 1 <= code <= 55295 or 57344 <= code <= 64975 or 65008 <= code <= 1114111
        return chr(code if valid else 65533)
    if ref.endswith(";"):
        known = _NAMES.get(ref[1:-1])
        if known is not None or in_attribute:
            return ref if known is None else known
    short = _SHORT_NAME.match(ref, 1)
    return _NAMES[short[0]] + ref[short.end() :] if short else ref


def decoded(text: str, in_attribute: bool = False) -> str:
    """:func:`decode_entities_sql` of one text."""
    if "&" not in text:
        return text
    return (_ATTRIBUTE_REFERENCE if in_attribute else _TEXT_REFERENCE).sub(lambda m: _referred(m, in_attribute), text)


def attributes(tag: str, names: Sequence[str]) -> list[str | None]:
    """:func:`attribute_sql` of one tag, for several names."""
    found = dict.fromkeys(names)
    for pair in _ATTRIBUTE.finditer(tag):
        name = pair[1].lower()
        if name in found and pair[1].isascii():
            found[name] = decoded(_QUOTES.sub("", pair[2] or ""), in_attribute=True)
    return list(found.values())


# --- the same as Columns -------------------------------------------------------


def decode_entities(e: str) -> Column:
    return column(decode_entities_sql(e))


def token_array(html: str) -> Column:
    return column(token_array_sql(html))


def attribute(tag: str, name: str) -> Column:
    return column(attribute_sql(tag, name))


def link_hrefs(html: str) -> Column:
    return column(link_hrefs_sql(html))


def image_sources(html: str) -> Column:
    return column(image_sources_sql(html))


def block_array(html: str) -> Column:
    return column(block_array_sql(html))
