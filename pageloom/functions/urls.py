"""URL columns: split, canonical form, content key, relative resolution.

Everything is row-local and made of built-in functions, so these columns never
cause a shuffle and can be used below filters and joins. Arguments are SQL
expressions, usually column names.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column

from .expr import column, filter_array, fresh, let, map_array, quote, quoted_list

# Query parameters that never identify a page, parameters that
# do (in order of preference), and the generic-syntax scheme families.
DROP_PARAMS = ("ddx", "hID", "sdx", "SFIELD", "XT", "lang")
ID_PARAMS = ("bidx", "article_no", "idx")
SCHEMES_WITH_PARAMS = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu",
    "sip", "sips", "mms", "sftp", "tel",
)
SCHEMES_WITH_RELATIVE = (
    "", "ftp", "http", "gopher", "nntp", "wais", "imap", "file", "https", "shttp", "mms",
    "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)

# RFC 3986 appendix B, with the scheme restricted to legal scheme characters.
URI_PATTERN = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
)
# Plain forms, as most addresses have: nothing to clean, decode or drop but a fragment. They are taken apart without the
# pattern above. Loops over single characters only, which need no stack however long the address.
_PLAIN_PATH = r"^(?!//)([A-Za-z0-9_~./-]*+)(?:#([A-Za-z0-9_-]*+))?\z"
_ROOTED = r"^/[A-Za-z0-9_~-][A-Za-z0-9_~/-]*+(?:#[A-Za-z0-9_-]++)?\z"  # a path without dots
_PLAIN_URL = r"^(https?)://([A-Za-z0-9.-]++)((?:/[A-Za-z0-9_~./-]*+)?)(?:#([A-Za-z0-9_-]*+))?\z"
_PLAIN_PAGE = r"^https?://(?:www\.)?+([a-z0-9.-]++(?:/[A-Za-z0-9_~./-]*(?<!/))?)/*+(?:#[A-Za-z0-9_-]*+)?\z"
# A code point that is no character, and is removed from URLs; separates the matched groups.
_CUT = "\ufdd0"


def url_parts_sql(e: str) -> str:
    """struct(scheme, netloc, path, params, query, fragment); never fails.

    Absent parts are "". ``;params`` belong to the last path segment. NULL in,
    NULL out.
    """

    def split(u: str) -> str:
        def group(pattern: str, i: int) -> str:
            return f"regexp_extract({u}, {quote(pattern)}, {i})"

        def plain(pattern: str, scheme: str, netloc: str, path: int) -> str:
            fragment = f"IF(contains({u}, '#'), {group(pattern, path + 1)}, '')"
            return (
                f"named_struct('scheme', {scheme}, 'netloc', {netloc}, 'path', {group(pattern, path)},"
                f" 'params', '', 'query', '', 'fragment', {fragment})"
            )

        return (
            f"CASE WHEN {u} IS NULL THEN NULL"
            f" WHEN rlike({u}, {quote(_PLAIN_PATH)}) THEN {plain(_PLAIN_PATH, quote(''), quote(''), 1)}"
            f" WHEN rlike({u}, {quote(_PLAIN_URL)}) THEN {plain(_PLAIN_URL, group(_PLAIN_URL, 1), group(_PLAIN_URL, 2), 3)}"
            f" ELSE {_any_url_parts_sql(u)} END"
        )

    return let(e, split)


def _any_url_parts_sql(e: str) -> str:
    url = rf"regexp_replace(regexp_replace({e}, '^[\\x00-\\x20]+', ''), '[\\t\\r\\n{_CUT}]', '')"
    marks = _CUT.join(f"${i}" for i in range(1, 6))
    groups = f"split(regexp_replace({url}, {quote(URI_PATTERN)}, {quote(marks)}), {quote(_CUT)}, -1)"

    def build(g: str) -> str:
        scheme, path = f"lower({g}[0])", f"{g}[2]"
        has_params = f"contains({path}, ';') AND {scheme} IN ({quoted_list(SCHEMES_WITH_PARAMS)})"
        # text after the first ';' of the last segment
        params = f"regexp_extract({path}, '(?s)^(?:.*/)?[^/;]*;([^/]*)$', 1)"
        before = f"regexp_extract({path}, '(?s)^((?:.*/)?[^/;]*)', 1)"
        return (
            f"named_struct('scheme', {scheme}, 'netloc', {g}[1], 'path', IF({has_params}, {before}, {path}),"
            f" 'params', IF({has_params}, {params}, ''), 'query', {g}[3], 'fragment', {g}[4])"
        )

    return let(groups, build)


def join_parts_sql(scheme: str, netloc: str, path: str, params: str, query: str, fragment: str) -> str:
    """Inverse of :func:`url_parts_sql`."""

    def body(target: str) -> str:
        rooted = f"IF({target} <> '' AND NOT startswith({target}, '/'), '/' || {target}, {target})"
        return (
            f"CASE WHEN {netloc} <> '' THEN '//' || {netloc} || {rooted}"
            f" WHEN startswith({target}, '//') THEN '//' || {target}"
            f" WHEN {scheme} <> '' AND {scheme} IN ({quoted_list(SCHEMES_WITH_RELATIVE)})"
            f" AND ({target} = '' OR startswith({target}, '/')) THEN '//' || {target} ELSE {target} END"
        )

    target = f"{path} || {_prefixed(';', params)}"
    return (
        f"concat(IF({scheme} <> '', {scheme} || ':', ''), {let(target, body)},"
        f" {let(query, lambda q: _prefixed('?', q))}, {_prefixed('#', fragment)})"
    )


def _prefixed(mark: str, text: str) -> str:
    return f"IF({text} <> '', {quote(mark)} || {text}, '')"


def decode_component_sql(e: str) -> str:
    """Form decoding: ``+`` is a space, ``%xx`` is a UTF-8 byte; a ``%`` that
    starts no valid escape stays as it is."""
    return f"try_url_decode(regexp_replace({e}, '%(?![0-9A-Fa-f]{{2}})', '%25'))"


def query_pairs_sql(query: str) -> str:
    """Decoded (name, value) pairs in URL order; pairs without a value vanish."""
    kept = filter_array(f"split({query}, '&')", lambda s: f"rlike({s}, '(?s)^[^=]*=.')")
    name = lambda s: decode_component_sql(f"substring_index({s}, '=', 1)")
    value = lambda s: decode_component_sql(f"regexp_replace({s}, '^[^=]*=', '')")
    return map_array(kept, lambda s: f"named_struct('name', {name(s)}, 'value', {value(s)})")


def normalize_url_sql(e: str, drop_params: Sequence[str] = DROP_PARAMS) -> str:
    """Canonical form of a URL.

    https, lower-case host without one leading ``www.``, no trailing slashes,
    parameters decoded, filtered by ``drop_params``, sorted and written back
    without encoding, no fragment. Decoded ``&`` makes the result ambiguous, so
    it is not idempotent there.
    """

    def query_text(query: str) -> str:
        pairs = query_pairs_sql(query)
        if drop_params:
            pairs = filter_array(pairs, lambda p: f"{p}.name NOT IN ({quoted_list(drop_params)})")
        shown = map_array(f"array_sort({pairs})", lambda p: f"{p}.name || '=' || {p}.value")
        return f"IF({query} = '', '', array_join({shown}, '&'))"

    def build(p: str) -> str:
        host = rf"regexp_replace(lower({p}.netloc), '^www\\.', '')"
        path = f"regexp_replace({p}.path, '/+$', '')"
        return join_parts_sql("'https'", host, path, f"{p}.params", query_text(f"{p}.query"), "''")

    plain = quote(_PLAIN_PAGE)
    return let(
        e,
        lambda u: f"IF(rlike({u}, {plain}), 'https://' || regexp_extract({u}, {plain}, 1), {let(url_parts_sql(u), build)})",
    )


def content_key_sql(
    e: str, id_params: Sequence[str] = ID_PARAMS, drop_params: Sequence[str] = DROP_PARAMS
) -> str:
    """Identity of the content behind a canonical URL.

    The first of ``id_params`` that is present gives ``host/path?name=value``
    (last value if repeated); otherwise the canonical URL itself.
    """

    def keyed(p: str) -> str:
        def choose(pairs: str) -> str:
            options = []
            for name in id_params:
                values = filter_array(pairs, lambda x: f"{x}.name = {quote(name)}")
                last = f"try_element_at({values}, -1).value"
                options.append(f"{p}.netloc || {p}.path || {quote(f'?{name}=')} || {last}")
            return f"coalesce({', '.join([*options, 'NULL'])})"

        return f"IF({p}.query <> '', {let(query_pairs_sql(f'{p}.query'), choose)}, NULL)"

    return f"coalesce({let(url_parts_sql(e), keyed)}, {normalize_url_sql(e, drop_params)})"


def query_value_sql(e: str, name: str) -> str:
    """First value of one query parameter, NULL if absent or blank."""

    def first(p: str) -> str:
        hits = filter_array(query_pairs_sql(f"{p}.query"), lambda x: f"{x}.name = {quote(name)}")
        return f"IF({p}.query <> '', get({hits}, 0).value, NULL)"

    return let(url_parts_sql(e), first)


def _merged_path(base_path: str, path: str) -> str:
    folder = f"IF({base_path} = '', '/', regexp_replace({base_path}, '[^/]*$', ''))"
    joined = f"IF(startswith({path}, '/'), {path}, regexp_replace({folder} || {path}, '/{{2,}}', '/'))"

    def without_dots(text: str) -> str:
        acc, seg = fresh(), fresh()
        kept = (
            f"aggregate(split({text}, '/'), cast(array() AS array<string>), ({acc}, {seg}) -> CASE {seg}"
            f" WHEN '..' THEN slice({acc}, 1, greatest(size({acc}) - 1, 0)) WHEN '.' THEN {acc}"
            f" ELSE concat({acc}, array({seg})) END)"
        )
        tail = rf"IF(rlike({text}, '(^|/)\\.\\.?$'), array(''), cast(array() AS array<string>))"
        return f"array_join(concat({kept}, {tail}), '/')"

    def finish(text: str) -> str:
        # most paths have no dot segments
        return rf"IF(rlike({text}, '(^|/)\\.\\.?(/|$)'), {without_dots(text)}, {text})"

    return let(let(joined, finish), lambda t: f"IF({t} = '', '/', {t})")


def resolve_from_sql(base: str, base_parts: str, href: str) -> str:
    """Absolute form of ``href`` when the base has already been split.

    Use this when many hrefs share one base: ``base_parts`` is
    ``url_parts(base)`` computed once per page.
    """
    b = base_parts

    def build(h: str) -> str:
        scheme = f"IF({h}.scheme = '', {b}.scheme, {h}.scheme)"
        foreign = f"{scheme} <> {b}.scheme OR {scheme} NOT IN ({quoted_list(SCHEMES_WITH_RELATIVE)})"
        in_document = f"{h}.netloc = '' AND {h}.path = '' AND {h}.params = ''"
        # everything but the path is chosen part by part, so the URL is put together once
        netloc = f"IF({h}.netloc <> '', {h}.netloc, {b}.netloc)"
        path = (
            f"CASE WHEN {h}.netloc <> '' THEN {h}.path WHEN {in_document} THEN {b}.path"
            f" ELSE {_merged_path(f'{b}.path', f'{h}.path')} END"
        )
        params = f"IF({in_document}, {b}.params, {h}.params)"
        query = f"IF({in_document} AND {h}.query = '', {b}.query, {h}.query)"
        made = let(
            f"named_struct('s', {scheme}, 'n', {netloc}, 'p', {path}, 'a', {params}, 'q', {query})",
            lambda u: join_parts_sql(f"{u}.s", f"{u}.n", f"{u}.p", f"{u}.a", f"{u}.q", f"{h}.fragment"),
        )
        return (
            f"CASE WHEN {base} = '' THEN {href} WHEN {href} = '' THEN {base} WHEN {foreign} THEN {href} ELSE {made} END"
        )

    # such a path takes nothing but scheme and host from its page
    rooted = f"{b}.netloc <> '' AND {b}.scheme IN ('http', 'https') AND rlike({href}, {quote(_ROOTED)})"
    return f"IF({rooted}, concat({b}.scheme, '://', {b}.netloc, {href}), {let(url_parts_sql(href), build)})"


def resolve_url_sql(base: str, href: str) -> str:
    """Absolute form of ``href`` on a page at ``base``."""
    return let(url_parts_sql(base), lambda b: let(href, lambda h: resolve_from_sql(base, b, h)))


def link_base_sql(e: str) -> str:
    """Base used for following links: hosts without ``www.`` get it, and then
    only scheme, host and path are kept."""
    return let(
        url_parts_sql(e),
        lambda p: f"IF(startswith({p}.netloc, 'www.'), {e}, {p}.scheme || '://www.' || {p}.netloc || {p}.path)",
    )


def netloc_sql(e: str) -> str:
    """Lower-case network location (host with port)."""
    return f"lower({url_parts_sql(e)}.netloc)"


def within_domain_sql(netloc: str, base_domain: str) -> str:
    """True for the base domain itself and its sub-domains."""
    return let(
        f"named_struct('host', lower({netloc}), 'base', lower({base_domain}))",
        lambda d: f"({d}.host = {d}.base OR endswith({d}.host, '.' || {d}.base))",
    )


# --- the same inside the folds ---------------------------------------------------

_JAVA_END = r"(?=(?:\r\n|[\n\r\x85\u2028\u2029])?\Z)"  # what ``$`` means to Java
_URI = re.compile(URI_PATTERN[:-1] + r"\Z")
_CONTROLS = "".join(map(chr, range(33)))
_REMOVED_MARKS = dict.fromkeys(map(ord, f"\t\r\n{_CUT}"))
# no segment begins with a dot
_SEGMENT = "[A-Za-z0-9_~-][A-Za-z0-9_~.-]*+"
_ROOTED_PATH = re.compile(rf"(?:/{_SEGMENT})++/?(?:\?[A-Za-z0-9_~.=&%-]++)?(?:#[A-Za-z0-9_-]++)?\Z")
_PLAIN_RELATIVE = re.compile(rf"{_SEGMENT}(?:/{_SEGMENT})*+(?:\?[A-Za-z0-9_~.=&%-]++)?\Z")
_DOTS = re.compile(rf"(?:^|/)\.\.?(?:/|{_JAVA_END})")
_DOTS_LAST = re.compile(rf"(?:^|/)\.\.?{_JAVA_END}")
_SLASHES = re.compile("/{2,}")


class Parts(NamedTuple):
    """The fields of :func:`url_parts_sql`; all None for a NULL address."""

    scheme: str | None = None
    netloc: str | None = None
    path: str | None = None
    params: str | None = None
    query: str | None = None
    fragment: str | None = None


def parts_of(url: str | None) -> Parts:
    """:func:`url_parts_sql` of one address."""
    if url is None:
        return Parts()
    if not (url.isascii() and url.isprintable() and not url.startswith(" ")):
        url = url.lstrip(_CONTROLS).translate(_REMOVED_MARKS)
    scheme, netloc, path, query, fragment = _URI.match(url).groups("")
    scheme, params = scheme.lower(), ""
    if ";" in path and scheme in SCHEMES_WITH_PARAMS:
        at = path.find(";", path.rfind("/") + 1)
        if at >= 0:
            path, params = path[:at], path[at + 1 :]
    return Parts(scheme, netloc, path, params, query, fragment)


def _joined(scheme: str | None, netloc: str | None, path: str | None, params: str | None, query: str | None, fragment: str) -> str | None:
    if path is None:
        return None
    target = f"{path};{params}" if params else path
    if netloc:
        target = f"//{netloc}/{target}" if target and not target.startswith("/") else f"//{netloc}{target}"
    elif target.startswith("//") or scheme and scheme in SCHEMES_WITH_RELATIVE and (not target or target.startswith("/")):
        target = "//" + target
    return f"{scheme + ':' if scheme else ''}{target}{'?' + query if query else ''}{'#' + fragment if fragment else ''}"


def _merged(base_path: str | None, path: str) -> str | None:
    if not path.startswith("/"):
        if base_path is None:
            return None
        path = _SLASHES.sub("/", (base_path[: base_path.rfind("/") + 1] if base_path else "/") + path)
    if _DOTS.search(path):
        kept: list[str] = []
        for segment in path.split("/"):
            if segment == "..":
                kept = kept[:-1]
            elif segment != ".":
                kept.append(segment)
        path = "/".join([*kept, ""] if _DOTS_LAST.search(path) else kept)
    return path or "/"


class Resolver:
    """:func:`resolve_from_sql` for one base."""

    def __init__(self, base: str | None):
        self.base, self.parts = base, parts_of(base)
        scheme, netloc, path = self.parts[:3]
        self.root = self.folder = None  # before a rooted path, before a plain relative one
        if netloc and scheme in ("http", "https"):
            self.root = f"{scheme}://{netloc}"
            folder = path[: path.rfind("/") + 1] if path else "/"
            if not _SLASHES.search(folder) and not _DOTS.search(folder):
                self.folder = self.root + folder

    def __call__(self, href: str) -> str | None:
        if self.root and _ROOTED_PATH.match(href):
            return self.root + href
        if self.folder and _PLAIN_RELATIVE.match(href):
            return self.folder + href
        b, h = self.parts, parts_of(href)
        if self.base == "":
            return href
        if href == "":
            return self.base
        scheme = h.scheme or b.scheme
        if scheme is not None and (b.scheme is not None and scheme != b.scheme or scheme not in SCHEMES_WITH_RELATIVE):
            return href
        in_document = not (h.netloc or h.path or h.params)
        path = h.path if h.netloc else b.path if in_document else _merged(b.path, h.path)
        return _joined(
            scheme, h.netloc or b.netloc, path, b.params if in_document else h.params,
            b.query if in_document and not h.query else h.query, h.fragment,
        )


def is_within(parts: Parts, base_domain: str | None) -> bool:
    """An address on http(s) at the base domain or a sub-domain of it."""
    if parts.scheme not in ("http", "https") or base_domain is None:
        return False
    host, domain = parts.netloc.lower(), base_domain.lower()
    return host == domain or host.endswith("." + domain)


def link_base_of(url: str | None) -> str | None:
    """:func:`link_base_sql` of one address."""
    if url is None:
        return None
    p = parts_of(url)
    return url if p.netloc.startswith("www.") else f"{p.scheme}://www.{p.netloc}{p.path}"


# --- the same as Columns ---------------------------------------------------------


def url_parts(e: str) -> Column:
    return column(url_parts_sql(e))


def normalize_url(e: str, drop_params: Sequence[str] = DROP_PARAMS) -> Column:
    return column(normalize_url_sql(e, drop_params))


def content_key(e: str, id_params: Sequence[str] = ID_PARAMS, drop_params: Sequence[str] = DROP_PARAMS) -> Column:
    return column(content_key_sql(e, id_params, drop_params))


def query_value(e: str, name: str) -> Column:
    return column(query_value_sql(e, name))


def resolve_url(base: str, href: str) -> Column:
    return column(resolve_url_sql(base, href))


def link_base(e: str) -> Column:
    return column(link_base_sql(e))


def netloc(e: str) -> Column:
    return column(netloc_sql(e))
