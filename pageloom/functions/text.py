"""Text columns: whitespace, normal form, fingerprint, word windows, stitching."""

from __future__ import annotations

from pyspark.sql import Column

from .expr import column, fresh, let, map_array, quote

# Unicode-aware character classes. Java's \s and \w are ASCII
# only, so the classes are spelled out.
WHITESPACE = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]"
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\t-\r\x1c-\x1f \x{85}\p{Z}]"

SHINGLE_WORDS = 5
_NO_WORDS = "cast(array() AS array<string>)"


def clean_text_sql(e: str) -> str:
    """NULL becomes "", whitespace runs become one space, ends are trimmed."""

    def single_spaced(t: str) -> str:
        # most texts have plain single spaces only, which is cheaper to see than to replace
        return f"trim(IF(rlike({t}, '[^ -~]') OR contains({t}, '  '), regexp_replace({t}, {quote(WHITESPACE + '+')}, ' '), {t}))"

    return let(f"coalesce({e}, '')", single_spaced)


def normalize_text_sql(e: str) -> str:
    """Comparison form: clean, lower case, then drop everything but letters,
    numbers, ``_`` and spaces. Spaces left behind by dropped marks stay."""
    return f"regexp_replace(lower({clean_text_sql(e)}), {quote(NOT_WORD_OR_SPACE)}, '')"


def text_fingerprint_sql(e: str) -> str:
    """SHA-256 (hex) of the comparison form."""
    return f"sha2({normalize_text_sql(e)}, 256)"


def strip_sql(e: str) -> str:
    """Without whitespace at both ends."""
    return f"regexp_replace({e}, {quote(f'^{WHITESPACE}+|{WHITESPACE}+$')}, '')"


def words_sql(e: str) -> str:
    """Whitespace separated words; an empty text has none."""
    return let(clean_text_sql(e), lambda t: f"IF({t} = '', {_NO_WORDS}, split({t}, ' '))")


def windows_sql(words: str, n: int) -> str:
    """All runs of ``n`` consecutive elements, joined by one space."""
    runs = map_array(
        f"sequence(1, size({words}) - {n - 1})", lambda i: f"array_join(slice({words}, {i}, {n}), ' ')"
    )
    # a sequence with a negative end would count downwards
    return f"IF(size({words}) >= {n}, {runs}, {_NO_WORDS})"


def word_shingles_sql(e: str, n: int = SHINGLE_WORDS) -> str:
    """Array of all windows of ``n`` consecutive words."""
    return let(words_sql(e), lambda w: windows_sql(w, n))


def first_match_sql(a_words: str, b_text: str, n: int = SHINGLE_WORDS) -> str:
    """1-based index of the first ``n``-word window of ``a_words`` that occurs
    as a substring of ``b_text``; 0 when there is none. ``n`` is at least 3.

    A window can only occur in B if its inner words (all but the first and the
    last, which may match parts of longer words) follow each other in B as
    whole words. The hash-based ``array_intersect`` of the inner windows finds
    the few places worth a substring search, so texts with nothing in common
    cost linear time. The search stops at the first hit.
    """
    inner = n - 2

    def search(windows: str, common: str) -> str:
        found, i = fresh(), fresh()
        return (
            f"aggregate(sequence(1, size({windows})), 0, ({found}, {i}) -> CASE"
            f" WHEN {found} > 0 THEN {found}"
            f" WHEN NOT array_contains({common}, array_join(slice({a_words}, {i} + 1, {inner}), ' ')) THEN 0"
            f" WHEN instr({b_text}, get({windows}, {i} - 1)) > 0 THEN {i} ELSE 0 END)"
        )

    def beyond_first(windows: str) -> str:
        inner_a = let(f"slice({a_words}, 2, size({a_words}) - 2)", lambda w: windows_sql(w, inner))
        inner_b = let(f"split({b_text}, ' ')", lambda w: windows_sql(w, inner))
        return let(
            f"array_intersect({inner_a}, {inner_b})",
            lambda common: f"IF(size({common}) = 0, 0, {search(windows, common)})",
        )

    # the first window usually matches; look there before any other is made
    return (
        f"CASE WHEN size({a_words}) < {n} THEN 0 WHEN instr({b_text}, array_join(slice({a_words}, 1, {n}), ' ')) > 0 THEN 1"
        f" ELSE {let(windows_sql(a_words, n), beyond_first)} END"
    )


def _before_match(a_words: str, b_text: str, at: str, n: int) -> str:
    window = f"array_join(slice({a_words}, {at}, {n}), ' ')"
    return f"trim(substring({b_text}, 1, instr({b_text}, {window}) - 1))"


def _with_match(a: str, b: str, n: int, body) -> str:
    """``body(words of A, clean B, index of the first match)``."""
    return let(
        words_sql(a),
        lambda aw: let(clean_text_sql(b), lambda bt: let(first_match_sql(aw, bt, n), lambda i: body(aw, bt, i))),
    )


def lead_in_sql(a: str, b: str, n: int = SHINGLE_WORDS) -> str:
    """The part of B before A's first matching window; NULL without a match."""
    return _with_match(
        a, b, n, lambda aw, bt, i: f"IF({i} > 0, {_before_match(aw, bt, f'greatest({i}, 1)', n)}, NULL)"
    )


def stitch_sql(a: str, b: str, n: int = SHINGLE_WORDS) -> str:
    """Join two extracts of the same page.

    The part of B that precedes A's first matching window is put in front of
    that window. Without a match, or if B is empty, the result is A alone.
    """

    def joined(aw: str, bt: str, i: str) -> str:
        at = f"greatest({i}, 1)"
        return (
            f"array_join(IF({i} > 0, concat(slice({aw}, 1, {at} - 1), array({_before_match(aw, bt, at, n)}),"
            f" slice({aw}, {at}, size({aw}))), {aw}), ' ')"
        )

    return _with_match(a, b, n, joined)


# --- the same as Columns -------------------------------------------------------


def clean_text(e: str) -> Column:
    return column(clean_text_sql(e))


def normalize_text(e: str) -> Column:
    return column(normalize_text_sql(e))


def text_fingerprint(e: str) -> Column:
    return column(text_fingerprint_sql(e))


def word_shingles(e: str, n: int = SHINGLE_WORDS) -> Column:
    return column(word_shingles_sql(e, n))


def lead_in(a: str, b: str, n: int = SHINGLE_WORDS) -> Column:
    return column(lead_in_sql(a, b, n))


def stitch(a: str, b: str, n: int = SHINGLE_WORDS) -> Column:
    return column(stitch_sql(a, b, n))
