"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both tokenizers encode a text, and the byte offsets at which their tokens end go into two
dictionaries from end to token index. The intersection of the dictionaries' keys, sorted, cuts
both id lists into slices that cover the same bytes; the links are expanded slice by slice.

A text is encoded in units, cut at every single space between two characters that are no white
space. There both tokenizers always begin a token, as no byte-level word holds such a space inside, and no piece
of the second one holds a space behind another character (:func:`loaded` makes sure). So the
tokens of a text are the tokens of its units in a row, every cut is a common end, and a task
aligns a unit that occurs often only once. Corpus-wide counts of the links are Spark aggregates.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import hot_keys_of_counts, split_join
from .common import store, whole_texts
from .shingles import slices

REMEMBERED = 300_000  # units a task keeps before it starts anew, MOST_CHARS characters each on average
MOST_CHARS = 40
WINDOW = 1 << 20  # bytes whose ends are in the dictionaries at one time
ROWS = 100  # documents that are worked on at once
BROADCAST_PAIRS = 1_000_000  # more linked id pairs than this are joined by shuffle
LINKS = "array<struct<a:int,b:int,n:int>>"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARK = "▁"  # stands for a space in pieces


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    Latin-1 characters are their own byte, the other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + n): b for n, b in enumerate(rest)}}


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[1:-1], 16)]) if is_byte else piece.replace(_MARK, " ").encode()


def common_ends(ends_a: list[int], ends_b: list[int], window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Index of the last token of each side at every byte offset where both end, in order.

    ``ends_a`` and ``ends_b`` ascend. The dictionaries hold one window of bytes at a time.
    """
    last = max(ends_a[-1] if ends_a else 0, ends_b[-1] if ends_b else 0)
    a = b = 0
    for low in range(0, last + 1, window):
        a_stop, b_stop = bisect_left(ends_a, low + window), bisect_left(ends_b, low + window)
        at_a, at_b = dict(zip(ends_a[a:a_stop], range(a, a_stop))), dict(zip(ends_b[b:b_stop], range(b, b_stop)))
        for end in sorted(at_a.keys() & at_b.keys()):
            yield at_a[end], at_b[end]
        a, b = a_stop, b_stop


def ragged(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of every range, one range after the other."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(begin - before, length)


class Aligned(NamedTuple):
    """Aligned units, numbered: counts, groups as text, and links from ``begin`` on."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    links: np.ndarray
    groups: list[str]


class Sides:
    """The bytes and the printed ids of both vocabularies."""

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes]):
        self.size_a, self.size_b = (np.array([len(x) for x in side], np.int64) for side in (bytes_a, bytes_b))
        # an id and what follows it: inside its side, at the end of side A, of a group, of a unit
        self.printed = [f"{i}{mark}" for mark in ",|;\n" for i in range(max(len(bytes_a), len(bytes_b)))]

    def align(self, ids_a: list[list[int]], ids_b: list[list[int]]) -> Aligned:
        """Groups and links of units, given as two id lists each that spell the same bytes."""
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        unit_a, unit_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
        flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (ids_a, ids_b))
        # one more byte between units, so that no token ends where another unit's does
        ends_a, ends_b = np.cumsum(self.size_a[flat_a]) + unit_a, np.cumsum(self.size_b[flat_b]) + unit_b
        cuts = np.fromiter(chain.from_iterable(common_ends(ends_a.tolist(), ends_b.tolist())), np.int64).reshape(-1, 2)
        last_a, last_b = cuts[:, 0], cuts[:, 1]
        # within a slice, tokens end together where it ends: the last ones, or more if some have no bytes
        first_a, first_b = np.searchsorted(ends_a, ends_a[last_a]), np.searchsorted(ends_b, ends_b[last_b])
        of_a, of_b = last_a - first_a + 1, last_b - first_b + 1
        within = ragged(np.zeros(len(cuts), np.int64), of_a * of_b)
        wide = np.repeat(of_b, of_a * of_b)
        i, j = (np.repeat(first, of_a * of_b) + step for first, step in ((first_a, within // wide), (first_b, within % wide)))
        n_groups = np.bincount(unit_a[last_a], minlength=len(n_a))
        n_links = np.bincount(unit_a[i], minlength=len(n_a))
        # print: the tokens of A stand behind the B tokens of all earlier groups, those of B behind A's of theirs
        before_a, before_b = (np.concatenate(([0], last + 1)) for last in (last_a, last_b))
        group_a, group_b = np.searchsorted(last_a, np.arange(len(flat_a))), np.searchsorted(last_b, np.arange(len(flat_b)))
        kind, most = np.zeros(len(flat_a) + len(flat_b), np.int64), len(self.printed) // 4
        at_a, at_b = np.arange(len(flat_a)) + before_b[group_a], np.arange(len(flat_b)) + before_a[group_b + 1]
        kind[at_a[last_a]], kind[at_b[last_b]] = 1, 2
        kind[at_b[np.cumsum(n_b)[n_b > 0] - 1]] = 3
        tokens = np.empty(len(kind), np.int64)
        tokens[at_a], tokens[at_b] = flat_a, flat_b
        groups = "".join(map(self.printed.__getitem__, (tokens + kind * most).tolist())).split("\n")[:-1]
        return Aligned(n_a, n_b, n_groups, n_links, flat_a[i] << 32 | flat_b[j], groups)


class Tokenizers:
    """Both tokenizers, and the units met so far."""

    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core already
        self.a = Tokenizer.from_str(vocabulary)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        special = {t["id"] for t in json.loads(vocabulary)["added_tokens"]}
        alphabet, entries = byte_alphabet(), self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.bytes_a[number] = entry.encode() if number in special else bytes(alphabet[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [piece_bytes(p, self.b.is_byte(i)) for i, p in enumerate(pieces)]
        # a piece with a space behind another character could reach over a cut
        self.cuts = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        self.sides = Sides(self.bytes_a, self.bytes_b)
        self.known: dict[str, int] = {}  # number of a unit, -1 if its tokens do not spell it
        self.table: Aligned | None = None
        self.chars = 0

    def units(self, text: str) -> list[str]:
        """The text in units; each is encoded behind one space."""
        return _CUT.split(text) if self.cuts else [text]

    def learn(self, units: set[str]) -> None:
        """Number, encode and align units that are not known yet."""
        if len(self.known) + len(units) > REMEMBERED or self.chars > MOST_CHARS * REMEMBERED:
            self.known, self.table, self.chars = {}, None, 0
        new = [u for u in units if u not in self.known]
        if not new:
            return
        self.chars += sum(map(len, new))
        encoded_a = [e.ids for e in self.a.encode_batch([" " + u for u in new], add_special_tokens=False)]
        encoded_b = self.b.encode(new, num_threads=1)
        good, bad = self.spelt(new, encoded_a, encoded_b)
        start = 0 if self.table is None else len(self.table.groups)
        self.known.update(zip([new[i] for i in good], range(start, start + len(good))))
        self.known.update((new[i], -1) for i in bad)
        if good:
            found = self.sides.align([encoded_a[i] for i in good], [encoded_b[i] for i in good])
            old = self.table
            self.table = found if old is None else Aligned(*(
                x + y if isinstance(x, list) else np.concatenate((x, y)) for x, y in zip(old, found)
            ))

    def spelt(self, units: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> tuple[list[int], list[int]]:
        """Which units both sides' tokens spell, and which not."""

        def joined(table: list[bytes], ids: list[int]) -> bytes:
            return b"".join(map(table.__getitem__, ids))

        bad = [
            n for n, (u, a, b) in enumerate(zip(units, ids_a, ids_b))
            if not joined(self.bytes_a, a) == (" " + u).encode() == joined(self.bytes_b, b)
        ]
        gone = set(bad)
        return [n for n in range(len(units)) if n not in gone], bad


_loaded: dict[int, Tokenizers] = {}


def loaded(shared) -> Tokenizers:
    """The tokenizers of a broadcast, made once per Python worker."""
    key = hash(shared.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizers(*shared.value)
    return _loaded[key]


def _sums(values: np.ndarray, lengths: list[int]) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    stop = np.cumsum(lengths)
    return total[stop] - total[stop - lengths]


def _aligner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = loaded(shared)
        for batch in slices(batches, ROWS):
            texts = [both.units(t) if t else [] for t in batch["text"].to_pylist()]
            both.learn(set(chain.from_iterable(texts)))
            numbers = [list(map(both.known.__getitem__, text)) for text in texts]
            numbers = [[] if -1 in n else n for n in numbers]
            lengths = [len(n) for n in numbers]
            at, table = np.fromiter(chain.from_iterable(numbers), np.int64), both.table
            if table is None:  # no text with tokens so far
                table = Aligned(*[np.empty(0, np.int64)] * 5, [])
            n_links = table.n_links[at]
            linked = table.links[ragged((np.cumsum(table.n_links) - table.n_links)[at], n_links)]
            stop = np.cumsum(_sums(n_links, lengths))
            counted = [np.unique(x, return_counts=True) for x in np.split(linked, stop[:-1])]
            pair = np.concatenate([p for p, _ in counted])
            links = pa.StructArray.from_arrays(
                [pa.array(x.astype(np.int32)) for x in (pair >> 32, pair & 0xFFFFFFFF, np.concatenate([n for _, n in counted]))],
                names=["a", "b", "n"],
            )
            begin = np.concatenate(([0], np.cumsum([len(p) for p, _ in counted]))).astype(np.int32)
            counts = [pa.array(_sums(x[at], lengths)) for x in (table.n_a, table.n_b, table.n_groups)]
            groups = [";".join(map(table.groups.__getitem__, n)) for n in numbers]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *counts, pa.array(groups, pa.string()), pa.ListArray.from_arrays(pa.array(begin), links)],
                names=["id", "n_a", "n_b", "n_groups", "groups", "links"],
            )

    return run


def align(docs: DataFrame, vocabulary: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, groups, links.

    ``vocabulary`` and ``model`` are files the driver reads: a byte-level vocabulary of the
    ``tokenizers`` library (A) and a SentencePiece model (B). A sees a space and the text, B the
    text, to which it adds the space itself. ``groups`` lists the ids of each group as
    ``a1,a2|b1;a3|b2,b3``, ``links`` has (a, b, n) once for each pair of ids that end together, n
    times. Null and empty texts, and those whose tokens of either side do not spell a space and
    the text, have no tokens: zeros, '' and no links. Rows are never merged, so rows that repeat an id or have none
    keep a row each. A run of characters without a cut is encoded in one piece: it has to fit in a task.
    """
    with open(vocabulary, encoding="utf-8") as a, open(model, "rb") as b:
        shared = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    rows = whole_texts(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_aligner(shared), f"id {kind}, n_a long, n_b long, n_groups long, groups string, links {LINKS}")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n) -> pair, count, n_rows and is_best: no other pair of the same B id
    has a higher count. A B id has at most as many pairs as A has tokens."""
    counts = links.groupBy("pair").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("n_rows"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return counts.withColumn("is_best", F.col("count") == F.max("count").over(of_b))


def with_link_counts(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Rows of :func:`align` with n_links, n_best and count_sum in place of ``links``.

    The count of a pair is the number of links of all rows that hold it; ``n_best`` counts the
    links whose count is the highest of their B id, ``count_sum`` adds up the counts. Other
    columns stay. The counts are broadcast only if there are at most
    ``broadcast_pairs`` of them; otherwise frequent pairs are spread over several tasks.
    """
    rows = store(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = rows.select("row", F.inline("links")).select(
        "row", (F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("pair"), "n"
    )
    counts = store(pair_counts(links.select("pair", "n")), "pair-counts")
    wanted = counts.select("pair", "count", "is_best")
    if wanted.limit(broadcast_pairs + 1).count() <= broadcast_pairs:
        counted = links.join(F.broadcast(wanted), "pair")
    else:
        counted = split_join(links, wanted, "pair", hot=hot_keys_of_counts(counts, "pair"), spread_by="row")
    sums = counted.groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")
    )
    zero = F.lit(0).cast("long")
    return (
        rows.withColumn("n_links", F.aggregate("links", zero, lambda total, link: total + link["n"])).drop("links")
        .join(sums, "row", "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")})
        .drop("row")
    )
