"""SentencePiece encoding by suffix-array matching, and decoding.

A task gathers the distinct units (words with the spaces before them) of a batch that it
has not met yet and concatenates them. A suffix array of this text, by prefix doubling
up to the length of the longest piece, is searched for every piece of the vocabulary at once:
the suffixes that start with a piece are one range. The ranges are expanded to
edges (position, length, piece) and sorted by position. Then edges are relaxed: for a unigram
model from left to right to the path of the best score; for a BPE model
the two neighbouring symbols whose united span is the best edge become one symbol
until no edge spans two, all units of a batch in step.

Units do not depend on each other as no piece goes on after a word with a
space; a vocabulary for which that does not hold is refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_texts
from .shingles import slices

SPACE = "▁"
REMEMBERED = 250_000  # units whose pieces a task keeps
TEXT = 600_000  # characters of new units per suffix array
LONG = 96  # longer units are relaxed one by one
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Vocabulary:
    pieces: list[str]  # by id; "" where an id has no text that could match
    scores: list[float]
    byte_ids: list[int]  # ids of the 256 bytes, or empty
    unknown: int
    bpe: bool
    prefix: bool  # a space is put before the text


def load(path: str = DEFAULT_MODEL) -> Vocabulary:
    """Read a model file on the driver; its size is the vocabulary's."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules, kind = model.normalizer_spec, model.trainer_spec.model_type
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or kind not in (1, 2):
        raise ValueError("only BPE and unigram models that keep the text as it is")
    normal, unknown, byte = 1, 2, 6
    pieces = [p.piece if p.type == normal else "" for p in model.pieces]
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("a piece holds a space after a word: units would depend on each other")
    byte_ids = [i for i, p in enumerate(model.pieces) if p.type == byte]
    if len(byte_ids) not in (0, 256) or any(model.pieces[i].piece != f"<0x{b:02X}>" for b, i in enumerate(byte_ids)):
        raise ValueError("byte pieces must be all 256 in order")
    return Vocabulary(
        pieces, [p.score for p in model.pieces], byte_ids, next(i for i, p in enumerate(model.pieces) if p.type == unknown), kind == 2,
        rules.add_dummy_prefix,
    )


class Matcher:
    """Finds and relaxes the pieces of many units at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.name = hashlib.sha256(repr(vocabulary).encode("utf-8", "surrogatepass")).hexdigest()
        own = [(p, i) for i, p in enumerate(vocabulary.pieces) if p]
        alphabet = sorted({c for p, _ in own for c in p})
        self.code = {c: k + 2 for k, c in enumerate(alphabet)}  # 0 ends a unit, 1 is a character of no piece
        if len(alphabet) > 65_000:
            raise ValueError("too many different characters in the vocabulary")
        self.length = np.array([len(p) for p, _ in own], np.int64)
        self.ids = np.array([i for _, i in own], np.int64)
        self.longest = int(self.length.max(initial=1))
        self.groups = -(-self.longest // 4)
        # pieces as numbers of four characters each: least and greatest continuation
        self.low = np.zeros((len(own), self.groups), np.uint64)
        self.high = np.zeros((len(own), self.groups), np.uint64)
        for row, (p, _) in enumerate(own):
            codes = [self.code[c] for c in p]
            for g in range(self.groups):
                part = codes[4 * g : 4 * g + 4]
                for k in range(4):
                    shift = np.uint64(16 * (3 - k))
                    self.low[row, g] |= np.uint64(part[k] if k < len(part) else 0) << shift
                    self.high[row, g] |= np.uint64(part[k] if k < len(part) else 0xFFFF) << shift
        self.score = np.array(vocabulary.scores, np.float64)
        self.table = np.zeros(0x110000, np.uint16)
        self.table[:] = 1
        for c, k in self.code.items():
            self.table[ord(c)] = k

    def edges(self, codes: np.ndarray) -> np.ndarray:
        """All occurrences of pieces in the coded text by position: (position, length, row of the piece)."""
        n = len(codes)
        padded = np.concatenate([codes, np.zeros(4 * self.groups + 4, np.uint16)]).astype(np.uint64)
        four = np.zeros(n + 4 * self.groups, np.uint64)
        for k in range(4):
            four |= padded[k : k + len(four)] << np.uint64(16 * (3 - k))
        keys = [four[4 * g : 4 * g + n] for g in range(self.groups)]
        # prefix doubling: ranks by the first 4, 8, 16 ... characters
        rank = np.unique(four, return_inverse=True)[1].astype(np.uint64)
        width = 4
        while width < self.longest:
            after = np.concatenate([rank[width:], np.zeros(width, np.uint64)])
            rank = (rank << np.uint64(32)) | after
            width *= 2
            if width < self.longest:  # the last pairs are sorted as they are
                rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
        suffixes = np.argsort(rank[:n])  # equal ranks have no piece between them
        ordered = [k[suffixes] for k in keys]
        begin, end = self._search(ordered, self.low, False), self._search(ordered, self.high, True)
        count = end - begin
        rows = np.nonzero(count > 0)[0]
        count = count[rows]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        place = suffixes[np.repeat(begin[rows], count) + within]
        row = np.repeat(rows, count)
        by = np.argsort((place << 8) | self.length[row])
        return np.stack([place[by], self.length[row[by]], row[by]])

    @staticmethod
    def _search(ordered: list[np.ndarray], wanted: np.ndarray, right: bool) -> np.ndarray:
        """Binary search of all pieces at once: how many suffixes come before each."""
        low = np.searchsorted(ordered[0], wanted[:, 0], side="left")
        high = np.searchsorted(ordered[0], wanted[:, 0], side="right")
        while True:
            open_ = np.nonzero(low < high)[0]
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) >> 1
            less = np.zeros(len(open_), bool)
            equal = np.ones(len(open_), bool)
            for g, column in enumerate(ordered[1:], 1):
                value, want = column[middle], wanted[open_, g]
                less |= equal & (value < want)
                equal &= value == want
            if right:
                less |= equal
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all units in a row, and where each unit begins."""
        text = "\0".join(units) + "\0"
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(u) for u in units], np.int64)
        first = np.cumsum(sizes + 1) - sizes - 1
        codes = self.table[points]
        codes[first + sizes] = 0
        place, length, row = self.edges(codes)
        relax = self._merge if self.v.bpe else self._best_path
        start, end, piece = relax(len(points), first, sizes, place, length, row)
        return self._ids(points, first, start, end, piece)

    def _ids(self, points, first, start, end, piece):
        """Ids of the symbols in order; a character of no piece becomes bytes or unknown."""
        out = np.where(piece >= 0, self.ids[np.maximum(piece, 0)], self.v.unknown)
        times = np.ones(len(start), np.int64)
        bare = np.nonzero(piece < 0)[0]
        if self.v.byte_ids and len(bare):
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in points[start[bare]]]
            times[bare] = [len(b) for b in raw]
            out = np.repeat(out, times)
            at = np.repeat(np.cumsum(times)[bare] - times[bare], times[bare])
            within = np.arange(len(at)) - np.repeat(np.cumsum(times[bare]) - times[bare], times[bare])
            out[at + within] = np.array(self.v.byte_ids)[np.frombuffer(b"".join(raw), np.uint8)]
        unit = np.searchsorted(first, start, side="right") - 1
        counts = np.bincount(unit, weights=times, minlength=len(first)).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(counts)])

    def _merge(self, n, first, sizes, place, length, row):
        """BPE: unite the best pair of neighbours in every unit until none is left."""
        best = np.full((n, self.longest + 1), -1, np.int32)
        best[place, length] = row
        score = self.score[self.ids]
        unit = np.repeat(np.arange(len(first)), sizes)
        start = np.arange(len(unit)) + unit  # one end mark before every later unit
        end = start + 1
        done_start, done_end = [], []
        for i in np.nonzero(sizes > LONG)[0].tolist():
            s = self._merge_one(int(first[i]), int(sizes[i]), best, score)
            done_start.append(s)
            done_end.append(np.append(s[1:], first[i] + sizes[i]))
        keep = sizes[unit] <= LONG
        start, end, unit = start[keep], end[keep], unit[keep]
        while len(start):
            pair = np.nonzero(unit[1:] == unit[:-1])[0]
            span = end[pair + 1] - start[pair]
            edge = np.where(span <= self.longest, best[start[pair], np.minimum(span, self.longest)], -1)
            some = edge >= 0
            pair, edge = pair[some], edge[some]
            active = np.zeros(len(first), bool)
            active[unit[pair]] = True
            rest = ~active[unit]
            done_start.append(start[rest])
            done_end.append(end[rest])
            if not len(pair):
                break
            value = score[edge]
            by_unit = unit[pair]
            cut = np.nonzero(np.concatenate(([True], by_unit[1:] != by_unit[:-1])))[0]
            top = np.repeat(np.maximum.reduceat(value, cut), np.diff(np.append(cut, len(pair))))
            at = pair[value == top]
            at = at[np.concatenate(([True], unit[at][1:] != unit[at][:-1]))]  # the leftmost of equals
            end[at] = end[at + 1]
            stay = active[unit]
            stay[at + 1] = False
            start, end, unit = start[stay], end[stay], unit[stay]
        start, end = np.concatenate(done_start), np.concatenate(done_end)
        by = np.argsort(start)
        start, end = start[by], end[by]
        return start, end, best[start, end - start]

    @staticmethod
    def _merge_one(first, size, best, score):
        """The same for one long unit, with a heap."""
        widest = best.shape[1] - 1
        following = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        alive = [True] * size + [False]
        heap = []

        def offer(a):
            b = following[a]
            if b < size and following[b] - a <= widest:
                edge = best[first + a, following[b] - a]
                if edge >= 0:
                    heapq.heappush(heap, (-score[edge], a, b, following[b]))

        for a in range(size - 1):
            offer(a)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if alive[a] and alive[b] and following[a] == b and following[b] == c:
                following[a] = c
                alive[b] = False
                if c < size:
                    before[c] = a
                if before[a] >= 0:
                    offer(before[a])
                offer(a)
        return first + np.array([a for a in range(size) if alive[a]], np.int64)

    def _best_path(self, n, first, sizes, place, length, row):
        """Unigram: relax the edges by position; an uncovered character costs the worst score less 10."""
        score = self.score[self.ids]
        bare = float(score.min(initial=0.0)) - 10
        spans = np.searchsorted(place, np.arange(n + 1))
        lengths, rows, values = length.tolist(), row.tolist(), score[row].tolist()
        starts, ends, pieces = [], [], []
        for f, size in zip(first.tolist(), sizes.tolist()):
            total, back = [0.0] + [-np.inf] * size, [(0, -1)] * (size + 1)
            for i in range(size):
                single = False
                for e in range(spans[f + i], spans[f + i + 1]):
                    j = i + lengths[e]
                    single |= j == i + 1
                    if total[i] + values[e] > total[j]:
                        total[j], back[j] = total[i] + values[e], (i, rows[e])
                if not single and total[i] + bare > total[i + 1]:
                    total[i + 1], back[i + 1] = total[i] + bare, (i, -1)
            path, j = [], size
            while j:
                i, piece = back[j]
                path.append((f + i, f + j, piece))
                j = i
            for a, b, piece in reversed(path):
                starts.append(a)
                ends.append(b)
                pieces.append(piece)
        return np.array(starts, np.int64), np.array(ends, np.int64), np.array(pieces, np.int64)


_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Encoder:
    """Ids of texts; remembers the units it met."""

    def __init__(self, matcher: Matcher):
        self.v, self.matcher = matcher.v, matcher
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.values, self.begins = np.empty(0, np.int32), np.zeros(1, np.int64)

    def split(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct units of all texts, the units in order as numbers of these, and how many each text has.

        Texts with single spaces only, nearly all, are split and numbered by Arrow. In the others spaces
        may stand alone or before a word, and a regular expression finds the units.
        """
        texts = pc.replace_substring(pc.fill_null(texts, ""), " ", SPACE)
        plain = pc.and_not(pc.not_equal(texts, ""), pc.or_(pc.match_substring(texts, SPACE + SPACE), pc.starts_with(texts, SPACE)))
        if not self.v.prefix:
            plain = pa.array(np.zeros(len(texts), bool))
        is_plain = plain.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(plain), SPACE)
        coded = lists.flatten().dictionary_encode()
        distinct = [SPACE + w for w in coded.dictionary.to_pylist()]
        counts = np.zeros(len(texts), np.int64)
        counts[is_plain] = pc.list_value_length(lists).to_numpy()
        others = [_UNIT.findall((SPACE if self.v.prefix else "") + t) if t else [] for t in texts.filter(pc.invert(plain)).to_pylist()]
        counts[~is_plain] = [len(u) for u in others]
        place: dict[str, int] = {}
        rest = [place.setdefault(u, len(distinct) + len(place)) for u in chain.from_iterable(others)]
        # units lie in two groups, those of plain texts first: put them in the order of the texts
        numbers = np.concatenate([coded.indices.to_numpy().astype(np.int64), np.array(rest, np.int64)])
        order = np.argsort(~is_plain, kind="stable")
        begin = np.empty(len(texts), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        return distinct + list(place), numbers[_ranges(begin, counts)], counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each begins."""
        units, numbers, per_text = self.split(texts)
        if len(self.known) > REMEMBERED:
            self._forget()
        # a unit can be there twice, from texts of either kind
        new = [u for u in dict.fromkeys(units) if u not in self.known]
        values, counts, at, size = [self.values], [np.diff(self.begins)], 0, 0
        for k, unit in enumerate(new):
            size += len(unit) + 1
            if size >= TEXT or k == len(new) - 1:
                ids, begins = self.matcher.encode(new[at : k + 1])
                values.append(ids.astype(np.int32))
                counts.append(np.diff(begins))
                at, size = k + 1, 0
        base = len(self.known)
        self.known.update(zip(new, range(base, base + len(new))))
        self.values, counts = np.concatenate(values), np.concatenate(counts)
        self.begins = np.concatenate([[0], np.cumsum(counts)])
        known = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))[numbers]
        length = counts[known]
        ids = self.values[_ranges(self.begins[known], length)]
        ends = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, ends


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1 ... of every range, one after the other."""
    return np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)


# The encoder of the model last used stays with the Python worker, so that its next task need not learn the frequent units
# again. It holds REMEMBERED units and those of one batch at most, and only saves time.
_kept: dict[str, Encoder] = {}


def _encoder(matcher: Matcher) -> Encoder:
    if matcher.name not in _kept:
        _kept.clear()
        _kept[matcher.name] = Encoder(matcher)
    return _kept[matcher.name]


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in slices(batches, 400):
            ids, ends = encoder.encode(batch["text"])
            columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*columns, tokens], names=[*names, "ids"])

    return run


def _decode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        parts = [p.replace(SPACE, " ").encode() for p in v.pieces]
        parts[v.unknown] = " ⁇ ".encode()
        for value, i in enumerate(v.byte_ids):
            parts[i] = bytes([value])
        joined = np.frombuffer(b"".join(parts), np.uint8)
        length = np.array([len(p) for p in parts], np.int64)
        begin = np.cumsum(length) - length
        for batch in slices(batches, 400):
            lists = batch["ids"]
            ids = lists.flatten().to_numpy()
            per_row = np.fromiter((n or 0 for n in pc.list_value_length(lists).to_pylist()), np.int64, len(lists))
            size = length[ids]
            ends = np.concatenate([[0], np.cumsum(size)])
            raw = joined[np.arange(ends[-1]) + np.repeat(begin[ids] - ends[:-1], size)].tobytes()
            ends = ends[np.concatenate([[0], np.cumsum(per_row)])].tolist()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
            if v.prefix:
                texts = [t[1:] if t[:1] == " " else t for t in texts]
            columns = [*(batch.column(i) for i in range(batch.num_columns)), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = DEFAULT_MODEL) -> DataFrame:
    """One row per input row: id, ids (piece ids of the whole text). Null and empty
    texts have no ids. The vocabulary (some thousand pieces, a fixed file) is broadcast."""
    rows = whole_texts(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(Matcher(load(model)))
    return rows.mapInArrow(_encode(shared), f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """Adds ``decoded`` to a table with ``ids``. Byte sequences that are no text become U+FFFD."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(model))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decode(shared), f"{fields}, decoded string")
