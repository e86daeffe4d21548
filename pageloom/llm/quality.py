"""Quality rules: base counts, and perplexity under a model counted on the corpus.

The model is a modified Kneser-Ney model over the characters of words, one per
language. Spark counts the n-grams of the highest order over all documents; lower orders,
contexts and the three discounts of every order are derived from these by grouping, the
probabilities by joins from the lowest order up. For scoring, log-probabilities and
back-off weights are kept in arrays sorted by a hash of the n-gram. The hash
has ``HASH_BITS`` bits, which bounds the arrays, and so what is broadcast, at any size of
the corpus; n-grams that share a hash share the larger value.

A document is rejected when its log-perplexity lies outside its language's band: the
median, plus and minus ``width`` times the median deviation and a part that
shrinks with the length of the text, as short texts vary more.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, store, whole_texts
from .shingles import WordHashes, byte_texts, slices, word_hashes

ORDER = 5
HASH_BITS = 22  # at most 2**22 entries per order: 50 MB each
PRIME, FACTOR = 2_147_483_647, 1_000_003
FLUSH = 150_000  # distinct words a task holds before it sends their n-grams
_ODD = np.uint64(0x9E3779B97F4A7C15)
SYMBOLS = b"#*$%&|<>"


# --- n-grams ---------------------------------------------------------------------


def _columns(words: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Code points of all words with an end mark (newline) each, as ORDER columns: the
    character itself last, before it those that precede it in its word, or the mark.
    Also the number of the word of every row."""
    codes = np.frombuffer((b"\n".join(words) + b"\n").decode("utf-8").encode("utf-32-le"), np.uint32)
    ends = np.nonzero(codes == 10)[0]
    lengths = np.diff(ends, prepend=-1)
    word = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(codes)) - np.repeat(ends - lengths + 1, lengths)
    columns = []
    for back in range(ORDER - 1, 0, -1):
        shifted = np.full(len(codes), 10, np.uint32)
        shifted[back:] = codes[:-back]
        columns.append(np.where(place >= back, shifted, np.uint32(10)))
    return [*columns, codes], word


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): the n-grams of the highest order in all words of a task."""
    counts: dict[str, Counter] = {}
    for batch in slices(batches):
        for lang, text in zip(batch["lang"].to_pylist(), byte_texts(batch["text"])):
            if text:
                counts.setdefault(lang, Counter()).update(text.lower().split())
        if sum(map(len, counts.values())) > FLUSH:
            yield from map(_gram_rows, counts, counts.values())
            counts = {}
    yield from map(_gram_rows, counts, counts.values())


def _gram_rows(lang: str, words: Counter) -> pa.RecordBatch:
    columns, word = _columns(list(words)) if words else ([np.empty(0, np.uint32)] * ORDER, np.empty(0, np.int64))
    times = np.fromiter(words.values(), np.float64, len(words))[word]
    packed = np.zeros(len(word), np.uint64)
    for c in columns:
        packed = packed * _ODD + c
    first, group = np.unique(packed, return_index=True, return_inverse=True)[1:]
    n = np.bincount(group, weights=times, minlength=len(first)).astype(np.int64)
    text = np.stack([c[first] for c in columns], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    grams = [text[i : i + ORDER] for i in range(0, len(text), ORDER)]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n)], names=["lang", "gram", "n"]
    )


# --- the model -------------------------------------------------------------------


def _slot(gram, order: int):
    """Hash of (language, n-gram); the same as ``_slots`` computes."""
    h = F.pmod(F.crc32("lang"), F.lit(PRIME))
    for i in range(1, order + 1):
        h = F.pmod(h * FACTOR + F.ascii(F.substring(gram, i, 1)), F.lit(PRIME))
    return F.pmod(h, F.lit(1 << HASH_BITS)).cast("int")


def _slots(seed: int, columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]), seed % PRIME, np.int64)
    for c in columns:
        h = (h * FACTOR + c) % PRIME
    return (h & ((1 << HASH_BITS) - 1)).astype(np.int32)


def train(docs: DataFrame) -> DataFrame:
    """(lang, text) -> the model: (order, slot, logp, logb), at most 2**HASH_BITS rows per order."""
    top = docs.mapInArrow(_count_grams, "lang string, gram string, n long")
    top = store(top.groupBy("lang", "gram").agg(F.sum("n").alias("c")), "grams")
    counts = {ORDER: top}
    for order in range(ORDER - 1, 0, -1):  # continuation counts: what differs before
        shorter = F.substring("gram", 2, order).alias("gram")
        counts[order] = store(counts[order + 1].groupBy("lang", shorter).agg(F.count("*").alias("c")), "grams")

    entries, below = [], None
    for order in range(1, ORDER + 1):
        grams = counts[order].withColumn("context", F.substring("gram", 1, order - 1))
        ones = [F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)]
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

        def discount(i):
            value = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
            usable = (F.col(f"n{i}") > 0) & (F.col("n1") > 0) & value.between(0.05, i - 0.05)
            return F.when(usable, value).otherwise(F.lit(0.5 * i)).alias(f"d{i}")

        ranges = grams.groupBy("lang").agg(*ones, F.count("*").alias("types"))
        ranges = ranges.withColumns({f"n{i}": F.col(f"n{i}").cast("double") for i in range(1, 5)})
        ranges = ranges.select("lang", "types", *(discount(i) for i in (1, 2, 3)))
        off = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        grams = grams.join(ranges, "lang").withColumn("off", F.least(off, F.col("c").cast("double")))
        contexts = grams.groupBy("lang", "context").agg(
            F.sum("c").alias("total"), (F.sum("off") / F.sum("c")).alias("rest"), F.max("types").alias("types")
        )
        grams = grams.join(contexts.drop("types"), ["lang", "context"])
        own = (F.col("c") - F.col("off")) / F.col("total")
        if order == 1:
            # below single characters: all alike, with one that was never met
            scored = grams.withColumn("p", own + F.col("rest") / (F.col("types") + 1))
            unknown = contexts.select("lang", F.lit("").alias("gram"), (F.col("rest") / (F.col("types") + 1)).alias("p"))
            entries.append(unknown.select(F.lit(0).alias("order"), _slot(F.col("gram"), 0).alias("slot"), F.log("p").alias("logp"), F.lit(None).cast("double").alias("logb")))
        else:
            lower = below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("p_lower"))
            scored = grams.withColumn("suffix", F.substring("gram", 2, order - 1)).join(lower, ["lang", "suffix"])
            scored = scored.withColumn("p", own + F.col("rest") * F.col("p_lower"))
        below = store(scored.select("lang", "gram", "p"), "scored")
        entries.append(below.select(F.lit(order).alias("order"), _slot(F.col("gram"), order).alias("slot"), F.log("p").alias("logp"), F.lit(None).cast("double").alias("logb")))
        if order > 1:
            entries.append(
                contexts.select(
                    F.lit(order - 1).alias("order"), _slot(F.col("context"), order - 1).alias("slot"), F.lit(None).cast("double").alias("logp"),
                    F.log(F.greatest("rest", F.lit(1e-9))).alias("logb"),
                )
            )
    model = entries[0]
    for more in entries[1:]:
        model = model.unionByName(more)
    return model.groupBy("order", "slot").agg(
        F.max("logp").cast("float").alias("logp"), F.coalesce(F.max("logb"), F.lit(0.0)).cast("float").alias("logb")
    )


def sorted_arrays(model: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per order: hashes in order, log-probabilities (NaN: context only), back-off weights."""
    table = model.toArrow()
    order, slot = table["order"].to_numpy(), table["slot"].to_numpy()
    logp = table["logp"].to_numpy().astype(np.float32)
    logb = table["logb"].to_numpy().astype(np.float32)
    arrays = {}
    for n in range(ORDER + 1):
        mine = np.nonzero(order == n)[0]
        mine = mine[np.argsort(slot[mine])]
        arrays[n] = (slot[mine], logp[mine], logb[mine])
    return arrays


def _look_up(arrays, n: int, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, logp, logb = arrays[n]
    if not len(keys):
        return np.full(len(slots), np.nan, np.float32), np.zeros(len(slots), np.float32)
    at = np.minimum(np.searchsorted(keys, slots), len(keys) - 1)
    there = keys[at] == slots
    return np.where(there, logp[at], np.float32(np.nan)), np.where(there, logb[at], np.float32(0))


def _score_words(arrays, lang: str, words: list[bytes]) -> np.ndarray:
    """Log-probability of every word with its end."""
    columns, word = _columns(words)
    seed = zlib.crc32(lang.encode())
    rows = len(word)
    score = np.full(rows, np.nan, np.float64)
    weight = np.zeros(rows, np.float64)
    open_rows = np.arange(rows)
    for n in range(ORDER, 0, -1):
        part = [c[open_rows] for c in columns]
        logp = _look_up(arrays, n, _slots(seed, part[ORDER - n :]))[0]
        found = ~np.isnan(logp)
        score[open_rows[found]] = logp[found] + weight[open_rows[found]]
        open_rows = open_rows[~found]
        if not len(open_rows):
            break
        if n > 1:
            logb = _look_up(arrays, n - 1, _slots(seed, [c[~found] for c in part[ORDER - n : -1]]))[1]
            weight[open_rows] += logb
    if len(open_rows):
        nothing = np.array([seed % PRIME & ((1 << HASH_BITS) - 1)], np.int32)
        unknown = _look_up(arrays, 0, nothing)[0][0]
        score[open_rows] = weight[open_rows] + (unknown if not np.isnan(unknown) else -20.0)
    return np.bincount(word, weights=score, minlength=len(words))


# --- scoring ---------------------------------------------------------------------


def _repeat_words(h: np.ndarray, size: int) -> int:
    """Words inside windows of ``size`` words that the text has more than once."""
    spans = len(h) - size + 1
    if spans < 2:
        return 0
    rolled = h[:spans].copy()
    for i in range(1, size):
        rolled = rolled * _ODD + h[i : i + spans]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order][1:] == rolled[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(spans, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    at = np.nonzero(again)[0]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, hashes, logs = model.value, WordHashes(), {}
        not_symbol = bytes(set(range(256)) - set(SYMBOLS))
        for batch in slices(batches, 500):
            texts, langs = byte_texts(batch["text"]), batch["lang"].to_pylist()
            h, starts = word_hashes(texts, hashes, lower=False)
            n_words = np.diff(starts)
            split = [t.lower().split() if t else [] for t in texts]
            total = np.zeros(len(texts))
            for lang in set(langs):
                mine = [i for i, x in enumerate(langs) if x == lang]
                known = logs.setdefault(lang, {})
                new = list({w for i in mine for w in split[i]}.difference(known))
                if len(known) + len(new) > 400_000:
                    known.clear()
                    new = list({w for i in mine for w in split[i]})
                if new:
                    known.update(zip(new, _score_words(arrays, lang, new).tolist()))
                for i in mine:
                    total[i] = sum(map(known.__getitem__, split[i]))
            # code points: bytes that do not continue a character
            chars = np.array([len(t.decode("utf-8")) - sum(map(t.count, (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))) if t else 0 for t in texts])
            symbols = [len(t.translate(None, not_symbol)) if t else 0 for t in texts]
            repeats = [_repeat_words(h[a:b], 8) for a, b in zip(starts[:-1], starts[1:])]
            marks = chars + n_words  # every word has an end
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"], batch["lang"], pa.array(n_words), pa.array(chars, pa.int64()), pa.array(symbols, pa.int64()),
                    pa.array([_dup_lines(t) if t else 0 for t in texts], pa.int64()), pa.array(repeats, pa.int64()),
                    pa.array(np.where(marks > 0, -total / np.maximum(marks, 1), np.nan)),
                ],
                names=["id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ppl"],
            )

    return run


def bands(scored: DataFrame, width: float, least: float) -> DataFrame:
    """Per language the median log-perplexity of documents that pass the base rules, and
    the median deviation from it. Values are counted in steps of 0.001 first, so
    no task sorts a language's documents."""

    def median(steps: DataFrame) -> DataFrame:
        counted = steps.groupBy("lang", "step").agg(F.count("*").alias("n"))
        running = Window.partitionBy("lang").orderBy("step")
        counted = counted.withColumn("upto", F.sum("n").over(running)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
        return counted.where(2 * F.col("upto") >= F.col("all")).groupBy("lang").agg(F.min("step").alias("middle"))

    steps = scored.where("NOT base_failed").select("lang", F.round(F.col("log_ppl") * 1000).cast("long").alias("step"))
    middle = store(median(steps), "medians")
    spread = median(steps.join(middle, "lang").select("lang", F.abs(F.col("step") - F.col("middle")).alias("step")))
    spread = spread.select("lang", F.col("middle").alias("spread"))
    return store(
        middle.join(spread, "lang").select(
            "lang", (F.col("middle") / 1000).alias("log_middle"), F.greatest(F.col("spread") / 1000 * width, F.lit(least)).alias("log_width")
        ),
        "bands",
    )


def quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    width: float = 8.0,
    least: float = 0.3,
    short: float = 6.0,
) -> DataFrame:
    """One row per input row: id, lang, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, log_ppl, low, high, kept.

    Null text has no words and fails the base rules; null lang is a language of its own.
    The band is log_middle +- (max(width * median deviation, least) + short / sqrt(word_chars)).
    """
    rows = whole_texts(docs).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang")
    )
    id_type = rows.schema["id"].dataType.simpleString()
    model = docs.sparkSession.sparkContext.broadcast(sorted_arrays(train(rows.select("lang", "text"))))
    scored = rows.mapInArrow(
        _score(model),
        f"id {id_type}, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_ppl double",
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = store(scored.withColumn("base_failed", failed), "scored")
    slack = F.col("log_width") + F.lit(short) / F.sqrt(F.greatest("word_chars", F.lit(1)))
    return (
        scored.join(bands(scored, width, least), "lang", "left")
        .withColumn("low", F.col("log_middle") - slack)
        .withColumn("high", F.col("log_middle") + slack)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(False)))
        .withColumn("lang", F.nullif("lang", F.lit("")))
        .drop("log_middle", "log_width")
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that the rules keep, with all their columns. Rows that share an id are
    judged together: one that fails takes the others with it."""
    (name,) = free_names(docs, "judged")
    verdict = quality(docs, id_col, text_col, lang_col).groupBy("id").agg(F.min("kept").alias("kept"))
    good = verdict.where("kept").select(F.col("id").alias(name))
    return docs.join(good, F.col(id_col).eqNullSafe(F.col(name)), "left_semi")
