"""Language identification by rank-order profiles.

The profile of a language is the list of its most frequent letter n-grams (one to three
letters, a blank at word borders), counted over all documents it may learn from. A document
gets a list of its own, and its distance to a language is the sum of how far each of its n-grams
is out of place there; one that is missing counts as out of place by the list's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store, whole_texts
from .shingles import slices

LENGTH = 300  # n-grams per profile
HELD = 1_000_000  # counts a task holds before it sends them
MOST_LANGUAGES = 2_000  # bounds the profiles that are broadcast: LENGTH numbers each


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


def _grams(texts: list[str | None], letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of all texts as numbers (21 bits per character), and where each text begins."""
    lowered = [" " + t.lower() if t else " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.concatenate([[0], np.cumsum([len(t) for t in lowered])])
    is_letter = letter[codes]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # one blank after a word
    keep[begin[:-1]] = True  # and one before the first
    doc = np.repeat(np.arange(len(texts)), np.diff(begin))[keep]
    c = np.where(is_letter, codes, 32)[keep].astype(np.int64)
    blank = c == 32
    parts, owners = [c[~blank]], [doc[~blank]]
    two = doc[1:] == doc[:-1]
    pair = (c[:-1] << 21) | c[1:]
    two_ok = two & ~(blank[1:] & blank[:-1])
    parts.append(pair[two_ok])
    owners.append(doc[1:][two_ok])
    three_ok = two[1:] & two[:-1] & ~blank[1:-1]
    parts.append(((c[:-2] << 42) | pair[1:])[three_ok])
    owners.append(doc[2:][three_ok])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(grams):
        return grams, np.empty(0, np.int64)
    ordered = np.sort(grams)
    first = np.nonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))[0]
    return ordered[first], np.diff(np.append(first, len(ordered)))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letter = _letters()
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        keys, of = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(of, weights=np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)

    def rows():
        for lang, parts in held.items():
            keys, counts = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys), pa.array(counts)], names=["lang", "gram", "n"])

    for batch in slices(batches, 400):
        grams, begin = _grams(batch["text"].to_pylist(), letter)
        langs = np.array(batch["lang"].to_pylist(), object)
        of = np.repeat(np.arange(len(langs)), np.diff(begin))
        for lang in set(langs):
            parts = held.setdefault(lang, [])
            parts.append(_counted(grams[(langs == lang)[of]]))
            if len(parts) > 20:
                held[lang] = [merged(parts)]
        if sum(len(k) for parts in held.values() for k, _ in parts) > HELD:
            yield from rows()
            held.clear()
    yield from rows()


def profiles(docs: DataFrame) -> DataFrame:
    """(lang, text) -> (lang, gram, place): the LENGTH most frequent n-grams of each language."""
    counts = docs.mapInArrow(_learn, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.col("n").desc(), F.col("gram")]
    part = F.pmod(F.xxhash64("gram"), F.lit(64))  # most of each part first, so no task ranks all n-grams
    return (
        counts.withColumn("nth", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("nth") <= LENGTH)
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order)) - 1).where(F.col("place") < LENGTH)
        .select("lang", "gram", "place")
    )


def _judge(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, known = _letters(), shared.value
        for batch in slices(batches, 400):
            grams, begin = _grams(batch["text"].to_pylist(), letter)
            found, score = [], []
            for a, b in zip(begin[:-1], begin[1:]):
                keys, counts = _counted(grams[a:b])
                if not len(keys) or not known:
                    found.append("und")
                    score.append(0.0)
                    continue
                own = keys[np.argsort(-counts, kind="stable")[:LENGTH]]
                place = np.arange(len(own))
                best, best_lang = None, "und"
                for lang, profile, rank in known:
                    at = np.minimum(np.searchsorted(profile, own), len(profile) - 1)
                    distance = int(np.where(profile[at] == own, np.abs(rank[at] - place), LENGTH).sum())
                    if best is None or distance < best:
                        best, best_lang = distance, lang
                found.append(best_lang)
                score.append(1 - best / (LENGTH * len(own)))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["held_out"], pa.array(found, pa.string()), pa.array(score, pa.float64())],
                names=["id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score (1: all n-grams in place).

    Learns from rows with text and language that are not held out. Texts without a letter
    (null too) are ``und`` with score 0, as are all when nothing was learned. Of languages
    at the same distance the first in order wins.
    """
    rows = whole_texts(docs).select(
        F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    learned = store(profiles(rows.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")), "profiles")
    if learned.select("lang").distinct().count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = learned.orderBy("lang", "gram").toArrow()
    langs, gram, place = np.array(table["lang"].to_pylist(), object), table["gram"].to_numpy(), table["place"].to_numpy()
    known = [(lang, gram[langs == lang], place[langs == lang].astype(np.int64)) for lang in sorted(set(langs))]
    shared = docs.sparkSession.sparkContext.broadcast(known)
    return rows.select("id", "held_out", "text").mapInArrow(
        _judge(shared), f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    )
