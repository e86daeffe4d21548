"""Substring dedup by seed and extend.

A match of ``window`` words (20) holds ``window - seed + 1`` seeds of ``seed`` words, and
winnowing picks the least of their hashes as its anchor. The choice depends on
the match's words alone, so equal passages have equal anchors: documents are joined
on anchors, in buckets of anchor values. There every anchor is extended both ways to all
windows that chose it, and windows with equal words are put in order of their place
(document, start). All but the first are repeats; as neighbouring windows overlap,
they grow into the maximal repeats of at least ``window`` words.

A passage that fills a third of all documents does not fill a bucket: a batch sends a
window's first place only (later ones are repeats anyway), and a task remembers
the windows it met more than once in a batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_texts
from .shingles import WordHashes, byte_texts, mixed, slices, word_hashes

BUCKET_BYTES = 8_000_000  # text per bucket, about 1.4 million windows
REMEMBERED = 200_000  # frequent windows that a task remembers
_ODD = np.uint64(0x9E3779B97F4A7C15)
COLUMNS = ("bucket", "id", "fp", "spans", "docs", "runs", "windows")
SCHEMA = "bucket int, id long, fp int, spans binary, docs binary, runs binary, windows binary"
KINDS = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
RUN = np.dtype([("doc", np.uint16), ("start", np.uint32), ("count", np.uint16)])


def _rolled(h: np.ndarray, length: int) -> np.ndarray:
    spans = max(0, len(h) - length + 1)
    out = h[:spans].copy()
    for i in range(1, length):
        out = out * _ODD + h[i : i + spans]
    return mixed(out)


def _sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    out, have = g, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:]) if step else out
        have += step
    return out


def _batch(**columns) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(rows, k)) for c, k in zip(COLUMNS, KINDS)], names=list(COLUMNS))


def _runs(doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of neighbouring windows of one document begin, and their lengths."""
    if not len(doc):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin = np.nonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1))))[0]
    return begin, np.diff(np.append(begin, len(doc)))


def _spans_by_doc(doc: np.ndarray, pos: np.ndarray, window: int) -> tuple[np.ndarray, list[bytes]]:
    """Documents with repeats and, for each, (first word, end) pairs as int32."""
    begin, count = _runs(doc, pos)
    owner = doc[begin]
    pairs = np.stack([pos[begin], pos[begin] + count - 1 + window], axis=1).astype(np.int32)
    cut = np.nonzero(np.concatenate(([True], owner[1:] != owner[:-1])))[0] if len(owner) else np.empty(0, np.int64)
    ends = np.append(cut[1:], len(owner))
    return owner[cut], [pairs[a:b].tobytes() for a, b in zip(cut, ends)]


def _seeds(window: int, seed: int, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, frequent = WordHashes(), {}
        for batch in slices(batches, 250):
            batch = batch.filter(batch["id"].is_valid())
            ids, fps = batch["id"].to_numpy(), batch["fp"].to_numpy()
            h, starts = word_hashes(byte_texts(batch["text"]), known, lower=False)
            if len(h) < window:
                continue
            doc = np.repeat(np.arange(len(ids)), np.diff(starts))
            at = np.nonzero(np.arange(len(h)) + window <= starts[1:][doc])[0]
            anchor = _sliding_min(_rolled(h, seed), window - seed + 1)[at]
            words = _rolled(h, window)[at]
            doc, pos = doc[at], at - starts[:-1][doc[at]]

            # the first place of every window in this batch; rows with one id are one document
            rank = np.unique(ids, return_inverse=True)[1]
            place = (rank[doc].astype(np.int64) << 32) | pos
            order = np.argsort(words, kind="stable")
            ordered = words[order]
            begin = np.nonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))[0]
            count = np.diff(np.append(begin, len(ordered)))
            least = np.minimum.reduceat(place[order], begin)
            for g in np.nonzero(count > 1)[0].tolist():
                i = order[begin[g] : begin[g] + count[g]]
                first = i[place[i] == least[g]][0]
                mine = (int(ids[doc[first]]) << 32) + int(pos[first])
                before = frequent.get(int(ordered[begin[g]]))
                if before is not None and before < mine:
                    least[g] = -1  # an earlier place has been sent
                elif before is not None or len(frequent) < REMEMBERED:
                    frequent[int(ordered[begin[g]])] = mine
            repeat = np.empty(len(words), bool)
            repeat[order] = place[order] > np.repeat(least, count)

            owner, spans = _spans_by_doc(doc[repeat], pos[repeat], window)
            if len(owner):
                yield _batch(
                    bucket=pa.array((owner % n_buckets).astype(np.int32)), id=pa.array(ids[owner]), fp=pa.array(fps[owner]),
                    spans=pa.array(spans, pa.binary()),
                )
            send = np.nonzero(~repeat)[0]
            # anchors are least values, so most are small: mixed again, they fill all buckets alike
            bucket = ((mixed(anchor[send]) >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            send, bucket = send[by], bucket[by]
            edges = np.searchsorted(bucket, np.arange(n_buckets + 1))
            docs, runs, windows, used = [], [], [], []
            for b in range(n_buckets):
                own = send[edges[b] : edges[b + 1]]
                if len(own):
                    start, length = _runs(doc[own], pos[own])
                    present, index = np.unique(doc[own[start]], return_inverse=True)
                    row = np.empty(len(start), RUN)
                    row["doc"], row["start"], row["count"] = index, pos[own[start]], 0
                    row = _split_long(row, length)
                    used.append(b)
                    docs.append(np.diff(ids[present], prepend=0).tobytes() + fps[present].astype(np.int32).tobytes())
                    runs.append(row.tobytes())
                    windows.append(words[own].tobytes())
            if used:
                yield _batch(
                    bucket=pa.array(used, pa.int32()), docs=pa.array(docs, pa.binary()), runs=pa.array(runs, pa.binary()),
                    windows=pa.array(windows, pa.binary()),
                )

    return run


def _split_long(row: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Runs longer than 16 bits can count are cut into several."""
    most = 0xFFFF
    pieces = -(-length // most)
    out = np.repeat(row, pieces)
    nth = np.arange(len(out)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    out["start"] += (nth * most).astype(np.uint32)
    out["count"] = np.minimum(most, np.repeat(length, pieces) - nth * most)
    return out


def _extend(window: int):
    def run(table: pa.Table) -> pa.Table:
        done = table.filter(table["spans"].is_valid()).select(["id", "fp", "spans"])
        table = table.filter(table["windows"].is_valid())
        ids, fps, docs, starts, counts, words, n_docs = [], [], [], [], [], [], 0
        for d, r, w in zip(table["docs"].to_pylist(), table["runs"].to_pylist(), table["windows"].to_pylist()):
            k = len(d) // 12
            r = np.frombuffer(r, RUN)
            ids.append(np.cumsum(np.frombuffer(d[: 8 * k], np.int64)))
            fps.append(np.frombuffer(d[8 * k :], np.int32))
            docs.append(r["doc"].astype(np.int32) + n_docs)
            starts.append(r["start"])
            counts.append(r["count"])
            words.append(np.frombuffer(w, np.uint64))
            n_docs += k
        if not ids:
            return done
        ids, fps, words = np.concatenate(ids), np.concatenate(fps), np.concatenate(words)
        count = np.concatenate(counts).astype(np.int64)
        order = np.argsort(words)
        ordered = words[order]
        again = ordered[1:] == ordered[:-1]
        among = np.zeros(len(ordered), bool)
        among[1:] |= again
        among[:-1] |= again
        order = order[among]  # windows that occur more than once
        run_of = np.searchsorted(np.cumsum(count), order, side="right")
        doc = np.concatenate(docs)[run_of]
        pos = np.concatenate(starts)[run_of].astype(np.int64) + order - (np.cumsum(count) - count)[run_of]
        by = np.lexsort((pos, ids[doc], words[order]))
        doc, pos, group = doc[by], pos[by], words[order][by]
        head = np.concatenate(([True], group[1:] != group[:-1])) if len(group) else np.empty(0, bool)
        first = np.nonzero(head)[0][np.cumsum(head) - 1] if len(group) else np.empty(0, np.int64)
        repeat = (ids[doc] != ids[doc[first]]) | (pos != pos[first])
        doc, pos = doc[repeat], pos[repeat]
        by = np.lexsort((pos, doc))
        owner, spans = _spans_by_doc(doc[by], pos[by], window)
        found = pa.table({"id": pa.array(ids[owner]), "fp": pa.array(fps[owner]), "spans": pa.array(spans, pa.binary())})
        return pa.concat_tables([done, found])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 500):
        n_words, n_removed, spans, kept = [], [], [], []
        for text, found in zip(byte_texts(batch["text"]), batch["found"].to_pylist()):
            words = text.split() if text else []
            merged: list[list[int]] = []
            if found:
                pairs = np.frombuffer(b"".join(found), np.int32).reshape(-1, 2)
                for a, b in pairs[np.argsort(pairs[:, 0], kind="stable")].tolist():
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
            n_words.append(len(words))
            n_removed.append(sum(b - a for a, b in merged))
            spans.append([{"start": a, "end": b} for a, b in merged])
            for a, b in reversed(merged):
                del words[a:b]
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch["id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["id", "n_words", "n_removed", "spans", "kept_text"],
        )


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, seed: int = 10) -> DataFrame:
    """One row per input row: id, n_words, n_removed, spans, kept_text.

    spans are the maximal repeats as word numbers [start, end); kept_text has the
    other words, joined by one space. A window is a repeat if its words also start earlier:
    in a smaller id, or before it in the same document. Rows with one id are
    one document, so a repeated row removes nothing from its twin. Rows without id are neither
    cut nor compared. Null text has no words.
    """
    if not 1 <= seed <= window:
        raise ValueError("seed must be from 1 to window")
    rows = whole_texts(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("fp", F.hash("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, math.ceil(size / BUCKET_BYTES))
    found = (
        rows.mapInArrow(_seeds(window, seed, n_buckets), SCHEMA)
        .groupBy("bucket").applyInArrow(_extend(window), "id long, fp int, spans binary")
        .groupBy("id", "fp").agg(F.collect_list("spans").alias("found"))
    )
    return rows.join(found, ["id", "fp"], "left").select("id", "text", "found").mapInArrow(
        _cut, "id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"
    )
