"""Line dedup by a suffix array over sequences of line ids.

A document is the sequence of its lines that are not blank. Suffixes are ranked by
prefix doubling: first by one line, then, as long as that is needed, by twice as many, pairing
the rank of a suffix with that of the suffix half a window further on. Ranks are ids in sort
order, given by a range partitioning. A suffix whose prefix is unique is done and takes no
further part, so rounds shrink to what repeats.

Suffixes that agree in ``min_lines`` lines are an interval of the suffix array whose longest
common prefix is at least that. In every interval the first suffix by place stays, the
lines below the others are copies; overlapping copies join to maximal runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store, whole_texts
from .shingles import slices

BLANK = r"^[\x20\x09-\x0D]*$"
PLACE = ("id", "fp", "pos")


def _ranked(suffixes: DataFrame, cols: list[str]) -> DataFrame:
    """Suffixes whose ``cols`` occur more than once, with their rank in the order of cols."""
    repeated = suffixes.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    # ids rise with the partition and inside it, so they follow the order of the range partitioning
    ranks = repeated.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("rank", F.monotonically_increasing_id())
    return store(suffixes.join(store(ranks, "ranks"), cols).select(*PLACE, "rank"), "suffixes")


def _pairs(suffixes: DataFrame, step: int) -> DataFrame:
    """Every suffix with its rank and that of the suffix ``step`` lines further on."""
    later = suffixes.select("id", "fp", (F.col("pos") - step).alias("pos"), F.col("rank").alias("rank_b"))
    return suffixes.withColumnRenamed("rank", "rank_a").join(later, list(PLACE))


def _cut(min_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            n_lines, n_removed, runs, kept = [], [], [], []
            for text, starts in zip(batch["text"].to_pylist(), batch["starts"].to_pylist()):
                lines = text.split("\n") if text else []
                full = [i for i, line in enumerate(lines) if line.strip(" \t\n\r\x0b\x0c")]
                gone = np.zeros(len(full), bool)
                for s in starts or ():
                    gone[s : s + min_lines] = True
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                drop = {full[i] for i in np.flatnonzero(gone)}
                n_lines.append(len(full))
                n_removed.append(len(drop))
                runs.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                kept.append("\n".join(line for i, line in enumerate(lines) if i not in drop))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"], pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.string()),
                ],
                names=["id", "n_lines", "n_removed", "runs", "kept_text"],
            )

    return run


def cut_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2) -> DataFrame:
    """One row per input row: id, n_lines (not blank), n_removed, runs, kept_text.

    A run of at least ``min_lines`` lines is removed where its lines also start
    earlier: in a smaller id or before it in the same text. Blank lines stay and do
    not separate lines. Rows with one id and text are one document; rows without id are
    neither cut nor compared. Null text has no lines.
    """
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    rows = whole_texts(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("fp", F.xxhash64("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    lines = F.filter(F.split("text", "\n", -1), lambda x: ~x.rlike(BLANK))
    suffixes = (
        rows.where("id IS NOT NULL").select("id", "fp", F.posexplode(lines).alias("pos", "line"))
        .select("id", "fp", "pos", F.xxhash64("line").alias("line_a"), F.hash("line").alias("line_b"))
        .dropDuplicates(["id", "fp", "pos"])
    )
    ranked, length = _ranked(store(suffixes, "lines"), ["line_a", "line_b"]), 1
    while 2 * length <= min_lines:
        ranked, length = _ranked(_pairs(ranked, length), ["rank_a", "rank_b"]), 2 * length
    if length < min_lines:
        ranked = _ranked(_pairs(ranked, min_lines - length), ["rank_a", "rank_b"])
    first = ranked.groupBy("rank").agg(F.min(F.struct("id", "pos")).alias("first"))
    copies = (
        ranked.join(first, "rank").where((F.col("id") != F.col("first.id")) | (F.col("pos") != F.col("first.pos")))
        .groupBy("id", "fp").agg(F.collect_list("pos").alias("starts"))
    )
    return rows.join(copies, ["id", "fp"], "left").select("id", "text", "starts").mapInArrow(
        _cut(min_lines),
        f"id {id_type}, n_lines long, n_removed long, runs array<struct<start:int,end:int>>, kept_text string",
    )
