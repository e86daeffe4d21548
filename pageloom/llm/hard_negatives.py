"""Hard-negative mining with Kronecker-packed products.

Components become integers. Those of several candidates, made non-negative by a bias, lie side by side
as fields of one wide integer per dimension, each field wide enough for a whole inner product.
One multiplication by an anchor's component then serves all of these candidates; the
fields of the sum over all dimensions, less what the biases added, are the exact scores.

Anchors and candidates meet in a grid: anchors are dealt into blocks, candidates into slots, and
one task step takes one block and one slot, so memory is bounded whatever a label's share of the
rows. The grid is passed twice: first for the positives, then for the negatives below them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

BLOCK = 1024  # anchors in a block, candidates in a slot (about: they are dealt by a hash)
LONG = 1 << 63


def whole_numbers(vectors: pa.Array, length: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, a row per vector; shorter vectors are
    filled up with 0. Python integers where 64 bits are not enough."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat, sizes = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(vectors.offsets.to_numpy())
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * scale)
    if not len(flat) or np.abs(scaled).max() < 1 << 31:
        numbers = scaled.astype(np.int64)
    else:  # a float64 this large is a whole number already
        numbers = np.array([int(x) * scale if abs(x) >= 1 << 53 else int(s) for x, s in zip(flat.tolist(), scaled.tolist())], object)
    out = np.zeros((len(sizes), length), numbers.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = numbers
    return out


class Packed:
    """Candidates in wide integers, one per dimension."""

    def __init__(self, numbers: np.ndarray, largest_anchor: int):
        self.n, length = numbers.shape
        self.bias = int(np.abs(numbers).max()) if numbers.size else 0
        self.anchor_bias = largest_anchor
        # a field holds the largest possible sum, and its sign bit stays free
        bits = (length * (2 * self.bias + 1) * (2 * self.anchor_bias + 1)).bit_length() + 1
        self.width = 4 if bits <= 32 else 8 if bits <= 64 else (bits + 7) // 8
        biased = numbers + self.bias
        if self.width <= 8:
            self.kind = np.dtype(f"<i{self.width}")
            self.wide = [int.from_bytes(column.astype(self.kind).tobytes(), "little") for column in biased.T]
        else:
            self.kind = None
            self.wide = [int.from_bytes(b"".join(int(x).to_bytes(self.width, "little") for x in column), "little") for column in biased.T]
        self.added = self.anchor_bias * biased.sum(axis=1)

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Exact inner products of one anchor with all candidates."""
        total = 0
        for component, wide in zip(anchor, self.wide):
            total += (component + self.anchor_bias) * wide
        fields = total.to_bytes(self.width * self.n, "little")
        if self.kind is not None:
            products = np.frombuffer(fields, self.kind).astype(np.int64)
        else:
            products = np.array([int.from_bytes(fields[i : i + self.width], "little") for i in range(0, len(fields), self.width)], object)
        return products - self.added - self.bias * sum(anchor)


def first(scores: np.ndarray, ids: np.ndarray, chosen: np.ndarray, k: int) -> np.ndarray:
    """The k best of the chosen candidates: by score, ties by id."""
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))[:k]]


def _whole_scores(packed: Packed, anchor: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Scores as 64-bit numbers, and which candidates have one that fits."""
    scores = packed.scores(anchor)
    if scores.dtype != object:
        return scores, np.ones(len(scores), bool)
    fits = np.array([-LONG < s < LONG for s in scores], bool)
    return np.where(fits, scores, 0).astype(np.int64), fits


def _largest(numbers: np.ndarray) -> int:
    return int(np.abs(numbers).max()) if numbers.size else 0


def _prepared(anchors: pa.Table, candidates: pa.Table, scale: int):
    length = max([0, *anchors["vec"].combine_chunks().value_lengths().to_pylist(), *candidates["vec"].combine_chunks().value_lengths().to_pylist()])
    return whole_numbers(anchors["vec"], length, scale), whole_numbers(candidates["vec"], length, scale)


def _table(columns: dict[str, list], anchors: pa.Table, taken: list[int], like: pa.Table) -> pa.Table:
    """Found rows behind the anchor each belongs to; ids have the type they came with."""
    at = pa.array(taken, pa.int64())
    found = {"row": anchors["row"].take(at), "anchor_id": anchors["id"].take(at)}
    return pa.table(found | {k: pa.array(v, like["id"].type if k.endswith("_id") else pa.int64()) for k, v in columns.items()})


def _positives(scale: int, k: int):
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        of_anchors, of_candidates = _prepared(anchors, candidates, scale)
        label, own_label = candidates["label"].to_numpy(), anchors["label"].to_numpy()
        row, own_row, ids = candidates["row"].to_numpy(), anchors["row"].to_numpy(), candidates["id"].to_numpy()
        taken: list[int] = []
        found: dict[str, list] = {"positive_id": [], "positive_score": []}
        for value in np.unique(own_label):
            same = np.nonzero(label == value)[0]
            asking = np.nonzero(own_label == value)[0]
            if not len(same):
                continue
            packed = Packed(of_candidates[same], _largest(of_anchors[asking]))
            for i in asking.tolist():
                scores, fits = _whole_scores(packed, of_anchors[i].tolist())
                best = first(scores, ids[same], np.nonzero(fits & (row[same] != own_row[i]))[0], k)
                taken += [i] * len(best)
                found["positive_id"] += ids[same][best].tolist()
                found["positive_score"] += scores[best].tolist()
        return _table(found, anchors, taken, candidates)

    return run


def _negatives(scale: int, k: int, low: int, high: int):
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        of_anchors, of_candidates = _prepared(anchors, candidates, scale)
        label, own_label, ids = candidates["label"].to_numpy(), anchors["label"].to_numpy(), candidates["id"].to_numpy()
        taken: list[int] = []
        found: dict[str, list] = {"place": [], "negative_id": [], "negative_score": []}
        if not candidates.num_rows:
            return _table(found, anchors, taken, candidates)
        packed = Packed(of_candidates, _largest(of_anchors))
        for i, limits in enumerate(anchors["limits"].to_pylist()):
            # low * p <= high * n <= high * p, without products that could leave 64 bits
            ranges = [(place, -(-low * p // high), p) for place, p in enumerate(limits, 1) if -(-low * p // high) <= p]
            if not ranges:
                continue
            scores, fits = _whole_scores(packed, of_anchors[i].tolist())
            least, most = min(r[1] for r in ranges), max(r[2] for r in ranges)
            near = np.nonzero(fits & (label != own_label[i]) & (scores >= least) & (scores <= most))[0]
            near = first(scores, ids, near, len(near))
            for place, least, most in ranges:
                best = near[(scores[near] >= least) & (scores[near] <= most)][:k]
                taken += [i] * len(best)
                found["place"] += [place] * len(best)
                found["negative_id"] += ids[best].tolist()
                found["negative_score"] += scores[best].tolist()
        return _table(found, anchors, taken, candidates)

    return run


def _grid(anchors: DataFrame, candidates: DataFrame, n_anchors: int, n_candidates: int, block: int):
    """Both sides by cell of the grid: every anchor meets every candidate in just one cell."""
    blocks, slots = -(-n_anchors // block) or 1, -(-n_candidates // block) or 1

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(parts))

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    left = anchors.withColumn("block", dealt(blocks)).withColumn("slot", every(slots))
    right = candidates.withColumn("slot", dealt(slots)).withColumn("block", every(blocks))
    cell = (F.col("block") * slots + F.col("slot")).cast("long").alias("cell")
    right = right.toDF(*right.columns)  # both sides come from one table: the columns need names of their own
    return left.groupBy(cell).cogroup(right.groupBy(cell))


def _best(found: DataFrame, by: list[str], score: str, other: str, k: int) -> DataFrame:
    """The k best rows of a group with their rank; Spark drops rows beyond k in every task before it shuffles them."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(other))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label: Column | str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    block: int = BLOCK,
) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    A score is the inner product of floor(scale * x) over all components x. The positives of an
    anchor are the ``positives`` best other rows of its label. A row of another label is a negative for a
    positive if ``low * positive_score <= high * negative_score <= high * positive_score``; the best
    ``negatives`` are returned. Higher scores come first, ties by smaller id.

    Rows without id, label or vector, or with a null or non-finite component, take no part. A
    shorter vector counts as filled up with 0. A row that repeats an id is a row of its own: other rows may have
    the same id, and anchors that repeat one are answered once each. Products beyond 64 bits have no
    score that could be returned and do not count. No rows give no rows.
    """
    array = vectors.schema[vec_col].dataType.simpleString()
    rows = vectors.select(
        F.col(id_col).alias("id"),
        (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.col(vec_col).cast(array if array in ("array<float>", "array<double>") else "array<double>").alias("vec"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)))
    kept = store(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    candidates, anchors = kept.select("row", "id", "label", "vec"), kept.where("anchor").select("row", "id", "label", "vec")
    n_candidates, n_anchors = kept.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    kind = kept.schema["id"].dataType.simpleString()

    found = _grid(anchors, candidates, n_anchors, n_candidates, block).applyInArrow(
        _positives(scale, positives), f"row long, anchor_id {kind}, positive_id {kind}, positive_score long"
    )
    best = store(_best(found, ["row"], "positive_score", "positive_id", positives).withColumnRenamed("rank", "place"), "positives")
    limits = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("ranked"))
    asking = anchors.join(limits.select("row", F.transform("ranked", lambda r: r["positive_score"]).alias("limits")), "row")
    found = _grid(asking, candidates, n_anchors, n_candidates, block).applyInArrow(
        _negatives(scale, negatives, low, high), f"row long, anchor_id {kind}, place long, negative_id {kind}, negative_score long"
    )
    return (
        _best(found, ["row", "place"], "negative_score", "negative_id", negatives)
        .join(best.select("row", F.col("place").cast("long").alias("place"), "positive_id", "positive_score"), ["row", "place"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
