"""N-gram Jaccard join: an exact similarity join in the metric space of shingle sets.

d = 1 - Jaccard is a metric, so distances to pivots bound distances between
documents. In this space unrelated documents are all at distance 1 from each
other, and from almost any pivot document; so the join narrows in three steps,
none of which loses a link.

1. A partner shares at least the threshold's part of a document's shingles, so at
   least so many of them occur in another set as well. Shingles are counted in
   buckets (sorted arrays of short hashes, a few rows per bucket and batch), and
   documents below are done. A short hash can only let too many through.
2. The first pivots are sets of one shingle. A set lies nearest to those it holds, all at
   the same distance 1 - 1/n; ties go to the rarest, so its Voronoi cell is that of
   its rarest shingle. A partner of a cell's member holds one of the member's
   first n - ceil(t n) + 1 shingles, so the boundary window replicates a document
   (its number only) into these cells. Cells that share documents make a region.
3. Regions are joined by document pivots, most central first: documents
   within the threshold of a pivot are linked to it; others are compared only with
   those whose distance to every earlier pivot differs by no more than the threshold
   (triangle inequality). Pairs known to be connected are not compared again. A region
   too large for one task is split around pivots into Voronoi cells with
   replicated windows, which are joined block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, store, whole_texts
from .components import components
from .shingles import WordHashes, byte_texts, shingle_sets, slices

BUCKET_BYTES = 8_000_000  # text per bucket of shingle counts, about 1.3 million shingles
SLICE_DOCS = 20_000  # documents whose counts are added up in one task
REGION_DOCS, REGION_SHINGLES = 4_000, 4_000_000  # most that one task joins
BLOCK = 1_000  # documents per block of a larger region
PIVOTS = 16


def _key(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def _head(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _counting_rows(length: int, n_buckets: int):
    """Rows of one document (id, n, key) and, per batch and bucket, the short hashes
    of the batch's shingles, set by set."""
    span = 2.0**64 / n_buckets
    edges = np.array([min(int(span * i), 2**64 - 1) for i in range(1, n_buckets)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in slices(batches):
            sets = shingle_sets(byte_texts(batch["text"]), known, length)
            keys = [_key(own) for own in sets]
            heads = np.array([_head(k) for k in keys], np.int64)
            sizes = np.array([len(own) for own in sets], np.int32)
            yield _rows(
                pa.array(np.abs(heads % n_buckets), pa.int32()), id=batch["id"], n=pa.array(sizes), key=pa.array(keys, pa.binary()),
                head=pa.array(heads),
            )
            # of equal sets in the batch only the first is counted
            first = np.sort(np.unique(heads, return_index=True)[1])
            chosen = [sets[i] for i in first]
            cuts = np.array([np.searchsorted(own, edges) for own in chosen]).reshape(len(chosen), n_buckets - 1)
            ends = np.concatenate([np.zeros((len(chosen), 1), np.int64), cuts, sizes[first][:, None]], axis=1)
            blobs, lengths = [], []
            for b in range(n_buckets):
                part = [own[e[b] : e[b + 1]] for own, e in zip(chosen, ends)]
                lengths.append((ends[:, b + 1] - ends[:, b]).astype(np.uint32).tobytes())
                # inside a bucket the low bits tell shingles apart
                blobs.append(np.concatenate(part).astype(np.uint32).tobytes() if part else b"")
            yield _rows(
                pa.array(range(n_buckets), pa.int32()), heads=pa.array([heads[first].tobytes()] * n_buckets, pa.binary()),
                lengths=pa.array(lengths, pa.binary()), shingles=pa.array(blobs, pa.binary()), id_type=batch["id"].type,
            )

    return run


def _rows(bucket, id=None, n=None, key=None, head=None, heads=None, lengths=None, shingles=None, id_type=None):
    rows = len(bucket)

    def blank(kind):
        return pa.nulls(rows, kind)

    return pa.RecordBatch.from_arrays(
        [
            bucket, blank(id_type) if id is None else id, blank(pa.int32()) if n is None else n, blank(pa.binary()) if key is None else key,
            blank(pa.int64()) if head is None else head, blank(pa.binary()) if heads is None else heads,
            blank(pa.binary()) if lengths is None else lengths, blank(pa.binary()) if shingles is None else shingles,
        ],
        names=["bucket", "id", "n", "key", "head", "heads", "lengths", "shingles"],
    )


def _count_bucket(n_slices: int):
    """Pass rows of documents on; per set, how many of its shingles here are in another set
    too, packed by slices of sets."""

    def run(table: pa.Table) -> pa.Table:
        return _counted(table, n_slices)

    return run


def _counted(table: pa.Table, n_slices: int) -> pa.Table:
    is_row = table["heads"].is_null()
    own = table.filter(is_row).select(["id", "n", "key", "head"])
    for name, kind in (("slice", pa.int32()), ("heads", pa.binary()), ("counts", pa.binary())):
        own = own.append_column(name, pa.nulls(len(own), kind))
    parts = table.filter(table["heads"].is_valid())
    heads = np.concatenate([np.frombuffer(x, np.int64) for x in parts["heads"].to_pylist()] or [np.empty(0, np.int64)])
    lengths = np.concatenate([np.frombuffer(x, np.uint32) for x in parts["lengths"].to_pylist()] or [np.empty(0, np.uint32)])
    short = np.concatenate([np.frombuffer(x, np.uint32) for x in parts["shingles"].to_pylist()] or [np.empty(0, np.uint32)])
    seen, first = np.unique(heads, return_index=True)
    once = np.zeros(len(heads), bool)
    once[first] = True  # equal sets of several batches count once
    of_set = np.repeat(np.arange(len(heads)), lengths)
    keep = once[of_set]
    short, of_set = short[keep], of_set[keep]
    order = np.argsort(short, kind="stable")
    ranked = short[order]
    same = ranked[1:] == ranked[:-1]
    repeated = np.zeros(len(ranked), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    shared = np.bincount(of_set[order[repeated]], minlength=len(heads))
    some = np.nonzero(shared)[0]
    part = heads[some] % n_slices
    some = some[np.argsort(part, kind="stable")]
    slices_, begin = np.unique(heads[some] % n_slices, return_index=True)
    ends = np.append(begin[1:], len(some))
    rows = len(slices_)
    counts = pa.table(
        {
            "id": pa.nulls(rows, table["id"].type), "n": pa.nulls(rows, pa.int32()), "key": pa.nulls(rows, pa.binary()),
            "head": pa.nulls(rows, pa.int64()), "slice": pa.array(slices_.astype(np.int32)),
            "heads": pa.array([heads[some[x:y]].tobytes() for x, y in zip(begin, ends)], pa.binary()),
            "counts": pa.array([shared[some[x:y]].astype(np.int32).tobytes() for x, y in zip(begin, ends)], pa.binary()),
        }
    )
    return pa.concat_tables([own.cast(counts.schema), counts])


def _add_up(table: pa.Table) -> pa.Table:
    """Sums of the counts of every set of a slice."""
    heads = np.concatenate([np.frombuffer(x, np.int64) for x in table["heads"].to_pylist()])
    counts = np.concatenate([np.frombuffer(x, np.int32) for x in table["counts"].to_pylist()])
    seen, of = np.unique(heads, return_inverse=True)
    return pa.table({"head": seen, "shared": np.bincount(of, weights=counts).astype(np.int64)})


def _sets_of(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in slices(batches):
            sets = shingle_sets(byte_texts(batch["text"]), known, length)
            same = [i for i, (own, key) in enumerate(zip(sets, batch["key"].to_pylist())) if _key(own) == key]
            chosen = [sets[i] for i in same]
            offsets = np.zeros(len(chosen) + 1, np.int32)
            np.cumsum([len(own) for own in chosen], out=offsets[1:])
            values = np.concatenate(chosen) if chosen else np.empty(0, np.uint64)
            picked = batch.take(pa.array(same, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [picked["head"], picked["n"], pa.ListArray.from_arrays(offsets, values.view(np.int64))], names=["head", "n", "shingles"]
            )

    return run


class Region:
    """Sets held by one task, with exact overlaps of one of them with all."""

    def __init__(self, heads: np.ndarray, sets: list[np.ndarray], percent: int):
        self.heads, self.percent = heads, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        everything = np.concatenate(sets) if sets else np.empty(0, np.int64)
        values, self.token = np.unique(everything, return_inverse=True)
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        self.mark = np.zeros(len(values), bool)
        weight = np.bincount(self.token, minlength=len(values))[self.token]
        #: how common a set's shingles are in the region
        self.central = np.bincount(self.owner, weights=weight, minlength=len(sets)) / np.maximum(self.sizes, 1)

    def overlaps(self, i: int) -> np.ndarray:
        mine = self.token[self.begin[i] : self.begin[i + 1]]
        self.mark[mine] = True
        out = np.bincount(self.owner[self.mark[self.token]], minlength=len(self.sizes))
        self.mark[mine] = False
        return out

    def linked(self, i: int, overlap: np.ndarray) -> np.ndarray:
        return 100 * overlap >= self.percent * (self.sizes + self.sizes[i] - overlap)

    def join(self, query: np.ndarray | None = None, label: np.ndarray | None = None) -> np.ndarray:
        """Labels by link, over all pairs or those with a set of ``query``; ``label`` has what is known."""
        k, reach = len(self.sizes), 1 - self.percent / 100 + 1e-9
        label = np.arange(k) if label is None else label.copy()
        left = np.ones(k, bool)
        distances: list[np.ndarray] = []
        order = np.argsort(-self.central, kind="stable")
        for i in order if query is None else order[query[order]]:
            todo = left & (label != label[i]) & (100 * np.minimum(self.sizes, self.sizes[i]) >= self.percent * np.maximum(self.sizes, self.sizes[i]))
            for d in distances:
                todo &= np.abs(d - d[i]) <= reach
            if todo.any():
                overlap = self.overlaps(i)
                if len(distances) < PIVOTS:
                    distances.append(1 - overlap / np.maximum(self.sizes + self.sizes[i] - overlap, 1))
                for other in np.unique(label[todo & self.linked(i, overlap)]):
                    label[label == other] = label[i]
            left[i] = False
        return label


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False) for x in column]


def _join_region(percent: int):
    def run(table: pa.Table) -> pa.Table:
        heads = table["head"].to_numpy()
        label = Region(heads, _arrays(table["shingles"]), percent).join()
        return pa.table({"a": heads, "b": heads[label]})

    return run


def _to_pivots(percent: int):
    """Documents of a slice of a large region against the region's pivots: the links,
    the home cell and the cells whose window a document lies in."""

    def run(docs: pa.Table, pivots: pa.Table) -> pa.Table:
        sets, centres = _arrays(docs["shingles"]), _arrays(pivots["shingles"])
        region = Region(np.concatenate([pivots["head"].to_numpy(), docs["head"].to_numpy()]), centres + sets, percent)
        p = len(centres)
        overlap = np.array([region.overlaps(i) for i in range(p)])
        union = region.sizes[None, :] + region.sizes[:p, None] - overlap
        distance = (1 - overlap / np.maximum(union, 1))[:, p:]
        linked = (100 * overlap >= percent * union)[:, p:]
        home = distance.argmin(axis=0)
        heads = docs["head"].to_numpy()
        near = linked.any(axis=0)
        centre = pivots["head"].to_numpy()
        window = distance <= distance.min(axis=0) + 2 * (1 - percent / 100) + 1e-9
        return pa.table(
            {
                "region": docs["region"], "head": heads, "n": docs["n"], "shingles": docs["shingles"], "home": centre[home],
                "ball": pa.array(centre[linked.argmax(axis=0)], mask=~near),
                "balls": pa.array([centre[linked[:, i]].tolist() for i in range(len(heads))], pa.list_(pa.int64())),
                "windows": pa.array([centre[window[:, i]].tolist() for i in range(len(heads))], pa.list_(pa.int64())),
            }
        )

    return run


def _join_blocks(percent: int):
    """A block of asking documents against a block of a cell."""

    def run(asking: pa.Table, block: pa.Table) -> pa.Table:
        a, b = asking["head"].to_numpy(), block["head"].to_numpy()
        heads = np.concatenate([a, b])
        sets = _arrays(asking["shingles"]) + _arrays(block["shingles"])
        known = np.concatenate([asking["root"].to_numpy(), block["root"].to_numpy()])
        label = np.unique(known, return_index=True, return_inverse=True)
        start = label[1][label[2]]
        query = np.arange(len(heads)) < len(a)
        found = Region(heads, sets, percent).join(query, start)
        moved = found != start
        return pa.table({"a": heads[start[moved]], "b": heads[found[moved]]})

    return run


def _join_large(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of regions that are too large for one task."""
    pick = Window.partitionBy("region").orderBy(F.col("central").desc(), "head")
    # a few candidates per slice of a region first, so that no task ranks a whole region
    slot = Window.partitionBy("region", F.pmod(F.xxhash64("head"), F.lit(256))).orderBy(F.col("central").desc(), "head")
    pivots = (
        sets.select("region", "head", "central").withColumn("nth", F.row_number().over(slot)).where(F.col("nth") <= PIVOTS)
        .withColumn("nth", F.row_number().over(pick)).where(F.col("nth") <= PIVOTS)
        .select("region", "head")
    )
    pivots = store(sets.join(pivots, ["region", "head"]).select("region", "head", "n", "shingles"), "pivots")
    rows = sets.groupBy("region").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("slices"))
    dealt = sets.join(rows, "region").withColumn("slice", F.pmod(F.xxhash64("head"), F.col("slices")).cast("int"))
    dealt = dealt.select("region", "slice", "head", "n", "shingles")
    copies = pivots.join(rows, "region").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    copies = copies.select("region", "slice", "head", "n", "shingles")
    schema = "region long, head long, n int, shingles array<long>, home long, ball long, balls array<long>, windows array<long>"
    seen = store(
        dealt.groupBy("region", "slice").cogroup(copies.groupBy("region", "slice")).applyInArrow(_to_pivots(percent), schema), "cells"
    )
    links = seen.select(F.col("head").alias("a"), F.explode("balls").alias("b"))
    roots = store(components(links), "roots")
    seen = store(
        seen.join(roots, seen["head"] == roots["node"], "left").drop("node").withColumn("root", F.coalesce("root", "head")).drop("balls"), "cells"
    )
    # the largest class of a region is connected already: all others ask
    size = seen.groupBy("region", "root").agg(F.count("*").alias("n_root"))
    main = size.groupBy("region").agg(F.max_by("root", F.struct("n_root", "root")).alias("main"))
    asking = (
        seen.join(main, "region").where("root <> main").select("region", "head", "root", "shingles", F.explode("windows").alias("home"))
    )
    asking = store(asking, "asking")  # it is counted and joined, and is no longer the same table as its partner
    blocks = seen.groupBy("region", "home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    queries = asking.groupBy("region", "home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("queries"))
    both = store(blocks.join(queries, ["region", "home"]), "blocks")

    def in_blocks(df, n, other, own, across):
        out = df.join(both, ["region", "home"]).withColumn(own, F.pmod(F.xxhash64("head"), F.col(n)).cast("int"))
        out = out.withColumn(across, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return out.select("region", "home", "q", "b", "head", "root", "shingles").groupBy("region", "home", "q", "b")

    found = in_blocks(asking, "queries", "blocks", "q", "b").cogroup(in_blocks(seen, "blocks", "queries", "b", "q"))
    return links.unionByName(found.applyInArrow(_join_blocks(percent), "a long, b long"))


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    region_docs: int = REGION_DOCS,
    region_shingles: int = REGION_SHINGLES,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, copies_of_set.

    Sets hold the distinct ``words``-word shingles of the whole text, A-Z lower-cased;
    two rows are linked when 100 * common >= percent * united. component_id is
    the smallest id reachable. Texts without words (null too) stand alone.
    Equal sets are one point of the space. Rows without id never stand for
    others, so a set that only they have is linked to nothing but itself.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    rows = whole_texts(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(2, math.ceil(size / BUCKET_BYTES))
    dealt = rows.mapInArrow(
        _counting_rows(words, n_buckets),
        f"bucket int, id {id_type}, n int, key binary, head long, heads binary, lengths binary, shingles binary",
    )
    n_slices = max(1, math.ceil(rows.count() / SLICE_DOCS))
    counted = dealt.groupBy("bucket").applyInArrow(
        _count_bucket(n_slices), f"id {id_type}, n int, key binary, head long, slice int, heads binary, counts binary"
    )
    counted = store(counted, "counted")

    of_doc = counted.where("slice IS NULL").select("id", "n", "key", "head")
    points = of_doc.groupBy("key").agg(
        F.min("id").alias("first_id"), F.first("n").alias("n"), F.first("head").alias("head"), F.count("*").alias("copies")
    )
    points = store(points, "points")
    shared = counted.where("slice IS NOT NULL").select("slice", "heads", "counts")
    shared = shared.groupBy("slice").applyInArrow(_add_up, "head long, shared long")
    chosen = points.join(shared, "head").where((F.col("n") > 0) & (100 * F.col("shared") >= percent * F.col("n")))
    texts = rows.join(chosen.select(F.col("first_id").alias("id"), "key", "head", "n"), "id")
    sets = texts.mapInArrow(_sets_of(words), "head long, n int, shingles array<long>").dropDuplicates(["head"])
    sets = store(sets, "sets")

    # rarest shingles first; one that no other set has makes no cell but takes its place
    held = sets.select("head", "n", F.explode("shingles").alias("shingle"))
    common = held.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ranked = (
        held.join(common, "shingle").groupBy("head", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("ranked"))
    )
    window = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1 - (F.col("n") - F.size("ranked"))
    ranked = ranked.withColumn("cells", F.expr("transform(ranked, x -> x.shingle)")).withColumn("window", window).select(
        "head",
        (F.aggregate("ranked", F.lit(0).cast("long"), lambda a, x: a + x["df"]) / F.col("n")).alias("central"),
        F.expr("slice(cells, 1, greatest(window, 0))").alias("cells"),
    )
    ranked = store(ranked, "cells")
    cell = ranked.select("head", F.explode("cells").alias("cell"))
    centre = cell.groupBy("cell").agg(F.min("head").alias("least"), F.count("*").alias("members")).where("members > 1")
    near = cell.join(centre, "cell").where("head <> least").select(F.col("head").alias("a"), F.col("least").alias("b"))
    region = store(components(near), "regions")

    in_region = (
        sets.join(region, sets["head"] == region["node"]).join(ranked.select("head", "central"), "head")
        .select(F.col("root").alias("region"), "head", "n", "shingles", "central")
    )
    in_region = store(in_region, "regions")
    extent = in_region.groupBy("region").agg(F.count("*").alias("docs"), F.sum("n").alias("total"))
    large = store(extent.where((F.col("docs") > region_docs) | (F.col("total") > region_shingles)).select("region"), "large")
    small = in_region.join(large, "region", "left_anti").select("region", "head", "shingles")
    links = small.groupBy("region").applyInArrow(_join_region(percent), "a long, b long")
    if large.limit(1).count():
        more = _join_large(store(in_region.join(large, "region", "left_semi"), "large"), percent)
        links = links.unionByName(more)
    classes = components(links)

    named = classes.join(points.select("head", "first_id"), classes["node"] == F.col("head"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = store(named.join(least, "root").select("head", "component_id"), "classes")
    answer = points.join(named, "head", "left").select(
        "key", "copies", F.coalesce("component_id", "first_id").alias("component_id")
    )
    return of_doc.join(answer, "key").select(
        "id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("copies")).otherwise(F.lit(1)).cast("long").alias("copies_of_set"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows whose id names their class: one document of each group stays."""
    (name,) = free_names(docs, "stays")
    stays = jaccard_classes(docs, id_col, text_col, words, percent).where(F.col("id").eqNullSafe(F.col("component_id")))
    return docs.join(stays.select(F.col("id").alias(name)).distinct(), F.col(id_col).eqNullSafe(F.col(name)), "left_semi")
