"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same fractional number of copies,
``target / source size``. The whole part is taken; the rest is a probability.
Two fractional documents are paired: words are moved from one to the other, in a
random direction whose chances keep both expectations, until one of them is in
or out. The source's expected words do not change in any step, so a source ends
within one document of its target.

Pairing is a reduction tree. Blocks of about ``block`` documents are folded into one
fractional document each, these are dealt into blocks again, and so on until
one is left per source. No task sees more than a block at a time.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, n_words, store, uniform

WEIGHTS = (3.0, 1.0, 2.0)


def targets(sizes: DataFrame, budget: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, n_rows) -> also weight and target, one row per source.

    Weights repeat in code point order of the sources, null last. Targets share
    ``budget`` times all words; one that reaches ``cap`` times its source stops there.
    With sources in order of cap per weight, the share per unit of weight after
    stopping the first k is (budget - their caps) / (the other weights); the true
    level is the largest of these. This table has one row per source, so its
    windows run in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), nth + 1))
        .withColumn("most", F.col("source_size") * F.lit(cap))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("words", F.sum("source_size").over(everything) * F.lit(budget))
        .withColumn("per_weight", (F.col("words") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
        .withColumn("level", F.max("per_weight").over(everything))
        .withColumn("target", F.least(F.col("most"), F.col("level") * F.col("weight")))
        .select("source", "source_size", "n_rows", "weight", "target")
    )


def _fold(units, seed: int, level: int):
    """Fold an array of fractional units into decisions and one unit that is left."""

    def step(acc, new):
        old = acc["left"]
        up = F.least((1 - old["p"]) * old["size"], new["p"] * new["size"])  # words the old one may gain
        down = F.least(old["p"] * old["size"], (1 - new["p"]) * new["size"])
        gain = uniform(F.lit(seed), F.lit(level), old["id"], new["id"], old["size"], new["size"]) * (up + down) < down
        moved = F.when(gain, up).otherwise(-down)
        old_p, new_p = old["p"] + moved / old["size"], new["p"] - moved / new["size"]
        # the one that reached its bound is settled, exactly; rounding may not undo it
        old_done = F.when(gain, (1 - old["p"]) * old["size"] <= new["p"] * new["size"]).otherwise(
            old["p"] * old["size"] <= (1 - new["p"]) * new["size"]
        )
        settled = F.when(old_done, F.when(gain, 1).otherwise(0)).otherwise(F.when(gain, 0).otherwise(1))
        done = F.when(old_done, old).otherwise(new)
        left = F.when(old_done, _unit(new, new_p)).otherwise(_unit(old, old_p))
        return F.struct(
            F.concat(acc["done"], F.array(F.struct(done["id"].alias("id"), done["size"].alias("size"), settled.alias("extra")))).alias("done"),
            left.alias("left"),
        )

    empty = F.slice(F.transform(units, lambda u: F.struct(u["id"].alias("id"), u["size"].alias("size"), F.lit(0).alias("extra"))), 1, 0)
    start = F.struct(empty.alias("done"), F.element_at(units, 1).alias("left"))
    return F.aggregate(F.slice(units, 2, F.size(units)), start, step)


def _unit(u, p):
    return F.struct(u["size"].alias("size"), u["id"].alias("id"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p"), u["at"].alias("at"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    budget: float = 1.5,
    cap: float = 2.0,
    weights: tuple[float, ...] = WEIGHTS,
    block: int = 32,
    seed: int = 7,
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken.

    Size is the number of words, 0 for null text. Null is a source of its own, the last
    in order. A document without words is never taken. Decisions depend on ids,
    sizes and the seed only, so reruns agree; rows that repeat an id are decided one by
    one. Without rows or words nothing is taken.
    """
    if not 0 < cap <= 2.0:
        raise ValueError("cap must be above 0 and at most 2")
    base = store(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")), "sizes")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    # a stored table of known size: Spark broadcasts it below its threshold and splits skewed joins above
    goal = store(targets(sizes, budget, cap, weights), "targets")
    rows = (
        base.alias("b").join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")))
        .select("id", "b.source", "size", "source_size", "n_rows", "target")
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
        .withColumn("whole", F.floor("rate"))
        .withColumn("p", F.col("rate") - F.col("whole"))
    )
    fractional = (F.col("p") > 0) & (F.col("size") > 0)
    # copies decided so far: (source, id, size, extra), one row per fractional document
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("n_rows") / block))
    units = rows.where(fractional).select(
        "source",
        F.struct("size", "id", F.col("p"), F.pmod(F.xxhash64(F.lit(seed), "id", "size"), n_blocks).alias("at")).alias("unit"),
        n_blocks.cast("long").alias("n_blocks"),
    )
    most = goal.agg(F.max("n_rows")).first()[0] or 0
    levels = max(1, math.ceil(math.log(max(2, most), block)))
    parts = []
    for level in range(levels):
        folded = (
            units.groupBy("source", "unit.at", "n_blocks")
            .agg(F.sort_array(F.collect_list("unit"), asc=False).alias("units"))  # long documents first: what is left over is short
            .select("source", "n_blocks", "at", _fold(F.col("units"), seed, level).alias("out"))
        )
        folded = store(folded, f"round{level}")
        parts.append(folded.select("source", F.explode("out.done").alias("d")))
        fewer = F.greatest(F.lit(1), F.ceil(F.col("n_blocks") / block)).cast("long")
        left = F.col("out.left")
        units = folded.select(
            "source",
            F.struct(
                left["size"].alias("size"), left["id"].alias("id"), left["p"].alias("p"), F.pmod(F.col("at"), fewer).alias("at")
            ).alias("unit"),
            fewer.alias("n_blocks"),
        )
    # the last unit of a source is drawn by its probability
    last = uniform(F.lit(seed), F.lit("last"), F.col("unit.id"), F.col("unit.size")) < F.col("unit.p")
    parts.append(units.select("source", F.struct("unit.id", "unit.size", last.cast("int").alias("extra")).alias("d")))
    decided = parts[0]
    for part in parts[1:]:
        decided = decided.unionByName(part)
    decided = decided.select("source", "d.id", "d.size", "d.extra")
    rest = rows.where(~fractional).select("source", "id", "size", F.lit(0).alias("extra"))
    out = decided.unionByName(rest)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(F.lit(0)).cast("long")
    return (
        out.alias("o").join(goal.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source")))
        .select("id", "o.source", "size", "source_size", "target", "extra")
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
        .withColumn("copies", copies)
        .select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Rows with the same id, source and size share out their copies among themselves.
    """
    keys = free_names(docs, "id", "source", "size")
    planned = free_names(docs, "planned_id", "planned_source", "planned_size")
    copies, nth = free_names(docs, "copies", "nth")
    plan = (
        mix(docs, id_col, text_col, source_col, **options)
        .groupBy(*(F.col(name).alias(p) for name, p in zip(("id", "source", "size"), planned)))
        .agg(F.sort_array(F.collect_list("copies"), asc=False).alias(copies))
        .where(F.element_at(copies, 1) > 0)
    )
    rows = docs.withColumns(dict(zip(keys, (F.col(id_col), F.col(source_col), n_words(F.col(text_col))))))
    same = F.lit(True)
    for key, p in zip(keys, planned):
        same = same & F.col(key).eqNullSafe(F.col(p))
    # rows that agree in all three share out the copies
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[2]))
    return (
        rows.join(plan, same)
        .select(*docs.columns, F.element_at(copies, number).alias(nth))
        .where(F.col(nth) > 0)
        .select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(nth).cast("int"))).alias(nth))
        .drop(nth)
    )
