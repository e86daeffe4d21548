"""Chat formatting of preference pairs.

The turns that a chosen and a rejected conversation have in common from the start are
the prompt, rendered once; what follows is each one's completion, with a mask of what
is to be learned. Turns stay rows throughout: the common prefix is found by grouping both
sides by turn and taking the first turn that differs, so a conversation may be of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def format_pairs(turns: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """(pair_id, chosen, turn, role, text) -> one row per rendered turn:
    pair_id, side (prompt, chosen, rejected), turn, role, rendered, learn, has_both.

    ``chosen`` tells the two conversations of a pair apart. Rows with the same turn
    number belong together and are compared as a bag. Rows without turn number are never
    part of the prompt. Null role or text counts as empty. In a pair
    with one side only (or without pair_id) everything is completion. Only completions of
    ``learned_role`` are learned. If both sides are equal, all is prompt.
    """
    rows = turns.select(
        "pair_id", F.coalesce("chosen", F.lit(False)).alias("chosen"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    content = F.xxhash64("role", "text")
    other = F.xxhash64("text", F.lit(1), "role")

    def bag(side):
        return F.struct(
            F.count(F.when(side, 1)).alias("n"), F.bit_xor(F.when(side, content)).alias("x"),
            F.sum(F.when(side, F.pmod(content, F.lit(1 << 40)))).alias("s"), F.sum(F.when(side, F.pmod(other, F.lit(1 << 40)))).alias("t"),
        )

    per_turn = rows.groupBy("pair_id", "turn").agg(bag(F.col("chosen")).alias("a"), bag(~F.col("chosen")).alias("b"))
    borders = per_turn.groupBy("pair_id").agg(
        F.min(F.when(~F.col("a").eqNullSafe(F.col("b")), F.col("turn"))).alias("border"),
        ((F.sum("a.n") > 0) & (F.sum("b.n") > 0)).alias("has_both"),
    )
    common = F.col("has_both") & F.col("turn").isNotNull() & (F.col("border").isNull() | (F.col("turn") < F.col("border")))
    out = rows.join(borders, "pair_id", "left").withColumn("has_both", F.coalesce("has_both", F.lit(False)))
    out = out.withColumn("common", F.coalesce(common, F.lit(False)))
    side = F.when(F.col("common"), "prompt").when(F.col("chosen"), "chosen").otherwise("rejected")
    return out.where("chosen OR NOT common").select(
        "pair_id",
        side.alias("side"),
        "turn",
        "role",
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n")).alias("rendered"),
        (~F.col("common") & (F.col("role") == learned_role)).alias("learn"),
        "has_both",
    )


def neighbours(conversations: DataFrame) -> DataFrame:
    """Pairs by number: conversation 2 p is the chosen, 2 p + 1 the rejected one of pair p."""
    return conversations.select(
        F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 0).alias("chosen"), "turn", "role", "text"
    )
