"""Personal data: patterns, and spans found by weak supervision.

Strict patterns give the base spans. Looser patterns give candidates; strict and loose ones
alike are judged by labelers (pattern, checksum, gazetteer, cue words, neighbours,
units), each voting yes, no or not at all. Expectation-maximisation over the counts of vote
patterns (at most 4 x 3**6 rows, whatever the corpus) estimates how reliable each labeler is
and the chance of every pattern. A naive Bayes span classifier is then trained on these chances
with features of the span and the words around it, hashed into ``2**FEATURE_BITS`` bins. It
may add candidates; base spans always stay.

Every step is a DataFrame expression. Positions are running sums over the pieces
between matches, so a text with many matches costs no more than its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

KINDS = ("email", "ip", "card", "phone")
FEATURE_BITS = 12
ROUNDS = 12

# Strict patterns. Possessive repeats and the look-behind only keep a failed start from being
# tried again at every later character of the same run; the matches are the same.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GUARD = {"email": "@", "phone": "+"}  # a text without these has no match
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[(\[]\x20?[aA][tT]\x20?[)\]]\x20?[A-Za-z0-9-]{1,64}"
    r"(?:\x20?(?:\.|[(\[]\x20?[dD][oO][tT]\x20?[)\]])\x20?[A-Za-z0-9-]{1,64}){1,4}",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "phone": r"(?<![0-9A-Za-z.+-])\(?[0-9]{3}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z-])",
}

# fixed values: cue words before a span, by kind
CUES = {
    "email": "e-?mail|mail|correo|courriel|contact|contacto|kontakt",
    "ip": "ip|host|server|serveur|servidor|client|login",
    "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta|kreditkarte",
    "phone": "phone|tel|fax|mobile|call|cell|telefon|handy|t[eé]l[eé]phone|tel[eé]fono",
}
# fixed values: what stands before or after numbers that are no personal data
NOT_PERSONAL = r"(?i)(?:isbn|version|v|page|seite|chapter|order|nr|no|section|§|#|\$|€|£)\.?:?\s*$"
UNITS = r"^\s?(?:%|€|\$|£|kg|km|cm|mm|ms|mb|gb|eur|usd)\b"


def _found(text: Column, pattern: str, guard: str | None) -> Column:
    """array of (gap, before, hit, after): gap is the length of the text since the last match."""
    p = F.lit(pattern)
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, p, F.lit(0))

    def rows(pieces, hits):
        return F.transform(
            hits,
            lambda hit, i: F.struct(
                F.char_length(F.get(pieces, i)).alias("gap"),
                F.substring(F.get(pieces, i), -40, 40).alias("before"),
                hit.alias("hit"),
                F.substring(F.get(pieces, i + 1), 1, 20).alias("after"),
            ),
        )

    there = F.contains(text, F.lit(guard)) if guard else text.rlike("[0-9]")
    # bound once: higher-order functions see columns of the row, not copies of expressions
    both = F.array(F.struct(pieces.alias("p"), hits.alias("h")))
    return F.when(there, F.element_at(F.transform(both, lambda b: rows(b["p"], b["h"])), 1))


def _luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.ascii(F.substring(digits, i.cast("int"), 1)) - 48
        second = F.pmod(F.char_length(digits) - i, F.lit(2)) == 1
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(second, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda t, i: add(t, i))
    return F.pmod(total, F.lit(10)) == 0


def _strict() -> Column:
    """Whether a match of a strict pattern passes what the pattern cannot say."""
    digits = F.regexp_replace("hit", "[^0-9]", "")
    n = F.char_length(digits)
    parts = F.split("hit", r"\.")
    small = F.forall(parts, lambda x: F.regexp_replace(x, "^0+", "").rlike(r"^(?:|[0-9]|[0-9]{2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", small)
        .when(F.col("kind") == "card", F.when(n.between(14, 19), _luhn(digits)).otherwise(F.lit(False)))
        .otherwise(n.between(10, 15))
    )


def _matches(base: DataFrame, patterns: dict[str, str], strict: bool) -> DataFrame:
    parts = None
    for kind in patterns:
        name = f"{'strict' if strict else 'loose'}_{kind}"
        part = base.where(F.size(name) > 0).select("row", F.lit(kind).alias("kind"), F.posexplode(name).alias("nth", "m"))
        parts = part if parts is None else parts.unionByName(part)
    upto = Window.partitionBy("row", "kind").orderBy("nth")
    size = F.char_length("m.hit")
    end = F.sum(F.col("m.gap") + size).over(upto)
    return parts.select(
        "row", "kind", (end - size).alias("start"), end.alias("end"), "m.hit", "m.before", "m.after", F.lit(strict).alias("is_base")
    )


def _votes(spans: DataFrame) -> DataFrame:
    """v0 ... v5: 1 yes, -1 no, 0 no vote."""
    digits = F.regexp_replace("hit", "[^0-9]", "")
    n, kind = F.char_length(digits), F.col("kind")
    yes_no = lambda c: F.when(c, 1).otherwise(-1)
    own = F.lit(False)
    for k, words in CUES.items():
        own = own | ((kind == k) & F.col("before").rlike(rf"(?i)(?:^|[^\p{{L}}])(?:{words})[^\p{{L}}]{{0,12}}$"))
    other = F.lit(False)
    for k, words in CUES.items():
        other = other | ((kind != k) & F.col("before").rlike(rf"(?i)(?:^|[^\p{{L}}])(?:{words})[^\p{{L}}]{{0,4}}$"))
    checksum = (
        F.when(kind == "card", yes_no(F.when(n.between(14, 19), _luhn(digits)).otherwise(F.lit(False))))
        .when(kind == "phone", yes_no(n.between(10, 15)))
        .when(kind == "email", yes_no(F.col("hit").rlike(r"[A-Za-z]{2,}$")))
        .otherwise(yes_no(F.col("hit").rlike(r"[0-9A-Fa-f]$") & ~F.col("hit").rlike(r"^0+\.|\b0[0-9]")))
    )
    gazetteer = (
        F.when(kind == "email", F.when(F.col("hit").rlike(r"(?i)(?:com|org|net|edu|gov|info|de|fr|es|uk|eu|io)$"), 1).otherwise(0))
        .when(kind == "ip", F.when(F.col("hit").rlike(r"^(?:0|127|255)\."), -1).otherwise(0))
        .when(kind == "card", yes_no(digits.rlike("^[3-6]|^2[2-7]")))
        .otherwise(F.when(F.col("hit").startswith("+"), 1).otherwise(0))
    )
    touching = F.col("before").rlike(r"[\p{L}\p{N}_/=.-]$") | F.col("after").rlike(r"^[\p{L}\p{N}_/=]")
    unit = F.col("before").rlike(NOT_PERSONAL) | F.col("after").rlike(UNITS)
    return spans.withColumns(
        {
            "v0": F.when(F.col("is_base"), yes_no(F.col("strict"))).otherwise(0),
            "v1": checksum,
            "v2": gazetteer,
            "v3": F.when(own, 1).when(other, -1).otherwise(0),
            "v4": F.when(touching, -1).otherwise(1),
            "v5": F.when(unit, -1).otherwise(0),
        }
    )


VOTES = ("v0", "v1", "v2", "v3", "v4", "v5")


def _chances(patterns: DataFrame) -> DataFrame:
    """EM over counted vote patterns: kind, v0 ... v5, n -> also chance that a span is
    personal data. Labelers are independent given the truth; a labeler's probabilities
    are estimated for the kinds together, the share of true spans per kind."""
    # to begin with, the majority of votes decides, softly
    total = sum((F.col(v) for v in VOTES[1:]), F.col(VOTES[0]))
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-total))
    for _ in range(ROUNDS):
        rated = patterns.withColumn("q", chance)
        sums = [F.sum(F.col("n") * F.col("q")).alias("all_1"), F.sum(F.col("n") * (1 - F.col("q"))).alias("all_0")]
        for v in VOTES:
            for vote in (1, 0, -1):
                hit = (F.col(v) == vote).cast("double") * F.col("n")
                sums += [F.sum(hit * F.col("q")).alias(f"{v}_{vote}_1"), F.sum(hit * (1 - F.col("q"))).alias(f"{v}_{vote}_0")]
        for k in KINDS:
            own = (F.col("kind") == k).cast("double") * F.col("n")
            sums += [F.sum(own * F.col("q")).alias(f"{k}_1"), F.sum(own).alias(f"{k}_n")]
        got = {name: value or 0.0 for name, value in rated.agg(*sums).first().asDict().items()}  # some forty numbers
        logit = F.lit(0.0)
        for k in KINDS:
            share = (got[f"{k}_1"] + 1.0) / (got[f"{k}_n"] + 2.0)
            logit = F.when(F.col("kind") == k, F.log(F.lit(share / (1 - share)))).otherwise(logit)
        for v in VOTES:
            part = F.lit(0.0)
            for vote in (1, 0, -1):
                # pseudo counts favour honest labelers, so the classes cannot swap
                good = (got[f"{v}_{vote}_1"] + (1.5 if vote == 1 else 0.5 if vote == -1 else 1.0)) / (got["all_1"] + 3.0)
                bad = (got[f"{v}_{vote}_0"] + (0.5 if vote == 1 else 1.5 if vote == -1 else 1.0)) / (got["all_0"] + 3.0)
                part = F.when(F.col(v) == vote, F.log(F.lit(good / bad))).otherwise(part)
            logit = logit + part
        chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    return patterns.withColumn("chance", chance)


def _features(spans: DataFrame) -> DataFrame:
    """Hashed features: shape of the span, the word before it, the word after it."""
    shape = F.regexp_replace(F.regexp_replace(F.substring("hit", 1, 64), r"\p{N}+", "9"), r"\p{L}+", "a")
    word_before = F.lower(F.regexp_extract("before", r"(\S*)\s*$", 1))
    word_after = F.lower(F.regexp_extract("after", r"^\s*(\S*)", 1))
    bins = F.lit(1 << FEATURE_BITS)
    return spans.withColumn(
        "features",
        F.array(
            F.pmod(F.xxhash64(F.lit("s"), "kind", shape), bins), F.pmod(F.xxhash64(F.lit("b"), "kind", word_before), bins),
            F.pmod(F.xxhash64(F.lit("a"), "kind", word_after), bins),
        ),
    )


def find_personal(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sure: float = 0.95
) -> DataFrame:
    """One row per input row: id and spans, an array of (start, kind_no, end, kind, base)
    in code points, end exclusive, ordered by start and then kind.

    Null text counts as empty. A candidate is added if the classifier gives it at least
    ``sure`` and it overlaps no base span; of overlapping candidates the first and longest.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("row", F.monotonically_increasing_id())
    base = base.select(
        "row", "id",
        *(_found(F.col("text"), p, GUARD.get(k)).alias(f"strict_{k}") for k, p in BASE.items()),
        *(_found(F.col("text"), p, "(" if k == "email" else None).alias(f"loose_{k}") for k, p in LOOSE.items()),
    )
    base = store(base, "matches")
    strict = _matches(base, BASE, True).withColumn("strict", _strict())
    loose = _matches(base, LOOSE, False).withColumn("strict", F.lit(False))
    short = (F.col("kind") == "card") & (F.char_length(F.regexp_replace("hit", "[^0-9]", "")) < 13)  # any number
    spans = _votes(strict.where(~short).unionByName(loose))
    spans = store(_features(spans), "candidates")

    patterns = store(spans.groupBy("kind", *VOTES).agg(F.count("*").alias("n")), "votes")
    rated = spans.join(store(_chances(patterns).drop("n"), "chances"), ["kind", *VOTES])
    rated = rated.select("row", "kind", "start", "end", "strict", "features", "chance")
    weights = rated.select(F.explode("features").alias("bin"), "chance").groupBy("bin").agg(
        F.sum("chance").alias("yes"), F.sum(1 - F.col("chance")).alias("no")
    )
    total = rated.agg((F.sum("chance") + 1).alias("yes"), (F.sum(1 - F.col("chance")) + 1).alias("no")).first()
    all_yes, all_no = (total["yes"] or 1.0), (total["no"] or 1.0)
    odds = store(weights.select("bin", F.log((F.col("yes") + 1) / (F.col("no") + 1) * F.lit(all_no / all_yes)).alias("odds")), "odds")
    # at most 2**FEATURE_BITS rows
    open_ = rated.where(~F.col("strict")).select("row", "kind", "start", "end", "chance", F.explode("features").alias("bin"))
    added = (
        open_.join(F.broadcast(odds), "bin").groupBy("row", "kind", "start", "end").agg(F.sum("odds").alias("odds"), F.first("chance").alias("chance"))
        .withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("odds") + F.log(F.lit(all_yes / all_no))))))
        .where((F.col("p") >= sure) & (F.col("chance") >= sure))
        .select("row", "kind", "start", "end")
    )
    kind_no = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    every = (
        rated.where("strict").select("row", "kind", "start", "end", F.lit(True).alias("base"))
        .unionByName(added.withColumn("base", F.lit(False)))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("start"), kind_no.alias("kind_no"), F.col("end"), F.col("kind"), F.col("base")))).alias("spans"))
    )
    # candidates give way to what they overlap
    free = F.filter(
        "spans",
        lambda s, i: s["base"]
        | ~F.exists("spans", lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]) & (o["base"] | (o["start"] < s["start"]) | ((o["start"] == s["start"]) & (o["end"] > s["end"])))),
    )
    none = F.slice(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).alias("kind_no"), F.lit(0).cast("long").alias("end"), F.lit("").alias("kind"), F.lit(True).alias("base"))), 1, 0)
    return base.select("row", "id").join(every.withColumn("spans", free), "row", "left").select("id", F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans per kind, their digest, and all spans as text."""
    written = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])

    def base_of(kind: str):
        return lambda s: s["base"] & (s["kind"] == kind)

    return found.select(
        "id",
        *(F.size(F.filter("spans", base_of(k))).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.encode(F.array_join(F.transform(base, written), ","), "UTF-8"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", written), ",").alias("spans"),
    )
