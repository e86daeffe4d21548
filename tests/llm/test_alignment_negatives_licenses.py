"""Token alignment, hard negatives and license scans against plain Python versions, on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import SCHEMA, made_rows

from pageloom.llm import hard_negatives, license_scan, token_alignment
from pageloom.llm.registry import BYTE_BPE, PIECE_BPE

TEXTS = [
    None, "", " ", "  two  blanks ", "a", "<s>x</s><unk> <|endoftext|> y", "nul \x00 byte", "mark ▁ inside one two", "é é ﬁ ①",
    "line\nline\n\n next\ttab \r\n end ", "x" * 3000, "ab " * 4000, "don't  we'll 12345 ... !!!  nbsp  em", "日本語 テキスト 🙂🙂 emoji", "\x1c sep \x85 nel",
    " lead", "word " + "é" * 700,
]
CLASHING = "doc_id long, text string, row long, n_a int, links string, words string, pair int, spans string, found int"


def as_rows(texts):
    rows = [(i, t, 7, 1, "x", "y", 2, "z", 3) for i, t in enumerate(texts)]
    return [*rows, rows[4], (None, "one two", 7, 1, "x", "y", 2, "z", 3)]


# --- tokens ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def token_rows():
    random.seed(5)
    made = [r[1] for r in made_rows()]
    return as_rows(TEXTS + made)


def plain_alignment(texts):
    """n_a, n_b, groups and pairs of every text, encoded whole."""
    with open(BYTE_BPE, encoding="utf-8") as a, open(PIECE_BPE, "rb") as b:
        both = token_alignment.Tokenizers(a.read(), b.read())
    out = []
    for text in texts:
        if not text:
            out.append((0, 0, [], []))
            continue
        ids_a, ids_b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
        bytes_a, bytes_b = [both.bytes_a[i] for i in ids_a], [both.bytes_b[i] for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            out.append((0, 0, [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        groups, pairs, a0, b0 = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            a1, b1 = ends_a.index(end, a0) + 1, ends_b.index(end, b0) + 1
            groups.append((ids_a[a0:a1], ids_b[b0:b1]))
            pairs.append((ids_a[a1 - 1], ids_b[b1 - 1]))
            a0, b0 = a1, b1
        out.append((len(ids_a), len(ids_b), groups, pairs))
    return out


def expected_alignment(rows):
    plain = plain_alignment([r[1] for r in rows])
    count = Counter(p for *_, pairs in plain for p in pairs)
    highest = defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = []
    for (doc_id, *_), (n_a, n_b, groups, pairs) in zip(rows, plain):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best = sum(count[p] == highest[p[1]] for p in pairs)
        out.append((doc_id, n_a, n_b, len(groups), len(pairs), best, sum(count[p] for p in pairs), text))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast_pairs", [1_000_000, 0])
def test_alignment_is_that_of_whole_texts(spark, token_rows, broadcast_pairs):
    docs = spark.createDataFrame(token_rows, CLASHING).repartition(4)
    aligned = token_alignment.align(docs, BYTE_BPE, PIECE_BPE)
    got = token_alignment.with_link_counts(aligned, broadcast_pairs)
    columns = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == expected_alignment(token_rows)


def test_alignment_needs_equal_bytes(spark):
    docs = spark.createDataFrame([(1, "has ▁ a mark"), (2, "has none")], "doc_id long, text string")
    got = {r["id"]: r for r in token_alignment.align(docs, BYTE_BPE, PIECE_BPE).collect()}
    assert (got[1]["n_a"], got[1]["n_b"], got[1]["groups"], got[1]["links"]) == (0, 0, "", [])
    assert got[2]["n_a"] > 0 and got[2]["groups"]


def test_alignment_of_an_empty_table(spark):
    aligned = token_alignment.align(spark.createDataFrame([], CLASHING), BYTE_BPE, PIECE_BPE)
    assert token_alignment.with_link_counts(aligned).collect() == []


def test_ends_meet_across_windows():
    random.seed(2)
    a, b = (np.cumsum([random.choice([0, 1, 1, 2, 5]) for _ in range(400)]).tolist() for _ in range(2))
    last = [(len(a) - 1 - a[::-1].index(e), len(b) - 1 - b[::-1].index(e)) for e in sorted(set(a) & set(b))]
    for window in (1, 7, 100, 1 << 20):
        assert list(token_alignment.common_ends(a, b, window)) == last


def test_tokens_without_bytes_end_together():
    sides = token_alignment.Sides([b"", b"a", b"aa"], [b"", b"a", b"aa"])
    found = sides.align([[1, 0, 2], [0, 1], [1, 1, 0, 0]], [[2, 1, 0], [1], [1, 0, 1, 0]])
    # bytes of the first unit: A ends at 1, 1, 3 and B at 2, 3, 3
    assert found.groups == ["1,0,2|2,1,0", "0,1|1", "1|1,0;1,0,0|1,0"] and found.n_groups.tolist() == [1, 1, 2]
    pairs = [(x >> 32, x & 0xFFFFFFFF) for x in found.links.tolist()]
    assert pairs == [(2, 1), (2, 0), (1, 1), (1, 1), (1, 0), (1, 1), (1, 0), (0, 1), (0, 0), (0, 1), (0, 0)]
    assert found.n_links.tolist() == [2, 1, 8]


# --- vectors ---------------------------------------------------------------------


def mined(rows, k=5):
    """Plain version: rows of (vec_id, vector, label), any number of rows per id."""
    ready = []
    for n, (i, v, label) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * x) if abs(x) < 2**60 else int(x) * 256 for x in v]
        ready.append((n, i, whole, (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for n, i, v, label in ready:
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m, other) for m, j, w, other in ready if m != n]
        scored = [x for x in scored if abs(x[0]) < 2**63]
        for minus, j, _, _ in sorted(x for x in scored if x[3] == label)[:k]:
            near = sorted((s, o) for s, o, _, other in scored if other != label and 80 * -minus <= 100 * -s <= 100 * -minus)
            out += [(i, j, r, o, -minus, -s) for r, (s, o) in enumerate(near[:k], 1)]
    return sorted(out)


def mine(df, **settings):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, label=label, **settings)
    return sorted(tuple(r[c] for c in columns) for r in found.collect())


VECTORS = "vec_id long, embedding array<double>, label int, id long, vec string, row int, cell int, anchor string"


def vectors(rows):
    return [(*r, 1, "v", 2, 3, "a") for r in rows]


def some_vectors(n=700):
    rng = np.random.default_rng(3)
    middle = rng.normal(0, 0.2, (4, 8))
    rows = [(i, (middle[i % 4] + rng.normal(0, 0.1, 8)).tolist(), int(rng.integers(0, 3))) for i in range(n)]
    rows += [(800 + i, middle[0].tolist(), i % 3) for i in range(40)]  # ties
    rows += [rows[0], rows[0], rows[100], (100, middle[1].tolist(), 2)]  # ids and rows repeated
    rows += [
        (900, None, 1), (901, [0.1] * 8, None), (902, [0.1, None] * 4, 1), (1000, [float("nan")] * 8, 1), (1100, [float("inf")] + [0.0] * 7, 1),
        (None, [0.2] * 8, 1), (1200, [], 1), (1300, [0.3, 0.2], 2), (1301, [0.0] * 8, 0), (-100, [-0.5] * 8, 1), (1400, [0.4] * 11, 0),
    ]
    return rows


@pytest.mark.parametrize("block", [1024, 50])
def test_negatives_are_those_of_plain_python(spark, block):
    rows = some_vectors()
    df = spark.createDataFrame(vectors(rows), VECTORS).repartition(5)
    assert mine(df, block=block) == mined(rows)


def test_large_components_stay_exact(spark):
    random.seed(4)
    rows = [(i, [random.uniform(-1, 1) * 10.0 ** random.choice([1, 3, 5, 6]) for _ in range(5)], i % 3) for i in range(300)]
    assert mine(spark.createDataFrame(vectors(rows), VECTORS)) == mined(rows)
    rows += [(400 + i, [1e12 * i, 1e300, -1e18, 0.5, 2.0], i % 3) for i in range(5)]  # products beyond 64 bits have no score
    assert mine(spark.createDataFrame(vectors(rows), VECTORS)) == mined(rows)


def test_packed_products_are_inner_products():
    rng = np.random.default_rng(1)
    for top in (3, 300, 2**20, 2**29):
        c, a = rng.integers(-top, top, (37, 9)), rng.integers(-top, top, 9)
        packed = hard_negatives.Packed(c, top)
        assert packed.scores(a.tolist()).tolist() == [sum(x * y for x, y in zip(a.tolist(), row)) for row in c.tolist()]


def test_few_rows_and_none(spark):
    assert mine(spark.createDataFrame([], VECTORS)) == []
    assert mine(spark.createDataFrame(vectors([(0, [1.0], 1)]), VECTORS)) == []
    rows = [(0, [1.0], 0), (1, [1.0], 1), (2, [0.9], 2), (3, [0.7], 3), (4, [1.0], 5)]
    df = spark.createDataFrame(vectors(rows), VECTORS)
    assert mine(df) == mined(rows) == [(0, 1, 1, 4, 65536, 65536), (0, 1, 2, 2, 65536, 58880)]


# --- licenses --------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def phrase_places(w, label):
    phrase = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}[label]
    return [i for i in range(len(w)) if w[i : i + len(phrase)] == phrase]


def license_texts():
    random.seed(9)
    filler = [f"w{i}" for i in range(60)]
    some = lambda n: " ".join(random.choice(filler) for _ in range(n))
    notice = {t.label: t.text for t in license_scan.TEMPLATES if len(words(t.text)) >= license_scan.LONG}
    mit = notice["mit"].split()
    broken = mit[:10] + ["inserted"] * 3 + mit[10:40] + mit[44:]
    return {
        "none": some(200), "mit": some(30) + " " + notice["mit"] + " " + some(20), "mit upper": notice["mit"].upper(),
        "mit broken": some(5) + " " + " ".join(broken), "mit half": " ".join(mit[: len(mit) // 3]),
        "two": notice["bsd"] + "\n\n" + some(10) + "\n" + notice["isc"], "twice": notice["bsd"] + " " + some(30) + " " + notice["bsd"],
        "phrases": "MIT License mit license, mit-license! MIT\nLicense " + some(3) + " Apache license general public license general public",
        "glued": "xmit license mit licensed Mit Licenseé", "many": "mit license " * 5000, "long": some(50_000) + " apache license " + some(10),
        "cc": "Licensed under CC BY-NC 4.0.", "gpl": "This work is licensed under the GNU General Public License, version 3.",
    }


def test_base_places_are_those_of_plain_python(spark):
    texts = license_texts()
    rows = as_rows([*texts.values(), *TEXTS])
    docs = spark.createDataFrame(rows, CLASHING).repartition(3)
    for limit in (1_000_000, 0):
        got = license_scan.places(license_scan.scan(docs, broadcast_rows=limit)).collect()
        assert len(got) == len(rows)
        want = []
        for doc_id, text, *_ in rows:
            w = words(text)
            found = {label: phrase_places(w, label) for label in ("mit", "apache", "gpl")}
            at = sorted(i for places in found.values() for i in places)
            labels = ",".join(sorted(label for label, places in found.items() if places))
            want.append((doc_id, len(w), len(at), at[0] if at else None, at[-1] if at else None, labels))
        columns = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
        assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(want, key=repr)


def test_notices_are_found_and_verified(spark):
    texts = license_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = {r["id"]: r for r in license_scan.scan(docs).collect()}
    labels = {k: r["labels"] for k, r in got.items()}
    assert labels["none"] == "" and got["none"]["score"] == 0
    assert labels["mit"] == labels["mit upper"] == labels["mit broken"] == "mit" and labels["mit half"] == ""
    assert labels["two"] == "bsd,isc" and labels["twice"] == "bsd" and len(got["twice"]["spans"]) == 2
    assert labels["cc"] == "cc-by-nc" and labels["gpl"] == "gpl" and labels["many"] == "mit" and len(got["many"]["spans"]) == 5000
    assert got["mit"]["score"] == 1 and 0.9 < got["mit broken"]["score"] < 1
    [span] = got["mit"]["spans"]
    assert words(texts["mit"])[span["start"] : span["end"]] == words(next(t.text for t in license_scan.TEMPLATES if t.text.startswith("Permission is")))
    [span] = got["mit broken"]["spans"]
    assert (span["start"], span["end"]) == (5, len(words(texts["mit broken"])))


def test_votes_count_the_grams_of_a_diagonal(spark):
    """The Spark join of grams against all pairs of positions in plain Python."""
    templates = (license_scan.Template("a", "one two three four five six seven eight nine"), license_scan.Template("b", "two three"))
    text = "zero one two three four five six six seven eight nine one two three four five two three"
    rows = spark.createDataFrame([(0, words(text))], "row long, words array<string>")
    listed = [words(t.text) for t in templates]
    want = defaultdict(list)
    w = words(text)
    for t, (expected, n) in enumerate(zip(listed, (license_scan.GRAM, license_scan.PHRASE_GRAM))):
        for p in range(len(w) - n + 1):
            for q in range(len(expected) - n + 1):
                if w[p : p + n] == expected[q : q + n]:
                    want[t, p - q].append(q)
    got = {(r["template"], r["diagonal"]): (r["first"], r["last"], r["votes"]) for r in license_scan.diagonals(rows, listed).collect()}
    gram = (license_scan.GRAM, license_scan.PHRASE_GRAM)
    assert got == {k: (min(v), max(v) + gram[k[0]] - 1, len(v)) for k, v in want.items()}


def test_license_scan_of_an_empty_table(spark):
    assert license_scan.places(license_scan.scan(spark.createDataFrame([], SCHEMA))).collect() == []
