"""The corpus operators against plain Python versions, on rows made to be awkward: nulls in
every column, empty and very long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pageloom.llm import chat_format, exact_dedup, jaccard_join, language_id, line_dedup, mixing, pii, quality, sentencepiece_match, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars int, "
    "id long, n string, size int, kept string, keep_id int, bucket int, digest string, fp int, found string, place int, number int"
)
CLASH = (7, "x", 1, "y", 3, 0, "z", 1, "f", 2, 5)


def made_rows() -> list[tuple]:
    random.seed(11)
    vocabulary = ["".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(2, 8))) for _ in range(300)]

    def words(n):
        return [random.choice(vocabulary) for _ in range(n)]

    passage = words(45)
    texts: list[str | None] = []
    for _ in range(25):
        w = words(random.randint(5, 120))
        texts.append(" ".join(w))
        if len(w) > 60:
            near = list(w)
            near[-1] = "changed"
            texts.append(" ".join(near))
            texts.append("\n".join(" ".join(w[i : i + 9]) for i in range(0, len(w), 9)))
        texts.append(" ".join(words(7) + passage + words(4)))
    texts += ["a b a b " * 40, "", "   \t\n", "one", "One", "o n e", "é ü ünï \U0001f600", " lead and tail ", "two  blanks", "x" * 5000, None]
    texts.append(" ".join(words(30_000)))  # very long
    texts.append("l1\nl2\nl3\n\nl1\nl2\nl3\nl4")
    rows = [(i, t, random.choice(["en", "de", None]), random.choice(["a", "b", "c", None]), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], rows[3]]  # rows repeated as a whole
    rows += [(None, texts[0], "en", "a", 1), (None, None, None, None, None)]
    rows += [(1000, texts[5], None, None, None), (1001, texts[5] + " ", "en", "a", 0)]
    random.shuffle(rows)
    return [r + CLASH for r in rows]


@pytest.fixture(scope="module")
def rows():
    return made_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    """Rows of one id, as a bag; the made rows repeat some ids as a whole."""
    out = defaultdict(list)
    for r in df.collect():
        out[r["id"]].append(tuple(r[c] for c in columns))
    return {k: sorted(v, key=repr) for k, v in out.items()}


# --- 1 -----------------------------------------------------------------------------


def shingles(text, n):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


@pytest.mark.parametrize(("words", "percent", "limits"), [(4, 85, {}), (5, 80, {}), (1, 50, {"region_docs": 8, "region_shingles": 400})])
def test_jaccard_classes(docs, rows, words, percent, limits, monkeypatch):
    if limits:  # regions beyond one task: pivots, windows and blocks
        monkeypatch.setattr(jaccard_join, "BLOCK", 5)
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    sets = {i: shingles(t, words) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    got = jaccard_join.jaccard_classes(docs, words=words, percent=percent, **limits)
    assert got.count() == len(rows)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in got.where("id IS NOT NULL").collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in ids}
    assert len(set(map(find, ids))) < len(ids)


# --- 2 -----------------------------------------------------------------------------


def test_line_dedup(docs, rows):
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    seen, want = set(), {}
    for i in sorted(texts):
        lines = texts[i].split("\n")
        full = [k for k, line in enumerate(lines) if WORD.search(line)]
        gone = set()
        for a, b in zip(full, full[1:]):
            if (lines[a], lines[b]) in seen:
                gone |= {a, b}
            seen.add((lines[a], lines[b]))
        want[i] = (len(full), len(gone), "\n".join(line for k, line in enumerate(lines) if k not in gone))
    got = by_id(line_dedup.cut_lines(docs).where("id IS NOT NULL"), "n_lines", "n_removed", "kept_text")
    assert {i: v[0] for i, v in got.items()} == want
    assert sum(map(len, got.values())) == sum(r[0] is not None for r in rows)
    assert any(w[1] for w in want.values())


# --- 3 -----------------------------------------------------------------------------


def test_mixing(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, per_source = Counter(), Counter()
    for r in rows:
        per_source[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted(s for s in per_source if s is not None) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    free, left, target = set(order), 1.5 * sum(per_source.values()), {}
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 2 * per_source[s]}
        if not over:
            target.update({s: share * weight[s] for s in free})
            break
        for s in over:
            target[s] = 2.0 * per_source[s]
            left -= target[s]
        free -= over
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["source_size"] == per_source[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in order:
        assert abs(taken[s] - target[s]) <= largest[s]
    key = ["id", "source", "size", "copies", "taken"]
    again = mixing.mix(docs.repartition(3)).select(key).collect()
    assert sorted(map(repr, again)) == sorted(repr(r) for r in mixing.mix(docs).select(key).collect())
    assert mixing.take(docs).columns == docs.columns
    assert mixing.take(docs).count() == sum(r["copies"] for r in got)


def test_mixing_is_unbiased_enough(spark):
    """Over many equal documents the taken part is the target's."""
    many = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', 10) AS text", "IF(id % 3 = 0, 'b', 'a') AS source")
    got = mixing.mix(many).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 20 for r in got)


# --- 4 -----------------------------------------------------------------------------


@pytest.mark.parametrize(("window", "seed"), [(20, 10), (5, 5), (3, 1)])
def test_substring_dedup(docs, rows, window, seed):
    texts = {r[0]: WORD.findall(r[1] or "") for r in rows if r[0] is not None}
    seen, want = set(), {}
    for i in sorted(texts):
        w, gone = texts[i], set()
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            if g in seen:
                gone.update(range(k, k + window))
            seen.add(g)
        want[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    got = substring_dedup.cut_repeats(docs, window=window, seed=seed)
    assert got.count() == len(rows)
    got = by_id(got.where("id IS NOT NULL"), "n_words", "n_removed", "kept_text")
    assert {i: v[0] for i, v in got.items()} == want


# --- 5 -----------------------------------------------------------------------------


def test_language_id(spark, docs, rows):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    got = language_id.identify(table, held_out).join(table.select(F.col("doc_id").alias("id"), "lang"), "id")
    right, total = got.where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").agg(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 100 and right / total > 0.95
    awkward = language_id.identify(docs, held_out).collect()
    assert len(awkward) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "und") for r in awkward)
    texts = {r[0]: r[1] for r in rows}
    for r in awkward:
        if r["id"] is not None and not re.search(r"[^\W\d_]", texts[r["id"]] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)


# --- 6 -----------------------------------------------------------------------------


def test_chat_format(spark):
    data = [
        (1, True, 0, "user", "q"), (1, True, 1, "assistant", "good"), (1, False, 0, "user", "q"), (1, False, 1, "assistant", "bad"),
        (2, True, 0, "user", "same"), (2, False, 0, "user", "same"),  # all is prompt
        (3, True, 0, "user", None), (3, True, 1, None, "x"),  # one side only
        (4, True, 0, "user", "a"), (4, True, 0, "user", "a"), (4, False, 0, "user", "a"),  # a repeated turn makes them differ
        (5, True, None, "user", "no number"), (5, False, None, "user", "no number"),
        (None, True, 0, "assistant", "lost"),
    ]
    turns = spark.createDataFrame([d + ("c", 1) for d in data], "pair_id long, chosen boolean, turn int, role string, text string, side string, border int")
    got = {}
    for r in chat_format.format_pairs(turns).collect():
        got.setdefault(r["pair_id"], []).append((r["side"], r["turn"], r["rendered"], r["learn"]))
    assert sorted(got[1]) == [
        ("chosen", 1, "<|assistant|>\ngood<|end|>\n", True), ("prompt", 0, "<|user|>\nq<|end|>\n", False),
        ("rejected", 1, "<|assistant|>\nbad<|end|>\n", True),
    ]
    assert got[2] == [("prompt", 0, "<|user|>\nsame<|end|>\n", False)]
    assert sorted(got[3]) == [("chosen", 0, "<|user|>\n<|end|>\n", False), ("chosen", 1, "<||>\nx<|end|>\n", False)]
    assert sorted(s for s, *_ in got[4]) == ["chosen", "chosen", "rejected"]
    assert sorted(s for s, *_ in got[5]) == ["chosen", "rejected"]
    assert got[None] == [("chosen", 0, "<|assistant|>\nlost<|end|>\n", True)]
    assert chat_format.format_pairs(turns.limit(0)).count() == 0


# --- 7 -----------------------------------------------------------------------------


def test_sentencepiece(docs, rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_match.DEFAULT_MODEL)
    got = sentencepiece_match.decode(sentencepiece_match.encode(docs)).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for r in got:
        if r["id"] is not None:
            assert r["decoded"] == texts[r["id"]]
            assert list(r["ids"]) == library.encode(texts[r["id"]])


# --- 8 -----------------------------------------------------------------------------


def base_counts(text):
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    repeated = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, r = len(words), len(repeated)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n


def test_quality(spark, docs, rows):
    got = quality.quality(docs).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for r in got:
        if r["id"] is not None:
            want = base_counts(texts[r["id"]])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
            assert not (r["base_failed"] and r["kept"])
    assert quality.keep_good(docs).columns == docs.columns


def test_perplexity_bands(spark):
    """Texts unlike their language leave a narrow band, ordinary ones stay in the wide one. The
    model has counted the texts it scores, which draws even noise near in a small corpus."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    random.seed(3)
    noise = [(10_000_000 + i, " ".join("".join(random.choice("qxzjvkw0123456789") for _ in range(9)) for _ in range(80)), "en") for i in range(5)]
    table = table.unionByName(spark.createDataFrame(noise, table.schema))
    narrow = quality.quality(table, width=2.0, least=0.1, short=1.0).where("id >= 10000000").collect()
    assert len(narrow) == 5 and not any(r["base_failed"] or r["kept"] for r in narrow)
    plain = quality.quality(table).where("id < 10000000 AND NOT base_failed").collect()
    assert sum(r["kept"] for r in plain) >= 0.97 * len(plain)


# --- 9 -----------------------------------------------------------------------------


def luhn(digits):
    doubled = [2 * int(d) if k % 2 else int(d) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def base_spans(text):
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(re.sub(r"\D", "", s)) <= 19 and luhn(re.sub(r"\D", "", s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub(r"[^0-9]", "", s)) <= 15),
    ]
    found = [(m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m.group())]
    return sorted(found)


def test_personal_data(spark):
    texts = [
        "write to ann.lee+x@mail.example.org or 10.0.0.256 and 192.168.1.77.", "card 4111 1111 1111 1111 or 4111 1111 1111 1112",
        "call +44 (0)20 7946-0958 now, +1 2 and +999999999999999999999", "\U0001f600 é a@b.c +1-202-555-0143", "", None, "1.2.3.4.5.6.7.8",
        "0" * 16, "99999999999999999999.1.1.1", "x@y", "my name is Ann Lee, call me " * 400,
    ]
    table = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in enumerate(texts)] + [(None, "a@b.c", 1, "s", 2)], "doc_id long, text string, start int, kind string, id int")
    found = pii.find_personal(table)
    got = pii.digest(found).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        want = base_spans((texts[r["id"]] if r["id"] is not None else "a@b.c") or "")
        count = Counter(s[3] for s in want)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(count[k] for k in ("email", "ip", "card", "phone"))
        joined = ",".join(f"{name}:{a}:{b}" for a, _, b, name in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


# --- 10 ----------------------------------------------------------------------------


@pytest.mark.parametrize("limits", [{}, {"fan_in": 2, "run_rows": 4}])
def test_exact_dedup(docs, rows, limits):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    want = []
    for text, members in groups.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        want += [(r[0], keep[0], len(members), hashlib.sha256(text.encode()).hexdigest()) for r in members]
    got = exact_dedup.exact_groups(docs, **limits).select("id", "keep_id", "group_size", F.lower(F.hex("digest")).alias("d"), "kept").collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(want, key=repr)
    assert sum(r["kept"] for r in got) == len(groups)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


# --- all ---------------------------------------------------------------------------


def test_empty_tables(empty):
    held_out = F.col("doc_id") % 2 == 0
    made = [
        jaccard_join.jaccard_classes(empty), line_dedup.cut_lines(empty), mixing.mix(empty), mixing.take(empty), substring_dedup.cut_repeats(empty),
        language_id.identify(empty, held_out), sentencepiece_match.decode(sentencepiece_match.encode(empty)), quality.quality(empty),
        pii.digest(pii.find_personal(empty)), exact_dedup.exact_groups(empty),
    ]
    assert [df.count() for df in made] == [0] * len(made)
