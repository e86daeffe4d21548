"""The stages of the corpus pipeline, each against a plain Python version on its own input,
and the registration of the queries."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from test_llm_operators import WORD, base_counts, shingles

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """(docs in, rows out) of every stage."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache(), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_DIR).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        out.append((docs.collect(), after.collect()))
        docs = after
    return out


def test_quality_stage(steps):
    before, after = steps[0]
    fail = {r["doc_id"] for r in before if base_counts(r["text"] or "")[5]}
    kept = {r["doc_id"] for r in after}
    assert not kept & fail
    assert len(kept) >= 0.95 * (len(before) - len(fail))


def test_exact_stage(steps):
    before, after = steps[1]
    groups = defaultdict(list)
    for r in before:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")].append((-len(r["text"] or ""), r["doc_id"]))
    assert sorted(r["doc_id"] for r in after) == sorted(min(g)[1] for g in groups.values())


def test_near_stage(steps):
    before, after = steps[2]
    sets = {r["doc_id"]: shingles(r["text"], 5) for r in before}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert sorted(r["doc_id"] for r in after) == sorted({find(i) for i in ids})


def test_mixing_stage(steps):
    before, after = steps[3]
    times = Counter(r["doc_id"] for r in after)
    sizes = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in before}
    assert set(times) <= set(sizes) and max(times.values()) <= 2
    taken = sum(sizes[i] * n for i, n in times.items())
    sources = len({r["source"] for r in before})
    assert abs(taken - 1.5 * sum(sizes.values())) <= sources * max(sizes.values())


def test_encoding_stage(steps):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    before, after = steps[4]
    want = Counter((r["doc_id"], tuple(library.encode(r["text"] or ""))) for r in before)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in after) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in after)


def test_every_query_is_registered():
    found = entry_points.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {re.match(r"op\d+_", name).group() for name in found if name.startswith("op")}
    assert "pipeline" in found and set(entry_points.oracle_sql()) <= set(found)


# names that the operators use inside, as columns of the user, with values that must come through
USERS = [
    "id", "source_", "size", "copies", "nth", "key", "digest", "kept", "kept_key", "kept_digest", "stays", "judged", "planned_id",
    "planned_source", "planned_size", "_id", "_n", "_nth", "_size", "_source", "_digest", "_copies", "n", "component_id", "position",
]
AWKWARD = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in USERS)


def awkward_rows():
    users = [f"own {c}" for c in USERS]
    good = [" ".join(f"w{i}x{k} and the{i}" for k in range(15)) for i in range(12)]
    rows = [(i, t, "en", f"s{i % 3}", *users) for i, t in enumerate(good)]
    rows += [
        (20, None, "en", "s0", *users), (21, "", "en", "s0", *users), (22, " \n\t ", None, None, *users),
        (None, good[0] + " more", None, None, *users), (23, "x" * 200_000, "en", "s1", *users), (24, good[1].replace(" ", "\n"), "", "", *users),
    ]
    return rows + rows[:2]  # rows that repeat as a whole


@pytest.mark.parametrize("number", range(4))
def test_stages_keep_clashing_columns(spark, number):
    _, stage = corpus_pipeline.STAGES[number]
    docs = spark.createDataFrame(awkward_rows(), AWKWARD).repartition(3)
    after = stage(spark, docs, SF_DIR)
    assert after.columns == docs.columns
    rows = after.collect()
    assert rows and all([r[c] for c in USERS] == [f"own {c}" for c in USERS] for r in rows)
    given = Counter((r[0], r[1]) for r in awkward_rows())
    assert set((r["doc_id"], r["text"]) for r in rows) <= set(given)
    ids = Counter(r["doc_id"] for r in rows)
    if number == 1:  # of equal texts the longest, then the smallest id; of whole repeats one
        assert ids == Counter([*range(12), 22, 23, None])
    if number == 2:  # no text, no link
        assert {20, 21, 22} <= set(ids)


@pytest.mark.parametrize("number", range(5))
def test_stages_on_empty_table(spark, number):
    docs = spark.createDataFrame([], AWKWARD)
    assert corpus_pipeline.STAGES[number][1](spark, docs, SF_DIR).collect() == []
