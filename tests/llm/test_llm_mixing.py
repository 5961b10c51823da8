from __future__ import annotations

import random
from collections import Counter

import brute
import pytest
from clickmetrics.llm import mixing
from clickmetrics.llm.common import word_count, words_counted


def table_of(rng, n, sources):
    return [
        (i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40, 300]))) or rng.choice(["", None]), rng.choice(sources))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_plan_matches_one_sorted_list(documents, seed):
    rng = random.Random(seed)
    docs = table_of(rng, 150, ["a", "b", "c", "d", None, "big", "big", "big", "big"])
    copies, sizes, size_of, target = brute.mix(docs)
    rows = mixing.mix_plan(documents(docs)).collect()
    assert len(rows) == len(docs)
    for row in rows:
        assert row.size == sizes[row.doc_id]
        assert row.source_size == size_of[row.source]
        assert row.target == pytest.approx(target[row.source], rel=1e-12)
        assert row.copies == copies[row.doc_id]
        assert row.taken == row.copies * row.size <= 3 * row.size
    taken = Counter()
    for row in rows:
        taken[row.source] += row.taken
    for source, words in taken.items():
        assert abs(words - target[source]) <= max(sizes)
    assert sum(taken.values()) <= sum(sizes)


def test_targets_share_out_what_capped_sources_leave(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 990)], "source string, source_size bigint")
    found = {r.source: r.target for r in mixing.source_targets(sources).collect()}
    assert found["a"] == 30
    assert found["b"] == pytest.approx(1970 * 2 / 3)
    assert found["c"] == pytest.approx(1970 / 3)


def test_reruns_and_partitions_agree(documents):
    docs = table_of(random.Random(9), 80, ["a", "b", None])
    plans = [
        sorted(mixing.mix_plan(documents(docs, n)).select("doc_id", "taken", "target").collect())
        for n in (1, 2, 7)
    ]
    assert plans[0] == plans[1] == plans[2]


def test_one_source_is_taken_once(documents):
    docs = [(i, "a b c", "only") for i in range(10)]
    assert {r.copies for r in mixing.mix_plan(documents(docs)).collect()} == {1}


def test_edges(documents, edge_texts):
    rows = mixing.mix_plan(documents(edge_texts)).collect()
    assert len(rows) == len(edge_texts)
    assert sum(r.taken for r in rows) == rows[0].source_size
    assert mixing.mix_plan(documents(["x"]).limit(0)).count() == 0
    blank = mixing.mix_plan(documents([None, "", " "])).collect()
    assert [(r.target, r.taken) for r in blank] == [(0.0, 0)] * 3


def test_the_mix_holds_each_document_as_often_as_planned(documents):
    docs = table_of(random.Random(5), 60, ["a", "b", "c", None])
    docs += [docs[3], docs[3], (None, "no id here", "a"), (None, "no id here", "a")]
    frame = documents(docs)
    planned = Counter()
    for row in mixing.mix_plan(frame).collect():
        planned[row.doc_id] += row.copies
    mixed = mixing.mix_documents(frame)
    assert mixed.columns == frame.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +planned


def test_words_are_counted_alike_by_bytes_and_by_pattern(spark):
    texts = ["", " ", "one", " one\ttwo\n", "a\x0bb\x0cc\rd", "é\u00a0ü \u2003 x", "x" * 50, None, "end ", "z y" * 40]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string").coalesce(1)
    for at_once in (1, 7, 1 << 20):
        both = docs.select(word_count().alias("a"), words_counted(bytes_at_once=at_once).alias("b")).collect()
        assert len(both) == len(docs.collect()) and all(row.a == row.b for row in both)
    assert docs.limit(0).select(words_counted()).count() == 0
