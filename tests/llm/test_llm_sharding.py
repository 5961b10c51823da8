from __future__ import annotations

import random
import zlib
from collections import defaultdict
from itertools import groupby

import pytest
from clickmetrics.llm import sharding


def least_capacity(sizes, shards):
    """Smallest largest piece of cutting a list into at most so many pieces, by dynamic programming."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [
            0 if not end else min(max(best[cut], sum(sizes[cut:end])) for cut in range(end))
            for end in range(len(sizes) + 1)
        ]
    return best[-1]


def check(rows, texts, shards):
    """Sizes, groups, slots, and that no other cut of this order is better."""
    assert len(rows) == len(texts)
    by_shard = defaultdict(list)
    for row in rows:
        data = (texts[row.doc_id] or "").encode()
        assert (row.size, row.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert (row.law, row.grown_shard) == ("bytes", None)
        by_shard[row.shard].append(row)
    assert set(by_shard) <= set(range(shards))
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    in_order = sorted(rows, key=lambda r: (r.shard, r.slot))
    groups = [list(g) for _, g in groupby(in_order, key=lambda r: texts[r.doc_id] or "")]
    assert len(groups) == len({t or "" for t in texts.values()}), "equal texts stand together"
    assert all(len({r.shard for r in group}) == 1 for group in groups)
    sizes = [sum(r.size for r in group) for group in groups]
    largest = max(sum(r.size for r in members) for members in by_shard.values())
    assert largest == least_capacity(sizes, shards)


@pytest.mark.parametrize(("seed", "window"), [(1, 1 << 20), (2, 40), (3, 1)])
def test_the_largest_shard_is_as_small_as_can_be(documents, monkeypatch, seed, window):
    monkeypatch.setattr(sharding, "WINDOW", window)
    monkeypatch.setattr(sharding.GroupEnds, "window", window)
    rng = random.Random(seed)
    texts = {i: "ab" * rng.choice([0, 1, 3, 20, 90]) + str(rng.randrange(30)) for i in range(90)}
    docs = documents([(i, text, "s") for i, text in texts.items()])
    check(sharding.shard_documents(docs, 5).collect(), texts, 5)


def test_a_group_with_most_documents(documents):
    texts = {i: "hot" if i % 3 else f"text {i}" for i in range(60)}
    docs = documents([(i, text, "s") for i, text in texts.items()])
    check(sharding.shard_documents(docs, 4).collect(), texts, 4)


def test_edges(documents, edge_texts):
    texts = dict(enumerate(edge_texts))
    rows = sharding.shard_documents(documents(edge_texts)).collect()
    check(rows, texts, 16)
    assert sharding.shard_documents(documents(["x"]).limit(0)).count() == 0
    repeated = sharding.shard_documents(documents([(1, "a", "s")] * 5 + [(None, None, None)] * 2)).collect()
    assert sorted((r.size, r.slot) for r in repeated) == [(1, 0), (1, 1), *[(2, i) for i in range(5)]]


def test_arrival_does_not_matter(documents):
    texts = [f"text {i % 17}" for i in range(50)]
    results = [sorted(sharding.shard_documents(documents(texts, n), 3).collect()) for n in (1, 4)]
    assert results[0] == results[1]


def test_query_over_the_whole_table(spark, sf_dir):
    from clickmetrics.llm.queries import op5_shard

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op5_shard(spark, sf_dir).collect()
    load = defaultdict(int)
    for row in rows:
        load[row.shard] += row.size
    assert len(rows) == len(texts) and set(load) == set(range(16))
    assert max(load.values()) <= sum(load.values()) / 16 + max(r.size for r in rows) * 10
