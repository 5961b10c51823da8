from __future__ import annotations

import random
from collections import defaultdict

import brute
import numpy as np
import pytest
from clickmetrics.llm import simhash
from clickmetrics.llm.components import connected_components
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAÉ \n\x0b\xa0", max_size=60))
def test_fingerprints(text):
    assert simhash.fingerprint_of(text.encode()) == brute.fingerprint(text)


@pytest.mark.parametrize("blocks", [5, 6, 7, 8, 9])
def test_some_mask_misses_all_differing_bits(blocks):
    masks = simhash.block_masks(blocks, 4)
    rng = random.Random(blocks)
    for _ in range(300):
        difference = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not difference & mask for mask in masks)


def near(rng, value, most):
    for bit in rng.sample(range(64), rng.randint(0, most)):
        value ^= 1 << bit
    return value


def clouds(seed, sizes, spread):
    rng = random.Random(seed)
    values = set()
    for size in sizes:
        center = rng.getrandbits(64)
        values |= {near(rng, center, spread) for _ in range(size)}
    return sorted(values | {rng.getrandbits(64) for _ in range(60)})


def as_long(value):
    return value - (1 << 64) if value >> 63 else value


def groups_of(pairs):
    groups = defaultdict(set)
    for member, root in pairs:
        groups[root].add(member)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize(
    ("seed", "sizes", "spread", "small", "large"),
    [(1, [4, 9, 30], 3, 32, 4096), (2, [150, 90], 6, 8, 4096), (3, [220], 9, 4, 16)],
)
def test_links_join_what_all_pairs_join(spark, monkeypatch, seed, sizes, spread, small, large):
    values = clouds(seed, sizes, spread)
    linker = simhash._Linker(4)
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    monkeypatch.setattr(simhash, "LARGE_BUCKET", large)
    for mask in simhash.block_masks(5, 4):
        keys = np.array(values, dtype=np.uint64) & np.uint64(mask)
        order = np.argsort(keys, kind="stable")
        first = np.r_[0, np.flatnonzero(np.diff(keys[order])) + 1]
        linker.buckets(np.array(values, dtype=np.uint64)[order], first, 5)
    expected = groups_of(zip(values, brute.components(values)))
    assert groups_of((v, linker.root(v)) for v in values) == expected

    frame = spark.createDataFrame([(as_long(v),) for v in values], "fingerprint bigint").repartition(5)
    roots = dict(tuple(r) for r in connected_components(simhash.fingerprint_links(frame)).collect())
    found = groups_of((v, roots.get(as_long(v), as_long(v))) for v in values)
    assert found == expected


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)]
    links += [(200, 201), (201, 202), (202, 200), (-5, -9), (7, 7), (3, 2)]
    roots = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert {roots[i] for i in range(2, 41)} == {1}
    assert {roots[i] for i in range(101, 140)} == {100}
    assert (roots[201], roots[202], roots[-5]) == (200, 200, -9)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def variants(rng, n):
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(99)) for _ in range(120)) for _ in range(8)]
    texts = []
    for _ in range(n):
        words = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    return texts


def test_classes_match_brute_force(documents):
    texts = variants(random.Random(3), 70) + [None, "", " ", "One", "one"]
    values = [brute.fingerprint(t) for t in texts]
    expected = brute.components(values)
    rows = simhash.simhash_classes(documents(texts)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.fingerprint == as_long(values[row.doc_id])
        assert row.component_id == expected[row.doc_id]


def test_one_document_of_each_class_stays(documents):
    texts = variants(random.Random(4), 50) + ["alone here with its four words", None, ""]
    docs = documents([(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "s")] * 3)
    left = simhash.drop_near_copies(docs)
    roots = brute.components([brute.fingerprint(t) for t in texts])
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(roots))


def test_edges(documents, edge_texts):
    rows = simhash.simhash_classes(documents(edge_texts)).collect()
    assert len(rows) == len(edge_texts)
    assert {r.component_id for r in rows if not (edge_texts[r.doc_id] or "").strip()} == {0}
    no_ids = documents([(None, "a b c", "s"), (None, "a b c", "s"), (4, "x y z w v", None)])
    assert {r.component_id for r in simhash.simhash_classes(no_ids).collect()} == {None, 4}
    assert simhash.drop_near_copies(no_ids).count() == 2
    empty = documents(["x"]).limit(0)
    assert simhash.simhash_classes(empty).count() == simhash.drop_near_copies(empty).count() == 0


def test_query_over_the_whole_table(spark, sf_dir):
    from clickmetrics.llm.queries import op10_simhash

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(texts)
    values = [simhash.fingerprint_of((texts[i] or "").encode()) for i in ids]
    expected = {i: ids[root] for i, root in zip(ids, brute.components(values))}
    rows = op10_simhash(spark, sf_dir).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{v:016x}" for i, v in zip(ids, values)}
