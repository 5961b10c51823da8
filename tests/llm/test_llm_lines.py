from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from clickmetrics.llm import line_dedup
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash_numbers_keys_from_zero(keys):
    keys = np.array(sorted(keys), dtype=np.uint64)
    numbers = line_dedup.PerfectHash.of(keys).numbers(keys)
    assert sorted(numbers.tolist()) == list(range(len(keys)))


def test_shard_arrays_tell_lines_apart():
    rng = np.random.default_rng(1)
    hash_1 = rng.integers(0, 2**64, 500, dtype=np.uint64)
    hash_1[7] = hash_1[3]  # two lines with one first hash
    hash_2 = rng.integers(0, 2**64, 500, dtype=np.uint64)
    counts = np.arange(500) + 10
    shard = line_dedup.LineShard.read(**line_dedup.LineShard.packed(hash_1, hash_2, counts))
    assert shard.count(hash_1, hash_2).tolist() == counts.tolist()
    others = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    assert not shard.count(others, others).any()
    assert not shard.count(hash_1, hash_2 + np.uint64(1)).any()


def test_arrays_take_the_bytes_stated():
    rng = np.random.default_rng(2)
    hash_1, hash_2 = (rng.integers(0, 2**64, line_dedup.SHARD_KEYS, dtype=np.uint64) for _ in range(2))
    packed = line_dedup.LineShard.packed(hash_1, hash_2, np.full(len(hash_1), 10))
    assert line_dedup.LineShard.read(**packed).nbytes < line_dedup.BYTES_PER_KEY * len(hash_1)


LINES = ["Common line", " common LINE\t", "other", "", "  ", "é Line", "É line", "x" * 3000]


@pytest.mark.parametrize(("min_docs", "at_once"), [(3, None), (5, 1), (2, 1)])
def test_matches_plain_dedup(documents, monkeypatch, min_docs, at_once):
    if at_once:  # many shards, that the hashes go to, each in parts
        monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)
        monkeypatch.setattr(line_dedup, "PROBE_ROWS", 7)
    rng = random.Random(min_docs)
    texts = ["\n".join(rng.choice(LINES + [f"own {rng.randrange(40)}"]) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    docs = documents(texts)
    found = line_dedup.dedup_lines(docs, min_docs, array_bytes=1 if at_once else 1 << 20)
    expected = brute.dedup_lines(texts, min_docs)
    rows = {r.doc_id: r for r in found.collect()}
    assert found.columns == [*docs.columns, "lines"]
    for i, text in enumerate(texts):
        assert rows[i].text == expected[i]
        lines = text.split("\n")
        assert rows[i].lines.n_lines == len(lines)
        kept = len(lines) - rows[i].lines.n_dropped
        assert expected[i].count("\n") + 1 == max(kept, 1)
        assert rows[i].plan == "p"


def test_edges(documents, edge_texts):
    docs = documents([*edge_texts, None, "same text", "Same Text\n"])
    rows = line_dedup.dedup_lines(docs, 4, into="size").select("doc_id", "text", "size.*").collect()
    texts = [*edge_texts, None, "same text", "Same Text\n"]
    assert len(rows) == len(texts)
    expected = brute.dedup_lines(texts, 4)
    for row in rows:
        assert (row.text is None) == (texts[row.doc_id] is None)
        assert (row.text or "") == expected[row.doc_id]
    assert {(r.text, r.n_lines, r.n_dropped) for r in rows if r.text is None} == {(None, 1, 0)}
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs, min_chars=0)


def test_hashes_sent_to_their_shards(documents, edge_texts, monkeypatch):
    """A text that a third of the rows have, rows without text, and a line that all others share."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 3)
    monkeypatch.setattr(line_dedup, "PROBE_ROWS", 20)
    shared = [f"shared\nown {i}\npart {i % 9}" for i in range(120)]
    texts = [*["copy\nof many\n\n one"] * 60, *edge_texts, None, *shared]
    docs = documents(texts)
    near, far = (line_dedup.dedup_lines(docs, 10, array_bytes=n) for n in (1 << 20, 1))
    expected = brute.dedup_lines(texts, 10)
    for found in (near, far):
        rows = {r.doc_id: r for r in found.collect()}
        assert len(rows) == len(texts)
        assert [rows[i].text or "" for i in range(len(texts))] == expected
        assert {r.text for r in rows.values() if texts[r.doc_id] is None} == {None}
    lines = line_dedup.frequent_lines(docs, 10, 1)
    tables = line_dedup.line_shards(lines, 3)
    listed = line_dedup.lines_at_shards(docs, tables, 3, 10, 1, "text").collect()
    touched = {t for t, e in zip(texts, expected) if (t or "") != e}
    assert len(listed) == len({(r.text_1, r.text_2) for r in listed}) == len(touched)
