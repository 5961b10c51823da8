from __future__ import annotations

import random

import numpy as np
import pytest
from brute import rebuilt, trie
from clickmetrics.llm.conversation_trie import (
    NODE_COLUMNS,
    Parentheses,
    conversation_paths,
    prefix_trie,
    with_common_heads,
)
from pyspark.sql import functions as F

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, key string, hash_1 string"


def rows_of(frame):
    return sorted(map(tuple, frame.select(*NODE_COLUMNS).collect()), key=str)


@pytest.fixture
def nodes(spark):
    def run(rows, turns_per_shard=250_000, heads=True, partitions=3):
        frame = spark.createDataFrame([(*row, "p", "k", "h") for row in rows], SCHEMA)
        paths = conversation_paths(frame.repartition(partitions))
        paths = with_common_heads(paths, every=100, lengths=6) if heads else paths
        return rows_of(prefix_trie(paths, turns_per_shard))

    return run


def random_depths(seed, size):
    draw, depths = random.Random(seed), [0]
    while len(depths) < size:
        depths.append(draw.randint(1, depths[-1] + 1) if draw.random() < 0.3 else depths[-1] + 1)
    return np.array(depths)


@pytest.mark.parametrize("size", [1, 2, 3, 40, 500, 5_000])
def test_parentheses(size):
    depths = random_depths(size, size)
    found, stack, parents = Parentheses(depths), [], []
    for node, depth in enumerate(depths.tolist()):
        del stack[depth:]
        parents.append(stack[-1] if stack else -1)
        stack.append(node)
    subtree, leaves = np.ones(size, dtype=int), np.array([0] * size)
    has_child = set(parents)
    for node in range(size - 1, -1, -1):
        leaves[node] += node not in has_child
        if node:
            subtree[parents[node]] += subtree[node]
            leaves[parents[node]] += leaves[node]
    assert found.parents().tolist() == parents
    assert found.subtree.tolist() == subtree.tolist()
    assert found.leaves().tolist() == leaves.tolist()
    values = np.arange(size)
    assert found.sums(values).tolist() == [sum(range(n, n + subtree[n])) for n in range(size)]


def made_up(seed, n, kinds=3, most=7):
    draw = random.Random(seed)
    return [
        (conv, turn, draw.choice(["user", "bot"]), "ab"[: draw.randrange(3)] * draw.randrange(kinds))
        for conv in range(n)
        for turn in range(draw.randrange(most))
    ]


@pytest.mark.parametrize(("turns_per_shard", "n"), [(1, 8), (20, 250), (250_000, 250)])
def test_like_a_dictionary_of_all_prefixes(nodes, turns_per_shard, n):
    rows = made_up(turns_per_shard, n)
    assert nodes(rows, turns_per_shard) == sorted(trie(rebuilt(rows)), key=str)


def test_a_common_start_and_copies_over_many_shards(nodes):
    rows = [(c, t, "user", "hello" if t == 0 else "same" if c % 2 else f"{c % 40}") for c in range(150) for t in range(3)]
    assert nodes(rows, 40) == sorted(trie(rebuilt(rows)), key=str)
    plain = nodes(rows, 40, heads=False)
    assert sorted(trie({c: [(r[2], r[3]) for r in rows if r[0] == c] for c in range(150)}), key=str) == plain
    assert next(row for row in plain if row[1] == 1)[3] == 150


def test_edges(nodes, spark):
    rows = [
        (None, 0, "user", "x"), (1, None, None, None), (1, 3, "user", ""), (1, 0, "user", "twice"),
        (1, 0, "user", "twice"), (2, 0, "user", "long " * 40_000), (302, 0, "user", "base is absent"),
        (100, 0, "a", "b"), (101, 5, "a", "é🙂"), (-3, 0, "a", "b"), (2**62, 0, "a", "b"), (250, None, "a", "b"),
    ] + [(7, turn, "user", f"turn {turn % 5}") for turn in range(300)]
    own = [row for row in rows if row[0] is None or row[0] >= 0]
    assert nodes(own, 60) == sorted(trie(rebuilt(own)), key=str)
    assert len(nodes(rows, 60)) > 300
    frame = spark.createDataFrame([(*row, "p", "k", "h") for row in rows[:1]], SCHEMA)
    assert prefix_trie(conversation_paths(frame)).count() == 0
    assert prefix_trie(conversation_paths(frame.limit(0))).count() == 0


def test_conversations_without_turns_are_members_of_the_root(spark):
    paths = spark.createDataFrame(
        [(c, []) for c in range(5)], "conv_id bigint, path array<struct<hash_1: bigint, hash_2: bigint, chars: int>>"
    )
    assert rows_of(prefix_trie(paths, 2)) == trie({c: [] for c in range(5)})


def test_query_over_the_whole_table(spark, sf_dir):
    from clickmetrics.llm.queries import op12_prefix_trie

    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = op12_prefix_trie(spark, sf_dir)
    assert rows_of(found) == sorted(trie(rebuilt(map(tuple, given.collect()))), key=str)
    assert found.agg(F.max("n_convs")).first()[0] == given.select("conv_id").distinct().count()
