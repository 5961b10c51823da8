from __future__ import annotations

import math

from pathlib import Path

import numpy as np
import pytest
from clickmetrics.llm import neighbours as nn
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>, vector string, cell string, point int"


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(*row, "v", "c", 1) for row in rows], SCHEMA).repartition(3)

    return make


def search(frame, **options):
    options = {"k": 3, **options}
    found = {}
    for row in nn.nearest_vectors(frame, F.col("vec_id") % 10 == 0, **options).collect():
        found.setdefault(row.query_id, {})[row["rank"]] = (row.vec_id, row.score)
    for ranks in found.values():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))
    return {query: [ranks[i] for i in sorted(ranks)] for query, ranks in found.items()}


def brute(rows, k, query):
    rows = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    q = rows[query]
    scores = [
        (-float((q * v).sum() / math.sqrt((q * q).sum()) / math.sqrt((v * v).sum())), i)
        for i, v in rows.items()
        if i != query and len(v) == len(q)
    ]
    return [(i, -s) for s, i in sorted(scores)[:k]]


def test_chi_square():
    assert nn.chi_square_cdf(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    assert nn.chi_square_bound(0.95, 8) == pytest.approx(15.507, abs=1e-2)


@pytest.mark.parametrize("cell_rows", [10_000, 50])
def test_recall_against_brute_force(vectors, cell_rows, monkeypatch):
    monkeypatch.setattr(nn, "LEAF_ROWS", 16)
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(400)]
    found = search(vectors(rows), k=5, cell_rows=cell_rows)
    hits = 0
    for query in range(0, 400, 10):
        best = brute(rows, 5, query)
        hits += len({i for i, _ in best} & {i for i, _ in found[query]})
        for vec_id, score in found[query]:
            assert score == pytest.approx(dict(brute(rows, 400, query))[vec_id], abs=1e-12)
    assert hits >= 0.9 * 200


@pytest.mark.parametrize("scale", [None, "sf0.1"])
def test_recall_and_work_over_the_whole_given_table(spark, sf_dir, scale):
    from clickmetrics.llm.queries import op8_nearest

    folder = str(Path(sf_dir).parent / scale) if scale else sf_dir
    if not Path(folder, "embeddings.parquet").exists():
        pytest.skip("no such table")
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    unit = np.array([r.embedding for r in rows], dtype=float)
    unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
    found = {}
    for row in op8_nearest(spark, folder).collect():
        found.setdefault(row.query_id, []).append(row)
    queries = np.flatnonzero(ids % 50 == 0)
    assert set(found) == set(ids[queries].tolist())
    hits = 0
    for query in queries:
        scores = unit @ unit[query]
        scores[query] = -2
        best = ids[np.lexsort([ids, -scores])[:5]].tolist()
        hits += len({r.vec_id for r in found[ids[query]]} & set(best))
    assert hits >= 0.9 * 5 * len(queries)
    if scale:
        verified = sum(found[ids[query]][0].n_verified for query in queries)
        assert verified <= 0.75 * len(queries) * len(ids)


def test_clear_groups_are_not_all_met():
    rng = np.random.default_rng(6)
    centers = rng.standard_normal((20, 32))
    rows = np.repeat(centers, 200, axis=0) + 0.05 * rng.standard_normal((4000, 32))
    points = nn.projected(rows, nn.DIMENSIONS, 11)
    tree = nn.CellTree(np.arange(4000), rows, points)
    bound = nn.chi_square_bound(nn.CERTAINTY, nn.DIMENSIONS)
    ids, scores, verified = tree.nearest(0, rows[0], points[0], 5, bound, float("inf"))
    cosines = rows @ rows[0] / np.sqrt((rows * rows).sum(axis=1) * (rows[0] @ rows[0]))
    cosines[0] = -2
    assert len(set(ids) & set(np.argsort(-cosines)[:5])) >= 4
    assert verified <= 200
    near = 2 - 2 * scores[-1]
    assert tree.nearest(0, rows[0], points[0], 5, bound, near / 100)[2] < 10


def test_one_common_vector(vectors):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(60)] + [(i, [float(i), 1.0, 0.0]) for i in range(60, 90)]
    found = search(vectors(rows), k=3, cell_rows=8)
    assert [i for i, _ in found[0]] == [1, 2, 3]
    assert [i for i, _ in found[50]] == [0, 1, 2]
    assert len({score for _, score in found[50]}) == 1


def test_edges(vectors):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]),
        (6, [1.0, None]), (7, [inf, 1.0]), (None, [1.0, 0.5]), (10, [0.0, 0.0]), (20, [1.0, 2.0, 3.0]), (30, [-1.0, 0.0]),
    ]
    found = search(vectors(rows))
    assert [i for i, _ in found[0]] == [1, 30]
    assert found[0][0][1] == pytest.approx(math.sqrt(0.5))
    assert found[0][1][1] == -1.0
    assert set(found) == {0, 30}
    assert search(vectors(rows).limit(0)) == {}
