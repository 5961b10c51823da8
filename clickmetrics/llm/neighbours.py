"""Approximate nearest neighbours by low-dimensional stable projections in a kd-tree.

Vectors of length 1 are projected to a few dimensions with normal random weights. For two vectors at
distance d, the squared distance of their projections is d squared times a chi-square variable. The
projections are indexed by a kd-tree: its upper levels deal the vectors into cells, one task each, and
every cell has a tree of its own. A query meets its projected neighbours in order of projected
distance, some at a time, and verifies them on the original vectors. It stops when a vector as near as
its k-th best would, with high probability, have been met by now.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmetrics.llm.common import written

#: More dimensions bring the bound nearer to the mean, so that fewer vectors are verified.
DIMENSIONS = 24
CERTAINTY = 0.96
LEAF_ROWS = 256
VERIFIED_AT_ONCE = 64
CELL_ROWS = 16_384
QUERIES_AT_ONCE = 8_192
SAMPLE_ROWS = 20_000
FOUND = "query_id long, vec_id long, score double, met long"


def chi_square_cdf(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= half / i
        total += term
    return 1.0 - math.exp(-half) * total


def chi_square_bound(certainty: float, degrees: int) -> float:
    """Where the distribution function reaches ``certainty``."""
    low, high = 0.0, 1.0
    while chi_square_cdf(high, degrees) < certainty:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < certainty else (low, middle)
    return high


def projected(vectors: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """Projections of the vectors scaled to length 1; the weights depend on the seed alone."""
    weights = np.random.default_rng([seed, vectors.shape[1]]).standard_normal(
        (vectors.shape[1], dimensions)
    )
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    return unit @ weights


@dataclass
class Splits:
    """The upper levels of the kd-tree: at node i, dimension and value; children 2i+1 and 2i+2.
    Cells are numbered from 0 along the bottom."""

    levels: int
    dims: np.ndarray
    values: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, levels: int) -> Splits:
        """Halve the sample along the widest dimension of each part."""
        nodes = (1 << levels) - 1
        dims, values = np.zeros(nodes, dtype=np.int64), np.zeros(nodes)
        parts = [points]
        for node in range(nodes):
            part = parts[node]
            if len(part):
                dims[node] = int(part.std(axis=0).argmax())
                values[node] = np.median(part[:, dims[node]])
            right = part[:, dims[node]] > values[node]
            parts += [part[~right], part[right]]
        return cls(levels, dims, values)

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.levels):
            right = points[np.arange(len(points)), self.dims[node]] > self.values[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.levels) - 1)

    def within(self, point: np.ndarray, radius: float) -> list[int]:
        """Cells that a ball around a point touches."""
        found, todo = [], [(0, np.zeros(len(point)))]
        bottom = (1 << self.levels) - 1
        while todo:
            node, gaps = todo.pop()
            if node >= bottom:
                found.append(node - bottom)
                continue
            dim, beyond = self.dims[node], point[self.dims[node]] - self.values[node]
            near, far = (2, 1) if beyond > 0 else (1, 2)
            todo.append((2 * node + near, gaps))
            wider = gaps.copy()
            wider[dim] = max(wider[dim], abs(beyond))
            if (wider * wider).sum() <= radius * radius:
                todo.append((2 * node + far, wider))
        return found


class CellTree:
    """The kd-tree of a cell, with projections and original vectors at its leaves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray) -> None:
        order = np.lexsort([ids])
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.parts: list[np.ndarray | tuple[int, int]] = []
        boxes: list[np.ndarray] = []
        self._build(np.arange(len(ids)), boxes)
        self.low, self.high = np.array(boxes).transpose(1, 0, 2)

    def _build(self, rows: np.ndarray, boxes: list[np.ndarray]) -> int:
        node, here = len(self.parts), self.points[rows]
        box = np.array([here.min(axis=0), here.max(axis=0)])
        self.parts.append(rows)
        boxes.append(box)
        if len(rows) > LEAF_ROWS:
            dim = int((box[1] - box[0]).argmax())
            order = np.argsort(here[:, dim], kind="stable")
            half = len(rows) // 2
            self.parts[node] = (
                self._build(rows[order[:half]], boxes),
                self._build(rows[order[half:]], boxes),
            )
        return node

    def nearest(
        self, query: int, vector: np.ndarray, point: np.ndarray, k: int, bound: float, most: float
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and cosines of the k best, best first, and how many vectors were verified.

        ``most`` is the squared distance of the best k known from elsewhere. Boxes and the projected
        neighbours of opened leaves wait in one queue by their squared distance from the
        projected query; neighbours are verified ``VERIFIED_AT_ONCE`` at a time. The stopping test is that
        the next distance is more than ``bound`` times the squared distance of the k-th best.
        """
        norm = math.sqrt((vector * vector).sum())
        gaps = np.maximum(0, np.maximum(self.low - point, point - self.high))
        gaps = (gaps * gaps).sum(axis=1).tolist()
        ids, scores, verified = np.array([], dtype=np.int64), np.array([]), 0
        queue = [(gaps[0], 0, None, None)]
        while queue:
            distance, node, rows, distances = heapq.heappop(queue)
            if distance > bound * most:
                break
            if rows is None and isinstance(self.parts[node], tuple):
                for child in self.parts[node]:
                    heapq.heappush(queue, (gaps[child], child, None, None))
                continue
            if rows is None:
                rows = self.parts[node]
                away = self.points[rows] - point
                distances = (away * away).sum(axis=1)
                near = np.flatnonzero((distances <= bound * most) & (self.ids[rows] != query))
                near = near[np.argsort(distances[near], kind="stable")]
                rows, distances = rows[near], distances[near]
            else:
                now = rows[:VERIFIED_AT_ONCE]
                rows, distances = rows[VERIFIED_AT_ONCE:], distances[VERIFIED_AT_ONCE:]
                cosines = (self.vectors[now] * vector).sum(axis=1) / (self.norms[now] * norm)
                verified += len(now)
                ids, scores = np.r_[ids, self.ids[now]], np.r_[scores, cosines]
                best = np.lexsort([ids, -scores])[:k]
                ids, scores = ids[best], scores[best]
                if len(ids) == k:
                    most = min(most, max(0.0, 2 - 2 * scores[-1]))
            if len(rows):
                heapq.heappush(queue, (float(distances[0]), node, rows, distances))
        return ids, scores, verified


def taking_part(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part, vectors as doubles, repeated rows once."""
    doubles = F.col(vector).cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    some = F.exists(doubles, lambda x: x != 0)
    return (
        vectors.select("vec_id", doubles.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & some)
        .withColumns(dict(zip(KEYS, _vector_keys())))
        .dropDuplicates(["vec_id", *KEYS])
    )


KEYS = ("key_1", "key_2")


def _vector_keys() -> list[Column]:
    return [F.xxhash64("vector"), F.xxhash64(F.lit("second"), F.col("vector"))]


def candidates(vectors: DataFrame, k: int) -> DataFrame:
    """Of equal vectors only the ``k + 1`` with the smallest ids can be among anyone's k nearest,
    so the others need not be looked at. Spark limits the groups before it shuffles them."""
    place = F.row_number().over(Window.partitionBy(*KEYS).orderBy("vec_id"))
    return vectors.withColumn("place", place).filter(F.col("place") <= k + 1).drop("place")


@dataclass
class CellIndex:
    """How vectors are dealt into cells: splits for each length of vector that the sample had."""

    splits: dict[int, Splits]
    dimensions: int
    seed: int

    @classmethod
    def fit(
        cls, vectors: DataFrame, dimensions: int, seed: int, cell_rows: int, sample_rows: int
    ) -> CellIndex:
        """Split values come from at most ``sample_rows`` vectors; all vectors are dealt by them.
        Vectors of one length are searched among themselves."""
        rows = vectors.count()
        fraction = min(1.0, 1.2 * sample_rows / max(rows, 1))
        sample = vectors.select("vector").sample(fraction, seed).limit(sample_rows).collect()
        lengths = {len(row.vector) for row in sample}
        levels = max(0, math.ceil(math.log2(max(rows, 1) / cell_rows)))
        splits = {}
        for length in lengths:
            chosen = np.array([row.vector for row in sample if len(row.vector) == length])
            splits[length] = Splits.fit(projected(chosen, dimensions, seed), levels)
        return cls(splits, dimensions, seed)

    def placed(self, frame: DataFrame, more: str, radius_of=None) -> DataFrame:
        """Add each row's projection and cell, as ``point`` and ``cell``; the cell is named by the
        vector's length and its number. With ``radius_of`` a row goes to all cells within that
        distance, but for its own."""
        splits, dimensions, seed = self.splits, self.dimensions, self.seed

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lengths = batch.column("vector").value_lengths().to_numpy()
                for length in np.unique(lengths).tolist():
                    part = batch.take(pa.array(np.flatnonzero(lengths == length)))
                    points = projected(_matrix(part.column("vector")), dimensions, seed)
                    tree = splits.get(length)
                    cells = tree.cells(points) if tree else np.zeros(len(points), dtype=np.int64)
                    rows = np.arange(len(points))
                    if radius_of is not None:
                        reached = [
                            [c for c in tree.within(point, radius) if c != own] if tree else []
                            for point, radius, own in zip(points, radius_of(part), cells)
                        ]
                        rows = np.repeat(rows, [len(r) for r in reached])
                        cells = np.array([c for r in reached for c in r], dtype=np.int64)
                    named = pa.array([f"{length}:{cell}" for cell in cells.tolist()], pa.string())
                    part = part.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(list(points[rows]), pa.list_(pa.float64())), named],
                        [*part.schema.names, "point", "cell"],
                    )

        return frame.mapInArrow(place, f"{more}, point array<double>, cell string")


def _matrix(column) -> np.ndarray:
    """A column of lists of one length as rows."""
    flat = pa.chunked_array([column]) if isinstance(column, pa.Array) else column
    values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in flat.chunks])
    return values.reshape(len(column), -1)


def _search(k: int, certainty: float, dimensions: int):
    bound = chi_square_bound(certainty, dimensions)

    def search(index: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if len(index) and len(queries):
            tree = CellTree(
                index["vec_id"].to_numpy(), _matrix(index["vector"]), _matrix(index["point"])
            )
            asked = zip(
                queries["vec_id"].to_numpy().tolist(),
                _matrix(queries["vector"]),
                _matrix(queries["point"]),
                queries["most"].to_numpy().tolist(),
            )
            for query, vector, point, most in asked:
                ids, scores, verified = tree.nearest(query, vector, point, k, bound, most)
                met = np.zeros(len(ids), dtype=np.int64)
                met[:1] = verified
                found.append((np.full(len(ids), query, dtype=np.int64), ids, scores, met))
        columns = [np.concatenate(part) for part in zip(*found)] if found else [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
        return pa.table(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)],
            ["query_id", "vec_id", "score", "met"],
        )

    return search


def nearest_vectors(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vector: str = "embedding",
    dimensions: int = DIMENSIONS,
    certainty: float = CERTAINTY,
    seed: int = 11,
    cell_rows: int = CELL_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The ``k`` vectors found nearest by cosine to each query: query_id, rank, vec_id, score, and
    ``n_verified``, how many vectors the query was compared with.

    Queries are the rows where ``is_query`` holds; all rows but a query's own are candidates. Scores
    are cosines of the original vectors in double precision, ties go to the smaller vec_id. With
    fewer candidates than ``k`` all are returned. Rows without vec_id, and vectors that are null,
    empty, zero, or hold a null or non-finite component, take no part; vectors of another length
    are not compared. Rows that repeat an id and its vector are one. An empty table gives no rows;
    columns beside the two are not looked at.

    The index is approximate: a true neighbour is missed with a probability of at most
    1 - ``certainty``, by the stopping test. A query first searches its own cell. The k-th best there
    bounds the distance at which other cells can matter, and it goes on to those within. A cell meets
    its queries in blocks of bounded size; equal vectors do not crowd a cell.
    """
    part = written(taking_part(vectors, vector), "vectors")
    index = CellIndex.fit(part, dimensions, seed, cell_rows, sample_rows)
    placed_type = "vec_id long, vector array<double>"
    cells = written(
        index.placed(candidates(part, k).select("vec_id", "vector"), placed_type), "cells"
    )
    queries = written(
        part.filter(is_query).select("vec_id", "vector", F.lit(float("inf")).alias("most")), "queries"
    )
    blocks = max(1, -(-queries.count() // QUERIES_AT_ONCE))

    def searched(asked: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
        meeting = cells.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return (
            meeting.withColumn("block", F.col("block").cast("long"))
            .groupBy("cell", "block")
            .cogroup(asked.withColumn("block", block).groupBy("cell", "block"))
            .applyInArrow(_search(k, certainty, dimensions), FOUND)
        )

    query_type = f"{placed_type}, most double"
    home = written(searched(index.placed(queries, query_type)), "home-cells")
    worst = (
        home.groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("kth"))
        .filter(F.col("found") >= k)
        .select("query_id", F.greatest(F.lit(0.0), 2 - 2 * F.col("kth")).alias("most_here"))
    )
    further = queries.join(worst, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", "vector", F.coalesce("most_here", "most").alias("most")
    )
    bound = chi_square_bound(certainty, dimensions)
    away = index.placed(
        further, query_type, lambda rows: np.sqrt(bound * rows.column("most").to_numpy())
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        home.union(searched(away))
        .withColumn("rank", F.row_number().over(best))
        .withColumn("n_verified", F.sum("met").over(Window.partitionBy("query_id")))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score", "n_verified")
    )
