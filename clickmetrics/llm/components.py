"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """The least node that each linked node can reach: (node, root), for (a, b) longs.

    Rounds of large stars and small stars: each node sends its larger neighbours, then itself and
    its smaller ones, to the least of them, until every node points at its root. Least neighbours are
    aggregated before the shuffle and joined one to many, so a node with many links is a long
    side of a join that adaptive execution splits. Each round is written to the shared folder.
    """
    stars = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a != b")
        .distinct(),
        "links",
    )
    before = _digest(stars)
    while True:
        stars = written(_small_stars(_large_stars(stars)), "links")
        after = _digest(stars)
        if after == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def _digest(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum(F.col("b").cast("decimal(20,0)"))
        ).collect()[0]
    )


def _least(links: DataFrame, node: str, neighbour: str) -> DataFrame:
    return links.groupBy(F.col(node).alias("of")).agg(F.min(neighbour).alias("least"))


def _large_stars(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    joined = both.join(_least(both, "a", "b"), F.col("a") == F.col("of"))
    return joined.filter("b > a").select(
        F.col("b").alias("a"), F.least("a", "least").alias("b")
    ).distinct()


def _small_stars(links: DataFrame) -> DataFrame:
    least = _least(links, "a", "b")
    moved = links.join(least, F.col("a") == F.col("of")).filter("b != least")
    return (
        moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .union(least.select("of", "least"))
        .distinct()
    )
