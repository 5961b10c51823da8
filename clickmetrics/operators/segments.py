"""Customer segments: K-means over how often users act and how much they spend."""

from __future__ import annotations

import logging
import math
import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmetrics.config import SEGMENT_LABELS, AnalyticsConfig
from clickmetrics.functions import money
from clickmetrics.operators.activity import AMOUNT, DATED_EVENTS, as_activity
from clickmetrics.session import in_shared_folder

log = logging.getLogger(__name__)

FEATURES = ("frequency", "monetary")
WEIGHT = "weight"
MILLION = 1_000_000.0
#: Points that a task of a fit has: at least so many where there are cores to spare, and at most.
FEWEST_PER_TASK, MOST_PER_TASK = 10_000, 250_000
MODEL_SCHEMA = (
    "segment_id int, label string, frequency double, spend double, frequency_spread double, "
    "spend_spread double, cost double"
)


def segment_features(events: DataFrame, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Dated events and total amount per user; a user without any amount keeps a null."""
    return as_activity(events).groupBy("user_id").agg(
        F.sum(DATED_EVENTS).alias("frequency"),
        money(F.sum(AMOUNT), config.money_digits).alias("monetary"),
    )


def segment_features_scaled(features: DataFrame, digits: int | None = None) -> DataFrame:
    """Features with nulls as zero, shifted to mean 0 and divided by the population deviation.

    Mean and deviation are scalar subqueries over the same grouped frame, so the shuffle
    of the features is computed once and reused. A feature that never varies becomes zero. ``digits`` rounds
    the result.
    """
    filled = features.fillna(0, subset=list(FEATURES))

    def scaled(name: str) -> Column:
        mean = filled.agg(F.avg(name)).scalar()
        deviation = filled.agg(F.stddev_pop(name)).scalar()
        spread = F.coalesce(F.nullif(deviation, F.lit(0.0)), F.lit(1.0))
        value = (F.col(name) - mean) / spread
        return (value if digits is None else F.round(value, digits)).alias(f"{name}_scaled")

    return filled.select("user_id", *map(scaled, FEATURES))


@dataclass(frozen=True)
class Center:
    """The mean of a segment, spend in millionths."""

    segment_id: int
    label: str | None
    frequency: float
    spend: float


@dataclass(frozen=True)
class SegmentModel:
    """Fitted centers in order of spend, and the deviations that distances are measured in; scores new
    users too. ``cost`` is the sum of squared distances of the users it was fitted to."""

    centers: tuple[Center, ...]
    spreads: tuple[float, float]
    cost: float

    def transform(self, features: DataFrame) -> DataFrame:
        """Features with ``segment_id`` and ``segment_label``; ``monetary`` stays as given."""
        means = [(center.frequency, center.spend) for center in self.centers]
        nearest = _nearest(means, self.spreads, *_coordinates())
        scored = features.select("user_id", *FEATURES, nearest.alias("segment_id"))
        labels = {center.segment_id: center.label for center in self.centers}
        return scored.withColumn("segment_label", _lookup(F.col("segment_id"), labels))

    def save(self, path: str) -> None:
        """Add the model to a folder as its newest version. A version is one file that Spark moves
        into place when it is whole, so a save that breaks off leaves the version before."""
        spark = SparkSession.active()
        rows = [
            (c.segment_id, c.label, c.frequency, c.spend, *self.spreads, self.cost) for c in self.centers
        ]
        version = f"{path}/version={time.time_ns():020d}"
        spark.createDataFrame(rows, MODEL_SCHEMA).coalesce(1).write.parquet(version)

    @classmethod
    def load(cls, path: str) -> SegmentModel:
        """The newest version in a folder."""
        stored = SparkSession.active().read.schema(f"{MODEL_SCHEMA}, version string").parquet(path)
        newest = stored.agg(F.max("version")).first()[0]
        if newest is None:
            raise ValueError(f"no segment model in {path}")
        rows = stored.filter(F.col("version") == newest).orderBy("segment_id").collect()
        centers = tuple(Center(r.segment_id, r.label, r.frequency, r.spend) for r in rows)
        return cls(centers, (rows[0].frequency_spread, rows[0].spend_spread), rows[0].cost)


@dataclass(frozen=True)
class Segmentation:
    model: SegmentModel
    users: DataFrame


def fit_segments(
    features: DataFrame, config: AnalyticsConfig = AnalyticsConfig()
) -> Segmentation | None:
    """Cluster users and label the clusters by mean spend; None with fewer users than clusters.

    K-means over both features in units of their deviation, the best of several starts. Segments are
    numbered from the lowest mean spend up; one without any spend comes last. Fewer distinct users
    than clusters give fewer segments.

    Features are stored first: training passes over them many times, and a lost executor must not send
    it back to the event log. Users with equal features are one point with a weight, spend counts by
    millionths, and all sums are of whole numbers, so neither the order of users nor their
    partitions can change the result, and nothing is sorted. Each pass is one job for all starts; the
    driver gets a row per start and cluster. Sums are bigints: an error stops a fit that exceeds them.
    """
    staged = in_shared_folder(features, "features")
    frequency, spend = _coordinates()
    points = staged.groupBy(frequency.alias("f"), spend.alias("m")).agg(
        F.count(F.lit(1)).alias(WEIGHT), F.count("monetary").alias("paid")
    )
    points = _spread_out(in_shared_folder(points, "points")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = _fitted(points, config)
    finally:
        points.unpersist()
    if model is None:
        log.warning("fewer users than the %d segments asked for", config.segment_count)
        return None
    return Segmentation(model, model.transform(staged))


def segment_check(users: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Figures in one row that tell whether segmented users are a proper K-means result: users,
    segments, their spend, ``misplaced`` users to whom another segment's mean is nearer by
    more than ``tolerance``, and ``disordered`` segments that spend less than one named lower.

    Distances are between features scaled to deviation 1. The means are one row per segment.
    """
    filled = users.fillna(0, subset=["monetary"]).select(
        "user_id", "segment_id", "segment_label", "monetary", "frequency"
    )
    spread = filled.agg(*[F.stddev_pop(name).alias(f"{name}_spread") for name in FEATURES]).first()
    for name in FEATURES:
        filled = filled.withColumn(f"{name}_scaled", F.col(name) / (spread[f"{name}_spread"] or 1.0))
    coordinates = [f"{name}_scaled" for name in FEATURES]
    centers = (
        filled.groupBy("segment_id", "segment_label")
        .agg(F.avg("monetary").alias("spend"), *[F.avg(name).alias(name) for name in coordinates])
        .orderBy("spend")
        .collect()
    )

    def distance(center) -> Column:
        return sum(F.pow(F.col(name) - center[name], 2) for name in coordinates)

    own = F.lit(None).cast("double")
    for center in centers:
        own = F.when(F.col("segment_id") == center.segment_id, distance(center)).otherwise(own)
    nearest = F.least(*[distance(center) for center in centers]) if len(centers) > 1 else own
    by_name = {label: rank for rank, label in enumerate(SEGMENT_LABELS)}
    ranks = [by_name.get(center.segment_label, len(by_name)) for center in centers]
    disordered = sum(later < earlier for earlier, later in zip(ranks, ranks[1:]))
    return filled.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_distinct("segment_id").alias("segments"),
        F.round(F.sum("monetary"), 2).alias("spend"),
        F.count_if(own > nearest + tolerance).alias("misplaced"),
        F.lit(disordered).cast("bigint").alias("disordered"),
    )


def segment_distribution(users: DataFrame) -> DataFrame:
    """Users per segment label."""
    return users.groupBy(F.col("segment_label").alias("label")).agg(
        F.count("user_id").alias("count")
    )


def _coordinates() -> tuple[Column, Column]:
    """Both features as whole numbers, nulls as zero: the frequency, and the spend in millionths."""
    spend = F.round(F.coalesce(F.col("monetary").cast("double"), F.lit(0.0)) * MILLION).cast("bigint")
    return F.coalesce(F.col("frequency"), F.lit(0)).cast("bigint"), spend


Mean = tuple[float, float]


def _distance(
    mean: Mean | tuple[Column, Column], spreads: tuple[float, float], f: Column, m: Column
) -> Column:
    x, y = (f - F.lit(mean[0])) / F.lit(spreads[0]), (m - F.lit(mean[1])) / F.lit(spreads[1])
    return x * x + y * y


def _nearest(
    means: list[Mean] | list[tuple[Column, Column]], spreads: tuple[float, float], f: Column, m: Column
) -> Column:
    """The number of the nearest mean, the first of equally near ones."""
    distances = F.array(*[_distance(mean, spreads, f, m) for mean in means])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def _spread_out(points: DataFrame) -> DataFrame:
    """Stored points dealt over the cluster. They are few bytes, so that the files alone would leave
    all the passes over them to one task or a few."""
    count, cores = points.count(), points.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(cores, -(-count // FEWEST_PER_TASK)), -(-count // MOST_PER_TASK))
    return points.repartition(tasks)


def _with_means(
    points: DataFrame, starts: dict[int, list[Mean]], k: int, texts: dict[int, str] | None = None
) -> DataFrame:
    """Each point once per start, with the start's number, its text and first ``k`` means, null where
    it has fewer. Means are a column and no constants of the code, so that all passes of a fit
    share one compiled plan, however many starts there are."""

    def row(start: int, means: list[Mean]) -> str:
        numbers = [f"{number!r}D" for mean in means for number in mean]
        padded = [*numbers, *["NULL"] * (2 * k - len(numbers))]
        text = f"'{texts[start]}'" if texts else "''"
        return f"struct({start} AS start, {text} AS text, CAST(array({', '.join(padded)}) AS array<double>) AS means)"

    rows = ", ".join(row(start, means) for start, means in starts.items())
    return points.select("*", F.expr(f"inline(array({rows}))"))


def _mean_columns(k: int) -> list[tuple[Column, Column]]:
    """The ``k`` means that ``_with_means`` puts next to a point."""
    means = F.col("means")
    return [(means[2 * j], means[2 * j + 1]) for j in range(k)]


def _fitted(points: DataFrame, config: AnalyticsConfig) -> SegmentModel | None:
    f, m, weight = F.col("f"), F.col("m"), F.col(WEIGHT)

    def square(x: Column) -> Column:
        return F.coalesce(F.sum(x.cast("decimal(19,0)") * (x * weight).cast("decimal(19,0)")), F.lit(0))

    n, sum_f, sum_m, sum_ff, sum_mm = (
        int(value or 0)
        for value in points.agg(F.sum(weight), F.sum(f * weight), F.sum(m * weight), square(f), square(m)).first()
    )
    if n < config.segment_count:
        return None
    spreads = tuple(
        math.sqrt((n * squares - total * total) / (n * n)) or 1.0
        for total, squares in ((sum_f, sum_ff), (sum_m, sum_mm))
    )
    seeds = [config.segment_seed + start for start in range(config.segment_starts)]
    means = _first_means(points, seeds, config.segment_count, spreads)
    fits = _moved_means(points, means, spreads, config.segment_max_iterations)
    explained = [
        sum(((sf / w / spreads[0]) ** 2 + (sm / w / spreads[1]) ** 2) * w for w, sf, sm, _ in fit if w)
        for fit in fits
    ]
    best = max(range(len(fits)), key=explained.__getitem__)
    found = [sums for sums in fits[best] if sums[0]]
    found.sort(key=lambda s: (s[3] == 0, s[2] / s[3] if s[3] else 0.0, s[1] / s[0]))
    names = config.segment_labels
    centers = tuple(
        Center(i, names[i] if i < len(names) else None, sf / w, sm / w) for i, (w, sf, sm, _) in enumerate(found)
    )
    total = sum_ff / spreads[0] ** 2 + sum_mm / spreads[1] ** 2
    return SegmentModel(centers, spreads, max(0.0, total - explained[best]))


def _first_means(points: DataFrame, seeds: list[int], k: int, spreads: tuple[float, float]) -> list[list[Mean]]:
    """For each seed k points drawn one after the other, with a chance in proportion to weight and
    squared distance from those drawn before.

    A draw is a race: each point has an exponential time at that rate, from a hash of the seed, the
    round and the point, and the first one wins. So the draw does not depend on any order.
    """
    f, m = F.col("f"), F.col("m")
    drawn: dict[int, list[Mean]] = {seed: [] for seed in seeds}
    for number in range(k):
        texts = {seed: f"{seed}:{len(means)}" for seed, means in drawn.items()}
        dealt, means = _with_means(points, drawn, number, texts), _mean_columns(number)
        text = F.concat_ws(":", "text", f.cast("string"), m.cast("string"))
        uniform = (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 1) / 2.0**52
        rate = F.col(WEIGHT).cast("double")
        if means:
            rate = rate * F.array_min(F.array(*[_distance(mean, spreads, f, m) for mean in means]))
        timed = dealt.select("start", "f", "m", F.when(rate > 0, -F.log(uniform) / rate).alias("time"))
        first = timed.groupBy("start").agg(F.min_by("f", "time"), F.min_by("m", "time"))
        for seed, *point in first.collect():
            if None not in point:
                drawn[seed].append((float(point[0]), float(point[1])))
    return list(drawn.values())


Sums = tuple[int, int, int, int]


def _moved_means(
    points: DataFrame, starts: list[list[Mean]], spreads: tuple[float, float], most: int
) -> list[list[Sums]]:
    """Lloyd's steps from all starts side by side until no mean moves: each cluster's weight, sums of
    both features, and users with a spend. A cluster that loses all its points keeps its mean."""
    k = max(map(len, starts))
    f, m, weight = F.col("f"), F.col("m"), F.col(WEIGHT)
    nearest = _nearest(_mean_columns(k), spreads, f, m).alias("cluster")
    measures = (f, m, weight, F.col("paid"))
    totals = (F.sum(weight), F.sum(f * weight), F.sum(m * weight), F.sum("paid"))
    means, done = [list(start) for start in starts], [False] * len(starts)
    sums: list[list[Sums]] = [[(0, 0, 0, 0)] * len(start) for start in starts]
    for _ in range(most):
        going = [number for number, over in enumerate(done) if not over]
        if not going:
            break
        dealt = _with_means(points, {i: means[i] for i in going}, k)
        rows = dealt.select("start", nearest, *measures).groupBy("start", "cluster").agg(*totals).collect()
        found = {tuple(row[:2]): tuple(row[2:]) for row in rows}
        for i in going:
            new = [found.get((i, j), (0, 0, 0, 0)) for j in range(len(means[i]))]
            moved = [(sf / w, sm / w) if w else old for (w, sf, sm, _), old in zip(new, means[i])]
            done[i] = moved == means[i]
            sums[i], means[i] = new, moved
    return sums


def _lookup(key: Column, mapping: dict[int, str | None]) -> Column:
    value = F.lit(None).cast("string")
    for known, label in mapping.items():
        value = F.when(key == known, F.lit(label)).otherwise(value)
    return value
