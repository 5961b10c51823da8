"""Clustering against brute force, labels by spend, and the cases with too little data."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmetrics import AnalyticsConfig
from clickmetrics import operators as op
from clickmetrics.operators import segments
from clickmetrics.operators.segments import SegmentModel
from fixtures import value_set

FEATURES = "user_id string, frequency bigint, monetary double"
CONFIG = AnalyticsConfig(segment_starts=4)

THREE_GROUPS = [
    ("a1", 2, 10.0), ("a2", 3, 12.0), ("a3", 2, 9.0),
    ("b1", 20, 210.0), ("b2", 22, 190.0),
    ("c1", 11, 900.0), ("c2", 12, 950.0), ("c3", 10, 910.0), ("c4", 11, 905.0),
]


def features(spark, rows):
    return spark.createDataFrame(rows, FEATURES)


def labels(users):
    return {row.user_id: row.segment_label for row in users.collect()}


def test_groups_are_labelled_by_spend_not_by_frequency(spark):
    segmentation = op.fit_segments(features(spark, THREE_GROUPS), CONFIG)
    expected = {"a": "Low Value", "b": "Medium Value", "c": "High Value"}
    assert labels(segmentation.users) == {row[0]: expected[row[0][0]] for row in THREE_GROUPS}
    assert value_set(op.segment_distribution(segmentation.users)) == {
        ("Low Value", 3), ("Medium Value", 2), ("High Value", 4)
    }


def least_cost(points: np.ndarray, k: int) -> float:
    """Within-cluster distance of the best of all ways to split the points into k groups."""
    best = np.inf
    for groups in product(range(k), repeat=len(points)):
        if len(set(groups)) == k:
            members = [points[np.array(groups) == g] for g in range(k)]
            best = min(best, sum(((m - m.mean(axis=0)) ** 2).sum() for m in members))
    return best


def split(spark, rows):
    """The scaled points and the group each was put into."""
    users = op.fit_segments(features(spark, rows), AnalyticsConfig()).users
    groups = {row.user_id: row.segment_id for row in users.collect()}
    points = np.array([row[1:] for row in rows], dtype=float)
    points = (points - points.mean(axis=0)) / points.std(axis=0)
    return points, np.array([groups[row[0]] for row in rows])


def means(points, groups):
    return np.array([points[groups == g].mean(axis=0) for g in sorted(set(groups))])


def test_clear_groups_are_found_as_by_trying_every_split(spark):
    points, groups = split(spark, THREE_GROUPS)
    centers = means(points, groups)
    found = ((points - centers[groups]) ** 2).sum()
    assert found == pytest.approx(least_cost(points, 3))


def test_every_user_is_in_the_group_with_the_nearest_mean(spark):
    """Holds for any data; users without clear groups have several such splits."""
    random = np.random.default_rng(2)
    rows = [
        (f"u{i}", int(random.integers(1, 50)), float(np.round(random.uniform(0, 900), 2)))
        for i in range(60)
    ]
    points, groups = split(spark, rows)
    distances = ((points[:, None, :] - means(points, groups)[None, :, :]) ** 2).sum(axis=2)
    assert len(set(groups)) == 3
    assert (distances.argmin(axis=1) == groups).all()


def test_best_start_is_kept(spark):
    spread = features(spark, [(f"u{i}", i * 37 % 101, float(i * 53 % 211)) for i in range(80)])

    def cost(**settings):
        return op.fit_segments(spread, AnalyticsConfig(segment_count=5, **settings)).model.cost

    costs = [cost(segment_starts=1, segment_seed=seed) for seed in (42, 43, 44)]
    assert cost(segment_starts=3) == pytest.approx(min(costs))
    assert max(costs) > min(costs)


def test_partitions_of_the_input_do_not_matter(spark, sf_dir):
    from __spark_entry__ import REPORT, given_events

    users = op.segment_features(given_events(spark, sf_dir), REPORT).persist()
    fits = [op.fit_segments(users.repartition(n), REPORT) for n in (4, 16, 64)]
    assert fits[0].model == fits[1].model == fits[2].model
    assert labels(fits[0].users) == labels(fits[1].users) == labels(fits[2].users)


def test_a_fit_is_spread_over_tasks(spark, monkeypatch):
    """Points are few bytes: stored as they come, one task would have all of them in every pass."""
    tasks = []
    fitted = segments._fitted
    monkeypatch.setattr(
        segments, "_fitted", lambda points, config: tasks.append(points.rdd.getNumPartitions()) or fitted(points, config)
    )
    many = spark.range(40_000).selectExpr(
        "CAST(id AS STRING) AS user_id", "id % 211 AS frequency", "CAST(id * 7919 % 40009 AS DOUBLE) AS monetary"
    )
    assert op.fit_segments(many, AnalyticsConfig(segment_starts=2)) is not None
    assert tasks == [4]


def test_passes_share_their_code(spark):
    """The means of a pass are data to it: no other code is made and compiled for other means."""
    points = spark.createDataFrame(
        [(f, int(m), 1, 1) for _, f, m in THREE_GROUPS],
        "f bigint, m bigint, weight bigint, paid bigint",
    ).persist()
    jvm = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.expressions.codegen
    compiled = []
    for shift in (0.0, 1.5, 7.25):
        starts = [[(2.0 + shift, 9.0), (20.0, 200.0 + shift), (11.0, 900.0)], [(3.0, 12.0 + shift), (22.0, 190.0)]]
        sums = segments._moved_means(points, starts, (1.0, 10.0), 1)
        assert [sum(cluster[0] for cluster in start) for start in sums] == [9, 9]
        compiled.append(jvm.CodeGenerator.compileTime())
    points.unpersist()
    assert compiled[1] == compiled[2] == compiled[0]


def test_users_are_not_sorted_or_dealt(spark):
    users = op.fit_segments(features(spark, THREE_GROUPS), CONFIG).users
    plan = users._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_amounts_of_any_size(spark):
    rows = [("a", 1, -5e9), ("b", 2, 5e9), ("c", 3, 1e-6), ("d", 10**9, 2e-6), ("e", 3, 0.0)]
    assert len(set(labels(op.fit_segments(features(spark, rows), CONFIG).users).values())) == 3


def test_a_save_that_breaks_off_leaves_the_old_model(spark, tmp_path, monkeypatch):
    old = op.fit_segments(features(spark, THREE_GROUPS), CONFIG).model
    path = str(tmp_path / "model")
    with pytest.raises(Exception):
        SegmentModel.load(path)
    old.save(path)
    new = op.fit_segments(features(spark, THREE_GROUPS[2:]), CONFIG).model
    broken = tmp_path / "model" / "version=99999999999999999999" / "_temporary" / "0"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"half")
    assert SegmentModel.load(path) == old
    new.save(path)
    assert SegmentModel.load(path) == new


def test_the_check_finds_what_is_wrong(spark):
    users = op.fit_segments(features(spark, THREE_GROUPS), CONFIG).users
    assert value_set(op.segment_check(users)) == {(9, 3, 4096.0, 0, 0)}
    swapped = users.withColumn(
        "segment_id", F.when(F.col("user_id") == "a1", 99).otherwise(F.col("segment_id"))
    ).replace({"Low Value": "High Value", "High Value": "Low Value"}, subset=["segment_label"])
    row = op.segment_check(swapped).first()
    assert (row.segments, row.disordered > 0) == (4, True)
    moved = users.withColumn(
        "segment_id",
        F.when(F.col("user_id") == "c1", users.filter("user_id = 'a1'").first().segment_id).otherwise(
            F.col("segment_id")
        ),
    )
    assert op.segment_check(moved).first().misplaced > 0


def test_null_spend_is_clustered_as_zero_and_stays_null(spark):
    rows = [*THREE_GROUPS, ("n", 2, None)]
    users = op.fit_segments(features(spark, rows), CONFIG).users
    stored = {row.user_id: row for row in users.collect()}
    assert stored["n"].monetary is None
    assert stored["n"].segment_label == "Low Value"


def test_cluster_without_any_spend_ranks_last(spark):
    rows = [("a", 1, 5.0), ("a2", 1, 5.0), ("b", 50, 900.0), ("n", 200, None)]
    assert labels(op.fit_segments(features(spark, rows), CONFIG).users) == {
        "a": "Low Value", "a2": "Low Value", "b": "Medium Value", "n": "High Value"
    }


def test_fewer_users_than_segments(spark):
    assert op.fit_segments(features(spark, THREE_GROUPS[:2]), CONFIG) is None
    assert op.fit_segments(features(spark, []), CONFIG) is None


def test_fewer_distinct_users_than_segments(spark):
    rows = [("a", 1, 5.0), ("b", 1, 5.0), ("c", 9, 50.0)]
    assert labels(op.fit_segments(features(spark, rows), CONFIG).users) == {
        "a": "Low Value", "b": "Low Value", "c": "Medium Value"
    }


def test_more_segments_than_labels(spark):
    rows = [(f"u{i}", i * 10, i * 100.0) for i in range(4)]
    config = AnalyticsConfig(segment_count=4, segment_starts=4)
    assert labels(op.fit_segments(features(spark, rows), config).users) == {
        "u0": "Low Value", "u1": "Medium Value", "u2": "High Value", "u3": None
    }


def test_saved_model_scores_new_users(spark, tmp_path):
    model = op.fit_segments(features(spark, THREE_GROUPS), CONFIG).model
    model.save(str(tmp_path / "model"))
    model.save(str(tmp_path / "model"))
    new = features(spark, [("x", 11, 930.0), ("y", 2, 8.0)])
    loaded = SegmentModel.load(str(tmp_path / "model"))
    assert value_set(loaded.transform(new)) == value_set(model.transform(new))
    assert labels(loaded.transform(new)) == {"x": "High Value", "y": "Low Value"}
