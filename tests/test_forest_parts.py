"""Forests that are grown in parts, which score as one forest."""

import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from paperlane.operators import training


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(5)
    points = [[pick.random() for _ in range(4)] for _ in range(300)]
    rows = [(i, i % 3, float(p[0] + p[1] > 1), p) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id int, fold int, label double, p array<double>")
    return df.withColumn("features", array_to_vector("p")).repartition(6, "id").cache()


def test_parts_are_one_forest(rows):
    parts = training.grow(training.forest(25, max_depth=4), rows, small=100, per_task=150)
    assert [part.getNumTrees for part in parts] == [10, 10, 5]
    # no tree comes twice
    assert len({tree.toDebugString.split("\n", 1)[1] for part in parts for tree in part.trees}) == 25
    scored = training.score(parts, rows)
    assert scored.columns == [*rows.columns, "y_pred_prob"]
    # what is left to do reads sums; no tree is sent with it
    assert "UDF" not in scored._jdf.queryExecution().optimizedPlan().toString()
    voted = training.tree_votes(parts, scored).collect()
    assert len(voted) == 300
    for r in voted:
        assert len(r["votes"]) == 25
        assert abs(sum(r["votes"]) / 25 - r["y_pred_prob"]) < 1e-9
    assert sum((r["y_pred_prob"] >= 0.5) == (r["label"] == 1) for r in voted) > 280


def test_parts_are_read_by_few_tasks(rows):
    found = []
    for small, per_task in ((100, 150), (100, 1000), (300, 1)):
        parts, read, width = training._parts(training.forest(25), rows, small, per_task)
        assert read.count() == 300
        found.append((len(parts), read.rdd.getNumPartitions(), width))
    # few tasks for each part, and more parts at a time; small tables are left to one fit
    assert found == [(3, 2, 8), (3, 1, 16), (1, 6, 0)]


def test_one_part_is_a_single_fit(rows):
    classifier = training.forest(12, max_depth=4)
    one = training.score(training.grow(classifier, rows), rows)
    same = one.join(training.score(classifier.fit(rows), rows).select("id", F.col("y_pred_prob").alias("again")), "id")
    assert same.filter("y_pred_prob = again").count() == 300


def test_folds_in_parts_leave_their_rows_out(rows):
    classifier = training.forest(12, max_depth=4)
    scored = training.cross_validate(rows, classifier, "fold", 3, small=100, per_task=60)
    assert scored.count() == 300
    for i in range(3):
        left_out = training.grow(classifier, rows.filter(F.col("fold") != i), small=100, per_task=60)
        again = training.score(left_out, rows.filter(F.col("fold") == i)).select("id", F.col("y_pred_prob").alias("again"))
        assert scored.filter(F.col("fold") == i).join(again, "id").filter("y_pred_prob = again").count() == 100
