"""Votes of single trees, asked for a few at a time."""

import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from paperlane.operators import training


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(3)
    points = [[pick.random() for _ in range(4)] for _ in range(120)]
    rows = [(i, float(p[0] + p[1] > 1), p) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id int, label double, p array<double>").withColumn("features", array_to_vector("p"))


def test_no_job_holds_all_trees(rows):
    model = training.forest(7).fit(rows)
    votes = training.tree_votes(model, training.score(model, rows), at_once=3)
    # what is left to do reads votes; no tree is sent with it
    assert "UDF" not in votes._jdf.queryExecution().optimizedPlan().toString()
    assert votes.columns == [*rows.columns, "y_pred_prob", "votes"]
    found = votes.collect()
    assert len(found) == 120
    each = [
        {r["id"]: r["probability"][1] for r in tree.transform(rows.select("id", "features")).collect()} for tree in model.trees
    ]
    for r in found:
        assert list(r["votes"]) == [tree[r["id"]] for tree in each]
        assert abs(sum(r["votes"]) / 7 - r["y_pred_prob"]) < 1e-9
    whole = training.tree_votes(model, rows, at_once=100)
    assert whole.join(votes.select("id", F.col("votes").alias("again")), "id").filter("votes = again").count() == 120
