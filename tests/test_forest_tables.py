"""Trees that are grown by tasks and stay in tables: cuts, single trees, where rows lie, folds, and what is left to Spark."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from paperlane.operators import forests, training


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(11)
    points = [[pick.choice((0.0, pick.random())) for _ in range(5)] for _ in range(400)]
    rows = [(i, i % 3, float(p[0] + p[1] > 0.6), p) for i, p in enumerate(points)]
    # some rows come twice
    df = spark.createDataFrame(rows + [(1000 + i, *row[1:]) for i, row in enumerate(rows[:50])], "id int, fold int, label double, p array<double>")
    return df.withColumn("features", array_to_vector("p")).repartition(6, "id").cache()


@pytest.fixture
def no_spark_fit(monkeypatch):
    """Spark's own fit keeps all nodes of its trees on the driver."""

    def fit(*_):
        raise AssertionError("a forest passes through the driver")

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)


def scores(model, rows):
    return {r["id"]: r["y_pred_prob"] for r in training.score(model, rows).collect()}


def test_trees_stay_in_a_table(rows, no_spark_fit):
    parts = training.grow(training.forest(25), rows, small=100)
    assert [part.getNumTrees for part in parts] == [10, 10, 5]
    assert sum(part.table.select("tree").distinct().count() for part in parts[:1]) == 25
    voted = training.tree_votes(parts, training.score(parts, rows), at_once=4).collect()
    assert len(voted) == 450 and all(len(r["votes"]) == 25 for r in voted)
    assert all(abs(sum(r["votes"]) / 25 - r["y_pred_prob"]) < 1e-9 for r in voted)
    assert sum((r["y_pred_prob"] >= 0.5) == (r["label"] == 1) for r in voted) > 430


def test_a_forest_does_not_depend_on_where_rows_lie(rows):
    found = [scores(training.grow(training.forest(12), df, small=100), rows) for df in (rows, rows.orderBy(F.desc("id")).coalesce(2))]
    assert found[0] == found[1]
    other = scores(training.grow(training.forest(12, seed=7), rows, small=100), rows)
    assert other != found[0]


def test_folds_are_grown_by_tasks(rows, no_spark_fit):
    classifier = training.forest(12, max_depth=6)
    scored = training.cross_validate(rows, classifier, "fold", 3, small=100)
    assert scored.columns == [*rows.columns, "y_pred_prob"] and scored.count() == 450
    for i in range(3):
        left_out = training.grow(classifier, rows.filter(F.col("fold") != i), small=100)
        fold = scored.filter(F.col("fold") == i)
        assert {r["id"]: r["y_pred_prob"] for r in fold.collect()} == scores(left_out, rows.filter(F.col("fold") == i))


@pytest.mark.parametrize("change", ["weights", "labels", "entropy"])
def test_what_tasks_do_not_know_is_left_to_spark(rows, change):
    df = rows.withColumn("w", F.lit(2.0)).withColumn("label", F.col("label") + (F.lit(float(change == "labels")) * (F.col("id") % 2)))
    classifier = training.forest(12, max_depth=3, **{"weights": {"weightCol": "w"}, "entropy": {"impurity": "entropy"}}.get(change, {}))
    parts = training.grow(classifier, df, small=100)
    assert not any(isinstance(part, forests.GrownTrees) for part in parts)
    assert sum(part.getNumTrees for part in parts) == 12


def test_missing_labels_fail(rows):
    with pytest.raises(Exception, match="label"):
        training.grow(training.forest(12), rows.withColumn("label", F.when(F.col("id") != 5, F.col("label"))), small=100)


def test_cuts_part_values_evenly():
    one = np.ones(3, np.int64)
    few = np.array([-1.0, 1.0, 2.0])
    # few values: the middle between each two, zeros among them
    assert list(forests.feature_cuts(one, few, few, 4, 32)) == [-0.5, 0.5, 1.5]
    assert list(forests.feature_cuts(one, few, few, 0, 32)) == [0.0, 1.5]
    assert list(forests.feature_cuts(one[:0], few[:0], few[:0], 9, 32)) == []
    # many: zeros alone, and the others in seven bins of equal size
    low, high = np.array([1.0, 2.0]), np.array([2.0, 4.0])
    cuts = forests.feature_cuts(np.array([400, 400]), low, high, 5000, 8)
    assert cuts[0] == 0.5 and len(cuts) == 7
    values = np.concatenate([np.linspace(1, 2, 400), np.linspace(2, 4, 400)])
    assert max(abs(np.bincount(np.searchsorted(cuts[1:], values), minlength=7) - 800 / 7)) < 3
    x = np.array([[0.0], [0.5], [0.6], [5.0], [np.nan]])
    assert list(forests.binned(x, cuts[None])[0]) == [0, 0, 1, 7, 7]


def slow_best(bins, labels, weights, at, width):
    """The Gini gain of the best split, one by one."""

    def impure(of):
        n, p = weights[of].sum(), weights[of][labels[of] == 1].sum()
        return n - (p * p + (n - p) ** 2) / n if n else 0

    gains = [
        impure(at) - impure(at[row[at] <= c]) - impure(at[row[at] > c])
        for row in bins for c in range(width - 1) if (row[at] <= c).any() and (row[at] > c).any()
    ]
    return max(gains, default=0)


def test_a_tree_takes_the_best_split_of_each_node():
    draw = np.random.default_rng(1)
    n, width = 300, 6
    bins = draw.integers(0, width, (1, n), dtype=np.uint8)
    labels = (draw.random(n) < bins[0] / 7).astype(np.uint8)
    weights = draw.poisson(1, n).astype(np.uint8)
    feature, cut, share = forests.grow_tree(bins, labels, weights, width, 30, 1, 0.0, np.random.default_rng(2))
    rows = np.flatnonzero(weights)
    # the only feature has six values, so the tree can be followed node by node
    held, leaf = {0: rows}, 0
    before = np.cumsum(feature >= 0) - (feature >= 0)
    for i in range(len(feature)):
        at = held[i]
        if feature[i] < 0:
            assert share[leaf] == weights[at][labels[at] == 1].sum() / weights[at].sum()
            leaf += 1
            continue
        left, right = at[bins[0, at] <= cut[i]], at[bins[0, at] > cut[i]]
        assert len(left) and len(right)

        def impure(of):
            k, p = weights[of].sum(), weights[of][labels[of] == 1].sum()
            return k - (p * p + (k - p) ** 2) / k

        gain = impure(at) - impure(left) - impure(right)
        assert gain == pytest.approx(slow_best(bins, labels, weights, at, width))
        held[2 * before[i] + 1], held[2 * before[i] + 2] = left, right
    assert leaf == len(share) == (feature < 0).sum()
    said = forests.shares(bins, (feature, cut, share))
    assert abs((said[rows] * weights[rows]).sum() - weights[labels == 1].sum()) < 1e-9
    # no two leaves of a node decide alike
    decides = np.zeros(len(feature), bool)
    decides[feature < 0] = share > 0.5
    for i in np.flatnonzero(feature >= 0):
        one, other = 2 * before[i] + 1, 2 * before[i] + 2
        assert feature[one] >= 0 or feature[other] >= 0 or decides[one] != decides[other]
    shallow = forests.grow_tree(bins, labels, weights, width, 0, 1, 0.0, np.random.default_rng(2))
    assert len(shallow[0]) == 1


def test_jobs_are_sent_with_few_trees():
    trees = [forests.GrownTrees(None, None, "features", i, (10,)) for i in range(7)]
    assert [len(some) for some in forests.in_turns(trees, 5)] == [5, 2]
    assert [len(some) for some in forests.in_turns(trees, 7, sent_bytes=200)] == [2, 2, 2, 1]
    assert [len(some) for some in forests.in_turns(trees, 7, sent_bytes=1)] == [1] * 7
