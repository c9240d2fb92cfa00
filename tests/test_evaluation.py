import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from paperlane.operators import evaluation as ev
from paperlane.operators import order, profile


def test_published_counts_give_the_published_metrics(spark):
    counts = spark.createDataFrame([(664, 5, 1, 407)], "tn int, fp int, fn int, tp int")
    row = ev.metrics_from_confusion(counts).first()
    assert row.accuracy == pytest.approx(0.9944289693593314, abs=1e-15)
    assert row.precision == pytest.approx(0.9878640776699029, abs=1e-15)
    assert row.recall == pytest.approx(0.9975490196078431, abs=1e-15)
    assert row.f1 == pytest.approx(0.9926829268292683, abs=1e-15)


@pytest.fixture(scope="module")
def scored(spark):
    """A third of all rows share one score, and many scores tie."""
    rng = random.Random(3)
    rows = []
    for key in range(3000):
        score = 0.5 if key < 1000 else round(rng.random(), 2)
        rows.append((key, rng.random() < score, score))
    return spark.createDataFrame(rows, "key long, y boolean, s double").cache()


def test_score_at_the_threshold_is_positive(spark):
    rows = spark.createDataFrame([(0.5,), (0.4999,), (float("nan"),), (None,)], "s double")
    assert [r.y_pred for r in ev.predict(rows, "s").collect()] == [True, False, None, None]


def test_no_predicted_positive_gives_zero(spark):
    rows = spark.createDataFrame([(True, False), (False, False)], "y boolean, p boolean")
    row = ev.metrics(rows, "y", "p").first()
    assert (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 0.5)


def test_auc_equals_the_evaluator_of_spark(scored):
    vectors = scored.select(
        F.col("y").cast("double").alias("label"), array_to_vector(F.array(1 - F.col("s"), F.col("s"))).alias("raw")
    )
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0)
    assert ev.roc_auc(scored, "y", "s").first().roc_auc == pytest.approx(evaluator.evaluate(vectors), abs=1e-9)


def test_auc_of_one_class_is_missing(scored):
    assert ev.roc_auc(scored.filter("y"), "y", "s").first().roc_auc is None
    assert ev.roc_auc(scored.filter("key < 0"), "y", "s").first().roc_auc is None


def test_curves_against_brute_force(scored):
    rows = [(r.y, r.s) for r in scored.collect()]
    n_pos = sum(y for y, _ in rows)
    roc = {r.threshold: (r.fpr, r.tpr) for r in ev.roc_points(scored, "y", "s").collect()}
    pr = {r.threshold: (r.precision, r.recall) for r in ev.pr_points(scored, "y", "s").collect()}
    assert roc.pop(None) == (0.0, 0.0) and pr.pop(None) == (1.0, 0.0)
    assert set(roc) == set(pr) == {s for _, s in rows}
    for threshold in roc:
        tp = sum(y for y, s in rows if s >= threshold)
        fp = sum(not y for y, s in rows if s >= threshold)
        assert roc[threshold] == pytest.approx((fp / (len(rows) - n_pos), tp / n_pos))
        assert pr[threshold] == pytest.approx((tp / (tp + fp), tp / n_pos))


def test_sweep_against_single_metrics(scored):
    sweep = {r.threshold: r for r in ev.threshold_sweep(scored, "y", "s").collect()}
    assert len(sweep) == 27 and 0.91 in sweep and 0.05 in sweep
    for threshold in (0.05, 0.5, 0.91):
        single = ev.metrics(ev.predict(scored, "s", threshold), "y", "y_pred").first()
        row = sweep[threshold]
        assert (row.precision, row.recall, row.f1) == (single.precision, single.recall, single.f1)


def test_describe_against_numpy(spark, scored):
    frame = scored.withColumn("g", F.when(F.col("key") < 2000, "a").otherwise("b"))
    rows = frame.collect()
    for found in profile.describe(frame, "s", "g").collect():
        values = np.array([r.s for r in rows if r.g == found.g])
        expected = [len(values), values.mean(), values.std(ddof=1), values.min(),
                    *np.percentile(values, [25, 50, 75]), values.max()]
        assert list(found)[1:] == pytest.approx(expected)


def test_running_totals_do_not_depend_on_the_cuts(scored):
    def totals(cuts):
        frame = order.running_totals(scored, "s", {"n": F.count("*")}, cuts, descending=True)
        return sorted(tuple(r) for r in frame.collect())

    assert totals([]) == totals([0.2, 0.5, 0.77]) == totals(order.value_cuts(scored, "s", 16))
    assert order.value_cuts(scored.filter("key < 0"), "s") == []


def test_ranks_are_complete_in_every_group(spark):
    rows = spark.range(900).select(
        "id", F.when(F.col("id") < 300, "hot").when(F.col("id") < 310, None).otherwise(F.col("id").cast("string").substr(1, 1)).alias("g")
    )
    ranked = order.shuffled_rank(rows, ["g"], "id").collect()
    assert len(ranked) == 900
    groups = {}
    for row in ranked:
        groups.setdefault(row.g, []).append(row)
    for members in groups.values():
        assert sorted(r["rank"] for r in members) == list(range(1, len(members) + 1))
        assert {r.group_size for r in members} == {len(members)}


def test_samples_are_reproducible_and_disjoint(spark):
    rows = spark.range(200).repartition(7)
    first = order.sample_rows(rows, "id", 30)
    assert {r.id for r in first.collect()} == {r.id for r in order.sample_rows(rows.coalesce(1), "id", 30).collect()}
    others = order.sample_others(rows, first, "id", 30)
    assert others.count() == 30 and others.join(first, "id").count() == 0
    assert order.sample_rows(rows, "id", 1000).count() == 200


def test_nth_row_out_of_range_is_empty(spark):
    assert order.nth_row(spark.range(3), ["id"], 4).count() == 0
    assert order.nth_row(spark.range(3), ["id"], 3).first().id == 2


def test_class_report_of_two_classes(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "c")], "t string, p string")
    report = {r["class"]: r for r in ev.class_report(rows, "t", "p").collect()}
    assert report["a"].precision == 1.0 and report["a"].recall == 0.5 and report["c"].support == 0
    assert report["accuracy"].f1 == 0.5 and report["macro avg"].support == 4
    assert report["weighted avg"].precision == pytest.approx(0.75)


def test_raters_ignore_missing_answers(spark):
    rows = spark.createDataFrame([(True, True), (False, True), (None, True), (True, None)], "m boolean, a boolean")
    row = ev.rater_metrics(rows, "m", "a").first()
    assert (row.precision, row.recall, row.n_missing) == (0.5, 1.0, 2)
    assert ev.rater_quadrants(rows, "m", "a").count() == 4
