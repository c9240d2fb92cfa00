"""Metrics, curves and review lists of a binary classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlane.functions.numbers import round_even
from paperlane.operators.order import running_totals, value_cuts

# Steps of five percent, and single percents above 0.9.
THRESHOLDS = tuple(sorted({i / 100 for i in (*range(5, 100, 5), *range(91, 100))}))
KEY_THRESHOLDS = (0.5, 0.7, 0.8, 0.9, 0.95)


def ratio(part: Column, whole: Column) -> Column:
    """Division that gives 0 where the divisor is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    """Harmonic mean, 0 if both are 0."""
    return ratio(2 * precision * recall, precision + recall)


def predict(df: DataFrame, score: str, threshold: float = 0.5, name: str = "y_pred") -> DataFrame:
    """Add the class: positive at the threshold and above. A score that is missing or NaN gives NULL."""
    value = F.nanvl(F.col(score), F.lit(None).cast("double"))
    return df.withColumn(name, value >= threshold)


def metrics_from_confusion(df: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall and F1 to rows with tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return df.select(
        "*", ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"), precision.alias("precision"),
        recall.alias("recall"), f1(precision, recall).alias("f1"),
    )


def confusion(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """The four counts, overall or per group, from one pass."""
    y, p = F.col(truth), F.col(predicted)
    return df.groupBy(*by).agg(
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"),
    )


def metrics(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts and metrics, overall or per group."""
    return metrics_from_confusion(confusion(df, truth, predicted, by))


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted mean.

    Everything is derived from the counts per pair of classes.
    """
    pairs = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(
        F.count("*").alias("n")
    )
    hit = F.when(F.col("t").eqNullSafe(F.col("p")), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("t").cast("string").alias("class"), F.col("n").alias("support"),
                 zero.alias("predicted"), hit.cast("long").alias("tp")),
        F.struct(F.col("p").cast("string").alias("class"), zero.alias("support"),
                 F.col("n").alias("predicted"), zero.alias("tp")),
    )))
    per_class = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
        F.sum("tp").alias("tp"),
    )
    precision = ratio(F.col("tp"), F.col("predicted"))
    recall = ratio(F.col("tp"), F.col("support"))
    per_class = per_class.select(
        "class", "support", "tp", precision.alias("precision"), recall.alias("recall"),
        f1(precision, recall).alias("f1"),
    )
    means = ("precision", "recall", "f1")
    grouped = per_class.rollup("class").agg(
        F.grouping("class").alias("_all"), F.sum("support").alias("support"),
        F.sum("tp").alias("tp"), *[F.avg(m).alias(m) for m in means],
        *[F.sum(F.col(m) * F.col("support")).alias(f"_w_{m}") for m in means],
    )

    def line(name: Column, values: Sequence[Column]) -> Column:
        cells = [v.cast("double").alias(m) for m, v in zip(means, values)]
        return F.struct(name.alias("class"), *cells, F.col("support").alias("support"))

    total = F.col("support")
    accuracy = ratio(F.col("tp"), total)
    lines = F.when(F.col("_all") == 0, F.array(line(F.col("class"), [F.col(m) for m in means])))
    lines = lines.otherwise(F.array(
        line(F.lit("accuracy"), [accuracy] * 3),
        line(F.lit("macro avg"), [F.col(m) for m in means]),
        line(F.lit("weighted avg"), [ratio(F.col(f"_w_{m}"), total) for m in means]),
    ))
    return grouped.select(F.inline(lines))


def _score_curve(df: DataFrame, truth: str, score: str, descending: bool = True) -> DataFrame:
    """Positive and negative rows per distinct score with their running counts."""
    scored = df.select(F.col(score).alias("score"), F.col(truth).alias("truth")).filter(
        F.col("score").isNotNull() & ~F.isnan("score") & F.col("truth").isNotNull()
    )
    measures = {"pos": F.count_if("truth"), "neg": F.count_if(~F.col("truth"))}
    return running_totals(scored, "score", measures, value_cuts(scored, "score"), descending=descending)


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under the ROC curve by the rank sum, ties counted half; NULL with one class only."""
    curve = _score_curve(df, truth, score, descending=False)
    below = F.col("neg_upto") - F.col("neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    area = F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg"))
    return curve.agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), area.alias("roc_auc")
    )


def roc_points(df: DataFrame, truth: str, score: str) -> DataFrame:
    """False and true positive rate at each distinct score; the start point has no threshold."""
    curve = _score_curve(df, truth, score).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("neg_upto").cast("double"), F.col("neg_all")).alias("fpr"),
        F.try_divide(F.col("pos_upto").cast("double"), F.col("pos_all")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(curve)


def pr_points(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Precision and recall at each distinct score; the end point has no threshold."""
    tp, fp = F.col("pos_upto"), F.col("neg_upto")
    curve = _score_curve(df, truth, score).select(
        F.col("score").alias("threshold"), ratio(tp, tp + fp).alias("precision"),
        F.try_divide(tp.cast("double"), F.col("pos_all")).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def threshold_sweep(
    df: DataFrame, truth: str, score: str, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Precision, recall, F1 and predicted positives at each threshold.

    The table is read once and counted per band between two thresholds. The few bands are then
    added up for each threshold. A score that is missing or NaN is below all of them.
    """
    steps = sorted(set(thresholds))
    infinity = float("inf")
    value = F.coalesce(F.nanvl(F.col(score), F.lit(None).cast("double")), F.lit(-infinity))
    rows = df.select(value.alias("_value"), F.col(truth).alias("_truth"))
    bucketizer = Bucketizer(splits=[-infinity, *steps, infinity], inputCol="_value", outputCol="_band")
    bands = bucketizer.transform(rows).groupBy("_band").agg(
        F.count("*").alias("_n"), F.count_if("_truth").alias("_pos")
    )

    # one row per band, also for those without a row; band i starts at threshold i
    grid = df.sparkSession.range(len(steps) + 1).select(F.col("id").cast("double").alias("_band"))
    filled = grid.join(bands, "_band", "left").na.fill(0)
    from_here = Window.orderBy(F.desc("_band"))
    everywhere = Window.partitionBy()
    starts = F.array(F.lit(None).cast("double"), *[F.lit(float(step)) for step in steps])
    table = filled.select(
        F.get(starts, F.col("_band").cast("int")).alias("threshold"),
        F.sum("_n").over(from_here).alias("predicted_positive"),
        F.sum("_pos").over(from_here).alias("tp"),
        F.sum("_n").over(everywhere).alias("total"),
        F.sum("_pos").over(everywhere).alias("n_pos"),
    ).filter("threshold IS NOT NULL")
    precision = ratio(F.col("tp"), F.col("predicted_positive"))
    recall = ratio(F.col("tp"), F.col("n_pos"))
    return table.select(
        "threshold", precision.alias("precision"), recall.alias("recall"),
        f1(precision, recall).alias("f1"), "predicted_positive", "total",
    )


def threshold_summary(
    df: DataFrame, truth: str, score: str, thresholds: Sequence[float] = KEY_THRESHOLDS
) -> DataFrame:
    """The sweep at the key thresholds, in percent with two digits."""
    sweep = threshold_sweep(df, truth, score, thresholds)
    percents = [round_even(F.col(c) * 100, 2).alias(c) for c in ("precision", "recall", "f1")]
    return sweep.select("threshold", *percents, "predicted_positive", "total")


def errors(df: DataFrame, truth: str, predicted: str, kind: str) -> DataFrame:
    """False positives (``fp``) or false negatives (``fn``)."""
    wanted = {"fp": ~F.col(truth) & F.col(predicted), "fn": F.col(truth) & ~F.col(predicted)}
    return df.filter(wanted[kind])


def error_totals(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Number of false positives and false negatives."""
    return confusion(df, truth, predicted).select(F.col("fp").alias("n_fp"), F.col("fn").alias("n_fn"))


def review_queue(
    df: DataFrame, score: str, condition: Column, below: float, key: str
) -> DataFrame:
    """Rows of the expected class with a low score, lowest first."""
    return df.filter(condition & (F.col(score) < below)).orderBy(score, key)


def rater_quadrants(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows per pair of answers of two raters, missing answers included."""
    return df.groupBy(first, second).agg(F.count("*").alias("n_rows"))


def rater_metrics(df: DataFrame, truth: str, other: str) -> DataFrame:
    """Precision, recall and F1 of one rater against the other, where both gave an answer."""
    y, p = F.col(truth), F.col(other)
    counts = df.agg(
        F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"),
        F.count_if(y.isNull() | p.isNull()).alias("n_missing"),
    )
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.select(
        precision.alias("precision"), recall.alias("recall"), f1(precision, recall).alias("f1"),
        "n_missing",
    )


def both_true(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows where both flags are true."""
    return df.filter(F.col(first) & F.col(second))


def extractor_accuracy(df: DataFrame, found: str, truth: str) -> DataFrame:
    """Agreement of an extractor with the truth, and what is missing on either side."""
    equal = F.col(found).eqNullSafe(F.col(truth))
    return df.agg(
        F.count("*").alias("n_rows"), F.count_if(equal).alias("n_equal"),
        F.count_if(F.col(found).isNull() & F.col(truth).isNotNull()).alias("n_not_found"),
        F.count_if(F.col(found).isNotNull() & F.col(truth).isNull()).alias("n_no_truth"),
        F.try_divide(F.count_if(equal).cast("double"), F.count("*")).alias("agreement"),
    )
