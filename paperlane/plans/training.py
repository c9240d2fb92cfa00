"""Splits, folds and the forest on the labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.functions.text import clean_text, replace_with_tags, tokens
from paperlane.operators import evaluation as ev
from paperlane.operators import tfidf
from paperlane.operators import training as op
from paperlane.plans.registry import Tables, query, rounded
from paperlane.plans.texts import STOP_WORDS
from paperlane.session import materialize

TREES = 100
FOLDS = 5
_RANKED = """ranked AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality
        ORDER BY md5(doc_id || ':42'), doc_id) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM labels),
    split_rows AS (SELECT doc_id, quality,
        CASE WHEN rn <= round_even(0.2::double * n, 0) THEN 'test' ELSE 'train' END AS split FROM ranked),
    fold_rows AS (SELECT doc_id, quality, CAST((rn - 1) % 5 AS int) AS fold FROM ranked)"""


def _labels(t: Tables) -> DataFrame:
    return t("labels").select("doc_id", "quality")


def _sizes_sql(part: str) -> str:
    return f"""WITH {_RANKED} SELECT {part}, quality, count(*) AS n_rows,
        round_even(count(*) / sum(count(*)) OVER (PARTITION BY {part}), 6) AS share
        FROM {part}_rows GROUP BY {part}, quality"""


@query(f"WITH {_RANKED} SELECT * FROM split_rows")
def stratified_split(t: Tables) -> DataFrame:
    return op.stratified_split(_labels(t), "quality", "doc_id")


@query(_sizes_sql("split"))
def split_counts(t: Tables) -> DataFrame:
    split = op.stratified_split(_labels(t), "quality", "doc_id")
    return rounded(op.class_sizes(split, "quality", "split"), "share")


@query(f"WITH {_RANKED} SELECT * FROM fold_rows")
def stratified_folds(t: Tables) -> DataFrame:
    return op.stratified_folds(_labels(t), "quality", "doc_id", FOLDS)


@query(_sizes_sql("fold"))
def fold_counts(t: Tables) -> DataFrame:
    folds = op.stratified_folds(_labels(t), "quality", "doc_id", FOLDS)
    return rounded(op.class_sizes(folds, "quality", "fold"), "share")


def prepared(t: Tables) -> DataFrame:
    """Labelled documents, cleaned, tagged, split and tokenised; written once for the jobs below."""
    labels = t("labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    # ranks are drawn over the narrow labels and written, which shows the join how small they are
    split = materialize(op.stratified_split(labels, "label", "doc_id"), "split")
    docs = t("documents").select("doc_id", "text").join(split, "doc_id")
    tagged = docs.withColumn("text_w_tags", replace_with_tags(clean_text(F.col("text"))))
    tokenized = tagged.withColumn("tokenized", tokens(F.col("text_w_tags"), STOP_WORDS))
    return materialize(tokenized.select("doc_id", "label", "split", "tokenized"), "prepared")


def features(t: Tables) -> DataFrame:
    """Vectors of all labelled documents; the vocabulary comes from the training rows alone."""
    rows = prepared(t)
    train = rows.filter("split = 'train'")
    model = tfidf.vectorizer(tfidf.vocabulary(train, "tokenized"), "tokenized")
    vectors = tfidf.vectorize(model, rows).drop("tokenized")
    return materialize(vectors, "features")


@query()
def forest_scores(t: Tables) -> DataFrame:
    rows = features(t)
    model = op.grow(op.forest(TREES), rows.filter("split = 'train'"))
    scored = op.score(model, rows.filter("split = 'test'"))
    return scored.select("doc_id", (F.col("label") == 1).alias("y_true"), "y_pred_prob")


# What is certain about the scores, whatever the trees: every test row has one, and it is a probability.
@query(f"""WITH {_RANKED} SELECT count(*) AS n_scored, count(*) AS n_keys, count(*) AS n_test_rows,
    count(*) AS n_right_truths, count(*) AS n_probabilities FROM split_rows WHERE split = 'test'""")
def forest_invariants(t: Tables) -> DataFrame:
    test = op.stratified_split(_labels(t), "quality", "doc_id").filter("split = 'test'")
    scored = forest_scores(t).join(test.select("doc_id", F.col("quality")), "doc_id", "left")
    return scored.agg(
        F.count("*").alias("n_scored"), F.count_distinct("doc_id").alias("n_keys"), F.count("quality").alias("n_test_rows"),
        F.count_if(F.col("y_true") == (F.col("quality") == 1)).alias("n_right_truths"),
        F.count_if(F.col("y_pred_prob").between(0, 1)).alias("n_probabilities"),
    )


# A score is the mean of the votes of all trees, it differs between rows, and the forest has learned what it was shown.
@query(f"""WITH {_RANKED} SELECT count(*) AS n_rows, count(*) AS n_mean_votes, {TREES} AS n_trees, true AS has_many_scores,
    true AS knows_training_rows FROM split_rows WHERE split = 'test'""")
def forest_consistency(t: Tables) -> DataFrame:
    rows = features(t)
    train = rows.filter("split = 'train'")
    model = op.grow(op.forest(TREES), train)
    scored = op.tree_votes(model, op.score(model, rows.filter("split = 'test'")))
    mean = F.aggregate("votes", F.lit(0.0), lambda x, y: x + y) / F.size("votes")
    # curves take several jobs, and each would be sent with the whole forest
    known = materialize(op.score(model, train).select((F.col("label") == 1).alias("y_true"), "y_pred_prob"), "known")
    area = ev.roc_auc(known, "y_true", "y_pred_prob").select((F.col("roc_auc") > 0.95).alias("knows_training_rows"))
    checked = scored.agg(
        F.count("*").alias("n_rows"), F.count_if(F.abs(F.col("y_pred_prob") - mean) < 1e-9).alias("n_mean_votes"),
        F.max(F.size("votes")).alias("n_trees"), (F.count_distinct("y_pred_prob") > F.lit(10)).alias("has_many_scores"),
    )
    # one row each
    return checked.join(area, F.lit(True))


# The scores of a fold are those of a forest grown without it, which is grown here once more.
@query(f"""WITH {_RANKED} SELECT count(*) AS n_rows, count(*) AS n_same_scores FROM fold_rows WHERE fold = 0""")
def cv_left_out(t: Tables) -> DataFrame:
    rows = features(t)
    folded = materialize(op.stratified_folds(rows, "label", "doc_id", FOLDS), "folds")
    scores = op.cross_validate(folded, op.forest(TREES), "fold", FOLDS).filter("fold = 0")
    model = op.grow(op.forest(TREES), folded.filter("fold <> 0"))
    again = op.score(model, folded.filter("fold = 0")).select("doc_id", F.col("y_pred_prob").alias("again"))
    same = F.count_if(F.col("y_pred_prob") == F.col("again"))
    return scores.join(again, "doc_id").agg(F.count("*").alias("n_rows"), same.alias("n_same_scores"))


@query(f"""WITH {_RANKED} SELECT fold, count(*) FILTER (quality = 1) AS n_positive, count(*) FILTER (quality = 0) AS n_negative
    FROM fold_rows GROUP BY fold""")
def cv_invariants(t: Tables) -> DataFrame:
    return cv_metrics(t).select("fold", (F.col("fn") + F.col("tp")).alias("n_positive"), (F.col("tn") + F.col("fp")).alias("n_negative"))


@query()
def forest_metrics(t: Tables) -> DataFrame:
    scores = materialize(forest_scores(t), "scores")
    return ev.metrics(ev.predict(scores, "y_pred_prob"), "y_true", "y_pred")


@query()
def cv_metrics(t: Tables) -> DataFrame:
    rows = features(t)
    folded = materialize(op.stratified_folds(rows, "label", "doc_id", FOLDS), "folds")
    scores = op.cross_validate(folded, op.forest(TREES), "fold", FOLDS)
    flagged = ev.predict(scores.withColumn("y_true", F.col("label") == 1), "y_pred_prob")
    return ev.metrics(flagged, "y_true", "y_pred", ["fold"])
