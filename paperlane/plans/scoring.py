"""Metrics, curves, sweeps and review lists on scored rows.

Line items are the scored rows: a returned item is a positive. One score has many ties, the other
nearly none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.operators import evaluation as ev
from paperlane.plans.registry import Tables, query, rounded

_SCORED = """scored AS (SELECT l_orderkey, l_linenumber, l_linestatus, l_returnflag = 'R' AS y_true,
    l_discount * 5 + l_tax * 6.25::double AS y_pred_prob,
    l_extendedprice / (l_extendedprice + 30000) AS fine_score FROM lineitem)"""


def scored(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", (F.col("l_returnflag") == "R").alias("y_true"),
        (F.col("l_discount") * 5 + F.col("l_tax") * 6.25).alias("y_pred_prob"),
        (price / (price + 30000)).alias("fine_score"),
    )


def _metrics_sql(source: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""c AS (SELECT {keys}count(*) FILTER (NOT y_true AND NOT y_pred) AS tn,
            count(*) FILTER (NOT y_true AND y_pred) AS fp, count(*) FILTER (y_true AND NOT y_pred) AS fn,
            count(*) FILTER (y_true AND y_pred) AS tp FROM {source} {group}),
        m AS (SELECT *, coalesce((tp + tn)::double / nullif(tn + fp + fn + tp, 0), 0) AS a,
            coalesce(tp::double / nullif(tp + fp, 0), 0) AS p, coalesce(tp::double / nullif(tp + fn, 0), 0) AS r FROM c)
        SELECT {keys}tn, fp, fn, tp, round_even(a, 6) AS accuracy, round_even(p, 6) AS precision,
            round_even(r, 6) AS recall, round_even(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1 FROM m"""


_METRICS = ("accuracy", "precision", "recall", "f1")
_PREDICTED = f"{_SCORED}, predicted AS (SELECT *, y_pred_prob >= 0.5::double AS y_pred FROM scored)"


@query(f"WITH {_PREDICTED}, {_metrics_sql('predicted')}")
def confusion_metrics(t: Tables) -> DataFrame:
    return rounded(ev.metrics(ev.predict(scored(t), "y_pred_prob"), "y_true", "y_pred"), *_METRICS)


@query(f"WITH {_PREDICTED}, {_metrics_sql('predicted', 'l_linestatus')}")
def metrics_by_group(t: Tables) -> DataFrame:
    predicted = ev.predict(scored(t), "y_pred_prob")
    return rounded(ev.metrics(predicted, "y_true", "y_pred", ["l_linestatus"]), *_METRICS)


_CLASSES = """pc AS (SELECT l_returnflag AS t, CASE WHEN l_discount >= 0.07::double THEN 'A'
    WHEN l_tax >= 0.04::double THEN 'R' ELSE 'N' END AS p FROM lineitem),
    names AS (SELECT t AS class FROM pc UNION SELECT p FROM pc),
    per AS (SELECT class, (SELECT count(*) FROM pc WHERE t = class) AS support,
        (SELECT count(*) FROM pc WHERE p = class) AS predicted,
        (SELECT count(*) FROM pc WHERE t = class AND p = class) AS tp FROM names),
    pr AS (SELECT *, coalesce(tp::double / nullif(predicted, 0), 0) AS precision,
        coalesce(tp::double / nullif(support, 0), 0) AS recall FROM per),
    f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pr),
    lines AS (SELECT class, precision, recall, f1, support FROM f
        UNION ALL SELECT 'accuracy', sum(tp)::double / sum(support), sum(tp)::double / sum(support),
            sum(tp)::double / sum(support), sum(support) FROM f
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
            sum(f1 * support) / sum(support), sum(support) FROM f)"""


@query(f"""WITH {_CLASSES} SELECT class, round_even(precision, 6) AS precision, round_even(recall, 6) AS recall,
    round_even(f1, 6) AS f1, CAST(support AS bigint) AS support FROM lines""")
def class_report(t: Tables) -> DataFrame:
    guess = F.when(F.col("l_discount") >= 0.07, "A").when(F.col("l_tax") >= 0.04, "R").otherwise("N")
    pairs = t("lineitem").select("l_returnflag", guess.alias("guess"))
    return rounded(ev.class_report(pairs, "l_returnflag", "guess"), "precision", "recall", "f1")


_HIST = f"""{_SCORED}, hist AS (SELECT fine_score AS score, count(*) FILTER (y_true) AS pos,
        count(*) FILTER (NOT y_true) AS neg FROM scored GROUP BY 1),
    curve AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
        sum(neg) OVER (ORDER BY score) - neg AS below, sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg FROM hist)"""


@query(f"""WITH {_HIST} SELECT CAST(sum(pos) AS bigint) AS n_pos, CAST(sum(neg) AS bigint) AS n_neg,
    round_even(sum(pos * (below + neg / 2.0::double)) / (sum(pos)::double * sum(neg)), 6) AS roc_auc FROM curve""")
def roc_auc(t: Tables) -> DataFrame:
    return rounded(ev.roc_auc(scored(t), "y_true", "fine_score"), "roc_auc")


@query(f"""WITH {_HIST.replace('fine_score AS score', 'y_pred_prob AS score')}
    SELECT CAST(sum(pos) AS bigint) AS n_pos, CAST(sum(neg) AS bigint) AS n_neg,
    round_even(sum(pos * (below + neg / 2.0::double)) / (sum(pos)::double * sum(neg)), 6) AS roc_auc FROM curve""")
def roc_auc_with_ties(t: Tables) -> DataFrame:
    return rounded(ev.roc_auc(scored(t), "y_true", "y_pred_prob"), "roc_auc")


@query(f"""WITH {_HIST} SELECT round_even(score, 6) AS threshold, round_even(fp::double / n_neg, 6) AS fpr,
        round_even(tp::double / n_pos, 6) AS tpr FROM curve
    UNION ALL SELECT NULL, 0.0::double, 0.0::double""")
def roc_points(t: Tables) -> DataFrame:
    return rounded(ev.roc_points(scored(t), "y_true", "fine_score"), "threshold", "fpr", "tpr")


@query(f"""WITH {_HIST} SELECT round_even(score, 6) AS threshold, round_even(tp::double / (tp + fp), 6) AS precision,
        round_even(tp::double / n_pos, 6) AS recall FROM curve
    UNION ALL SELECT NULL, 1.0::double, 0.0::double""")
def pr_points(t: Tables) -> DataFrame:
    return rounded(ev.pr_points(scored(t), "y_true", "fine_score"), "threshold", "precision", "recall")


def _sweep_sql(thresholds, percent: bool) -> str:
    values = ", ".join(f"({t}::double)" for t in thresholds)
    out = "round_even({0} * 100, 2) AS {1}" if percent else "round_even({0}, 6) AS {1}"
    return f"""WITH {_SCORED}, th(threshold) AS (VALUES {values}), c AS (
        SELECT threshold, count(*) FILTER (y_pred_prob >= threshold AND y_true) AS tp,
            count(*) FILTER (y_pred_prob >= threshold) AS pp, count(*) FILTER (y_true) AS pos, count(*) AS total
        FROM scored, th GROUP BY threshold),
        m AS (SELECT *, coalesce(tp::double / nullif(pp, 0), 0) AS p, coalesce(tp::double / nullif(pos, 0), 0) AS r FROM c)
        SELECT threshold, {out.format('p', 'precision')}, {out.format('r', 'recall')},
            {out.format('coalesce(2 * p * r / nullif(p + r, 0), 0)', 'f1')}, pp AS predicted_positive, total FROM m"""


@query(_sweep_sql(ev.THRESHOLDS, False))
def threshold_sweep(t: Tables) -> DataFrame:
    return rounded(ev.threshold_sweep(scored(t), "y_true", "y_pred_prob"), "precision", "recall", "f1")


@query(_sweep_sql(ev.KEY_THRESHOLDS, True))
def threshold_summary(t: Tables) -> DataFrame:
    return ev.threshold_summary(scored(t), "y_true", "y_pred_prob")


@query(f"""WITH {_PREDICTED} SELECT l_orderkey, l_linenumber, round_even(y_pred_prob, 6) AS y_pred_prob, 'fp' AS kind
        FROM predicted WHERE NOT y_true AND y_pred
    UNION ALL SELECT l_orderkey, l_linenumber, round_even(y_pred_prob, 6), 'fn' FROM predicted WHERE y_true AND NOT y_pred""")
def error_rows(t: Tables) -> DataFrame:
    predicted = ev.predict(scored(t), "y_pred_prob")
    parts = [
        ev.errors(predicted, "y_true", "y_pred", kind).select(
            "l_orderkey", "l_linenumber", "y_pred_prob", F.lit(kind).alias("kind")
        )
        for kind in ("fp", "fn")
    ]
    return rounded(parts[0].unionByName(parts[1]), "y_pred_prob")


@query(f"""WITH {_PREDICTED} SELECT count(*) FILTER (NOT y_true AND y_pred) AS n_fp,
    count(*) FILTER (y_true AND NOT y_pred) AS n_fn FROM predicted""")
def error_totals(t: Tables) -> DataFrame:
    return ev.error_totals(ev.predict(scored(t), "y_pred_prob"), "y_true", "y_pred")


@query(f"""WITH {_SCORED} SELECT l_orderkey, l_linenumber, round_even(y_pred_prob, 6) AS y_pred_prob FROM scored
    WHERE y_true AND l_linestatus = 'F' AND y_pred_prob < 0.7::double""")
def review_queue(t: Tables) -> DataFrame:
    expected = F.col("y_true") & (F.col("l_linestatus") == "F")
    queue = ev.review_queue(scored(t), "y_pred_prob", expected, 0.7, "l_orderkey")
    return rounded(queue.select("l_orderkey", "l_linenumber", "y_pred_prob"), "y_pred_prob")
