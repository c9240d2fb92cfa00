"""Model answers, dict literals and the comparison of two raters, on the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.functions import parse
from paperlane.operators import evaluation as ev
from paperlane.plans.registry import Tables, query, rounded
from paperlane.plans.relations import _PAIRS, extractor_pairs

# An answer per label: a sentence and a Python-like dict, in several shapes. Valid in both dialects.
ANSWER = """CASE
    WHEN quality = 1 AND toxic = 0 THEN concat('Answer ', doc_id, ': {', chr(39), 'is_a', chr(39), ': True, ',
        chr(39), 'is_b', chr(39), ': ', CASE WHEN lang = 'de' THEN 'True' ELSE 'False' END, '} or {"is_a": false}')
    WHEN quality = 1 AND lang = 'en' THEN concat('{"is_a": tr', chr(10), 'ue, "is_b": "true"}')
    WHEN quality = 1 THEN 'no object'
    WHEN toxic = 1 THEN '{bad}{"is_a": null, "is_b": 1}'
    WHEN lang = 'en' THEN '{"a": {"is_a": true}}'
    ELSE 'text {"is_b": true}' END"""
# A dict literal as another tool stored it.
LITERAL = """concat('{', chr(39), 'case_id', chr(39), ': ',
    CASE WHEN lang = 'en' THEN concat(chr(39), '1', doc_id, chr(39)) ELSE 'None' END,
    ', ', chr(39), 'name', chr(39), ': ', CASE WHEN quality = 1 THEN concat('"D', chr(39), 'A None, ', doc_id, '"')
    ELSE 'None' END, CASE WHEN toxic = 1 THEN ', oops' ELSE '}' END)"""
_SRC = f"""src AS (SELECT doc_id, lang, quality, toxic, {ANSWER} AS answer, {LITERAL} AS literal,
    CASE WHEN source <> 'src1' THEN lang IN ('de', 'en') END AS model_flag
    FROM labels JOIN documents USING (doc_id))"""


def _json_sql(last: bool) -> str:
    text = "answer"
    for old, new in ((" ", ""), (None, ""), ("True", "true"), ("False", "false"), ("None", "null")):
        text = f"replace({text}, {'chr(10)' if old is None else repr(old)}, '{new}')"
    text = f"replace({text}, chr(39), '\"')"
    found = f"regexp_extract_all({text}, '(?s)\\{{.*?\\}}')"
    return f"{found}[{-1 if last else 1}]"


def _flag_sql(key: str) -> str:
    return f"""CASE WHEN json_valid(obj) THEN CASE json_type(obj, '$.{key}') WHEN 'BOOLEAN'
        THEN CAST(json_extract_string(obj, '$.{key}') AS boolean) END END"""


def _known_sql(key: str) -> str:
    return f"coalesce(CASE WHEN json_valid(obj) THEN list_contains(json_keys(obj), '{key}') END, false)"


def answers(t: Tables) -> DataFrame:
    docs = t("documents").select("doc_id", "lang", "source")
    joined = t("labels").join(docs, "doc_id")
    model = F.when(F.col("source") != "src1", F.col("lang").isin("de", "en"))
    return joined.select(
        "doc_id", "quality", F.expr(ANSWER).alias("answer"), F.expr(LITERAL).alias("literal"),
        model.alias("model_flag"),
    )


@query(f"""WITH {_SRC}, o AS (SELECT doc_id, {_json_sql(False)} AS obj FROM src)
    SELECT doc_id, {_flag_sql('is_a')} AS is_a, {_flag_sql('is_b')} AS is_b FROM o""")
def answer_first(t: Tables) -> DataFrame:
    objects = answers(t).select("doc_id", parse.answer_object(F.col("answer")).alias("object"))
    return objects.select(
        "doc_id", *[parse.answer_flag(F.col("object"), key).alias(key) for key in ("is_a", "is_b")]
    )


@query(f"""WITH {_SRC}, o AS (SELECT doc_id, {_json_sql(True)} AS obj FROM src)
    SELECT doc_id, CASE WHEN {_known_sql('is_a')} THEN {_flag_sql('is_a')} ELSE false END AS is_a,
           CASE WHEN {_known_sql('is_b')} THEN {_flag_sql('is_b')} ELSE false END AS is_b FROM o""")
def answer_last(t: Tables) -> DataFrame:
    objects = answers(t).select("doc_id", parse.answer_object(F.col("answer"), last=True).alias("object"))
    return objects.select(
        "doc_id", *[parse.answer_flag(F.col("object"), key, False).alias(key) for key in ("is_a", "is_b")]
    )


@query(f"""WITH {_SRC} SELECT doc_id, CASE WHEN toxic = 0 AND lang = 'en' THEN '1' || doc_id END AS case_id,
    CASE WHEN toxic = 0 AND quality = 1 THEN 'D' || chr(39) || 'A None, ' || doc_id END AS name FROM src""")
def dict_literal(t: Tables) -> DataFrame:
    parsed = answers(t).select("doc_id", parse.dict_literal(F.col("literal")).alias("fields"))
    return parsed.select(
        "doc_id", F.col("fields")["case_id"].alias("case_id"), F.col("fields")["name"].alias("name")
    )


def rated(t: Tables) -> DataFrame:
    objects = answers(t).withColumn("object", parse.answer_object(F.col("answer")))
    return objects.select(
        "doc_id", "model_flag", *[parse.answer_flag(F.col("object"), k).alias(k) for k in ("is_a", "is_b")]
    )


_RATED = f"""{_SRC}, o AS (SELECT doc_id, model_flag, {_json_sql(False)} AS obj FROM src),
    rated AS (SELECT doc_id, model_flag, {_flag_sql('is_a')} AS is_a, {_flag_sql('is_b')} AS is_b FROM o)"""


@query(f"WITH {_RATED} SELECT model_flag, is_a, count(*) AS n_rows FROM rated GROUP BY 1, 2")
def rater_agreement(t: Tables) -> DataFrame:
    return ev.rater_quadrants(rated(t), "model_flag", "is_a")


@query(f"""WITH {_RATED}, c AS (SELECT count(*) FILTER (model_flag AND is_a) AS tp,
        count(*) FILTER (NOT model_flag AND is_a) AS fp, count(*) FILTER (model_flag AND NOT is_a) AS fn,
        count(*) FILTER (model_flag IS NULL OR is_a IS NULL) AS n_missing FROM rated),
    m AS (SELECT *, coalesce(tp::double / nullif(tp + fp, 0), 0) AS p, coalesce(tp::double / nullif(tp + fn, 0), 0) AS r FROM c)
    SELECT round_even(p, 6) AS precision, round_even(r, 6) AS recall,
           round_even(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1, n_missing FROM m""")
def rater_metrics(t: Tables) -> DataFrame:
    return rounded(ev.rater_metrics(rated(t), "model_flag", "is_a"), "precision", "recall", "f1")


@query(f"WITH {_RATED} SELECT doc_id FROM rated WHERE is_a AND is_b")
def both_flags(t: Tables) -> DataFrame:
    return ev.both_true(rated(t), "is_a", "is_b").select("doc_id")


@query(f"""SELECT count(*) AS n_rows, count(*) FILTER (found IS NOT DISTINCT FROM truth) AS n_equal,
    count(*) FILTER (found IS NULL AND truth IS NOT NULL) AS n_not_found,
    count(*) FILTER (found IS NOT NULL AND truth IS NULL) AS n_no_truth,
    round_even(count(*) FILTER (found IS NOT DISTINCT FROM truth)::double / count(*), 6) AS agreement FROM {_PAIRS}""")
def extractor_accuracy(t: Tables) -> DataFrame:
    return rounded(ev.extractor_accuracy(extractor_pairs(t), "found", "truth"), "agreement")
