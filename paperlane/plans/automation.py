"""Production predictions: decisions, daily automation, pivots, job outcomes.

``events`` stands in for the prediction table: a user is a ticket, a user's five-day block an
attachment, an event an attribute/value row, and the event id the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.functions.parse import NUMBER_PATTERN, mentions_true, quoted_double, quoted_true
from paperlane.functions.predicates import all_present, equals_quoted
from paperlane.operators import jobs, joins, predictions as op, profile
from paperlane.plans.registry import Tables, query, rounded

# Valid in Spark SQL and in the checking SQL.
PREDICTION_COLUMNS = (
    "event_id AS id",
    "user_id AS ticket_uuid",
    "concat(user_id, '-', CAST(floor((day(ts) - 1) / 5) AS int)) AS attachment_id",
    "ts AS created_at",
    """CASE WHEN event_type = 'error' AND value < 2 THEN NULL
            WHEN event_type IN ('signup', 'purchase') AND value >= 40 THEN 'classifier_alpha'
            WHEN event_type IN ('signup', 'purchase') THEN 'classifier_beta'
            ELSE 'extraction' END AS type""",
    """CASE WHEN event_type = 'signup' AND value >= 60 THEN 'is_positive'
            WHEN event_type = 'signup' THEN 'class_pred'
            WHEN event_type = 'purchase' THEN 'class_prob'
            WHEN event_type = 'click' THEN 'case_id'
            WHEN event_type = 'view' AND value > 150 THEN NULL
            WHEN event_type = 'view' THEN 'name'
            ELSE 'due_date' END AS subtype""",
    """CASE WHEN event_type = 'signup' AND (value >= 100 OR (value >= 10 AND value < 60))
                THEN concat(chr(39), 'True', chr(39))
            WHEN event_type = 'signup' THEN concat(chr(39), 'False', chr(39))
            WHEN event_type = 'purchase' AND value < 5 THEN 'n/a'
            WHEN event_type = 'purchase' AND value < 7 THEN concat(chr(39), 'nan', chr(39))
            WHEN event_type = 'purchase' AND value < 8 THEN concat(chr(39), '0.95d', chr(39))
            WHEN event_type = 'purchase' AND value < 9 THEN concat(chr(39), '1f', chr(39))
            WHEN event_type = 'purchase' AND value < 10 THEN concat(chr(39), '1e0', chr(39))
            WHEN event_type = 'purchase' AND value < 100
                THEN concat(chr(39), CAST(floor(value) / 100 AS string), chr(39))
            WHEN event_type = 'purchase' THEN concat(chr(39), '1.0', chr(39))
            WHEN event_type IN ('click', 'view') AND value < 2 THEN NULL
            WHEN event_type IN ('click', 'view') AND value < 5 THEN ''
            WHEN event_type = 'click' THEN concat('1', lpad(CAST(event_id AS string), 11, '0'))
            WHEN event_type = 'view' THEN concat('Name ', user_id)
            ELSE substr(CAST(ts AS string), 1, 10) END AS value""",
)
PREDS_SQL = f"preds AS (SELECT {', '.join(PREDICTION_COLUMNS)} FROM events)"
NAMES = op.PredictionNames(classifier="classifier_alpha")
PARAMETERS = ("case_id", "name", "due_date")

_NUMBER = f"""(CASE WHEN regexp_matches(replace(value, chr(39), ''), '{NUMBER_PATTERN}')
    THEN try_cast(replace(value, chr(39), '') AS double) END)"""


def _decided(flag_only: bool) -> str:
    has = " ".join(
        f", arg_min(coalesce(value, ''), id) FILTER (subtype = '{p}') AS v_{p}" for p in PARAMETERS
    )
    complete = " AND ".join(f"coalesce(v_{p}, '') <> ''" for p in PARAMETERS)
    otherwise = "NULL" if flag_only else "coalesce(prob, 0) >= 0.95"
    return f"""{PREDS_SQL}, facts AS (
        SELECT attachment_id, arg_min(ticket_uuid, id) AS ticket_uuid,
               CAST(arg_min(created_at, id) AS date) AS day,
               count(*) FILTER (subtype = 'is_positive') AS n_flag,
               arg_min(contains(coalesce(value, ''), 'True'), id) FILTER (subtype = 'is_positive') AS flag,
               arg_min(coalesce({_NUMBER}, -1), id)
                   FILTER (subtype = 'class_prob' AND type = 'classifier_alpha') AS prob {has}
        FROM preds GROUP BY attachment_id
    ), judged AS (
        SELECT *, CASE WHEN n_flag > 0 THEN flag ELSE {otherwise} END AS is_positive FROM facts
    ), decided AS (
        SELECT attachment_id, ticket_uuid, day, is_positive,
               coalesce(is_positive, false) AND {complete} AS is_complete,
               coalesce(is_positive, false) AND {complete} AS is_automatic
        FROM judged
    )"""


DECIDED_SQL = _decided(flag_only=False)
RATE_SQL = f"""{DECIDED_SQL}, daily AS (
    SELECT day, count(*) AS incoming, count(*) FILTER (is_automatic) AS automized FROM decided GROUP BY day
), rates AS (
    SELECT *, 100.0::double * automized / incoming AS automation_perc FROM daily)"""


def predictions(t: Tables) -> DataFrame:
    return t("events").selectExpr(*PREDICTION_COLUMNS)


def decided(t: Tables) -> DataFrame:
    return op.decisions(predictions(t), NAMES)


@query(f"WITH {DECIDED_SQL} SELECT * FROM decided")
def automation_decision(t: Tables) -> DataFrame:
    return decided(t)


@query(f"WITH {_decided(flag_only=True)} SELECT * FROM decided")
def automation_decision_by_flag(t: Tables) -> DataFrame:
    return op.decisions(predictions(t), NAMES, flag_only=True)


@query(f"""WITH {_decided(flag_only=True)}
    SELECT count(*) AS n_attachments, count(*) FILTER (is_positive IS NULL) AS n_undecided FROM decided""")
def undecided_count(t: Tables) -> DataFrame:
    return op.undecided(op.decisions(predictions(t), NAMES, flag_only=True))


@query(f"""WITH {RATE_SQL}
    SELECT day, incoming, automized, round_even(automation_perc, 6) AS automation_perc FROM rates""")
def daily_automation_rate(t: Tables) -> DataFrame:
    return rounded(op.daily_rate(decided(t)), "automation_perc")


@query(f"""WITH {DECIDED_SQL}, auto AS (
        SELECT day, count(*) FILTER (is_automatic) AS automized FROM decided GROUP BY day
    ), inc AS (
        SELECT CAST(o_orderdate AS date) AS day, count(*) AS incoming FROM orders GROUP BY 1
    )
    SELECT coalesce(inc.day, auto.day) AS day, incoming, automized,
           round_even(100.0::double * automized / incoming, 6) AS automation_perc
    FROM inc FULL JOIN auto ON inc.day = auto.day""")
def daily_rate_by_incoming(t: Tables) -> DataFrame:
    incoming = t("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("incoming")
    )
    return rounded(op.daily_rate(decided(t), incoming), "automation_perc")


@query(f"""WITH {RATE_SQL}
    SELECT CAST(sum(incoming) AS bigint) AS total_incoming,
           CAST(sum(automized) AS bigint) AS total_automized,
           round_even(100.0::double * sum(automized) / sum(incoming), 6) AS overall_perc,
           round_even(avg(automation_perc), 6) AS mean_perc,
           round_even(min(automation_perc), 6) AS min_perc,
           round_even(max(automation_perc), 6) AS max_perc,
           round_even(stddev_samp(automation_perc), 6) AS std_perc, count(*) AS n_days
    FROM rates""")
def daily_automation_summary(t: Tables) -> DataFrame:
    summary = op.rate_summary(op.daily_rate(decided(t)))
    return rounded(summary, "overall_perc", "mean_perc", "min_perc", "max_perc", "std_perc")


@query(f"""WITH {DECIDED_SQL}
    SELECT day, count(*) FILTER (is_positive) AS n_positive,
           count(*) FILTER (is_positive AND is_complete) AS n_automatic,
           count(*) FILTER (NOT is_positive) AS n_negative,
           count(*) AS n_attachments,
           count(DISTINCT ticket_uuid) FILTER (is_complete) AS n_automatic_tickets,
           count(DISTINCT ticket_uuid) AS n_tickets,
           round_even(100.0::double * count(DISTINCT ticket_uuid) FILTER (is_complete)
                      / count(DISTINCT ticket_uuid), 6) AS ticket_automation_perc
    FROM decided GROUP BY day""")
def daily_ticket_stats(t: Tables) -> DataFrame:
    return rounded(op.daily_volume(decided(t)), "ticket_automation_perc")


@query(f"""WITH {DECIDED_SQL}, a AS (
        SELECT day, count(*) FILTER (is_positive) AS n_positive FROM decided WHERE is_positive GROUP BY day
    ), b AS (
        SELECT CAST(ts AS date) AS day, count(*) AS n_events, count(DISTINCT user_id) AS n_users
        FROM events GROUP BY 1)
    SELECT coalesce(a.day, b.day) AS day, coalesce(n_positive, 0) AS n_positive,
           coalesce(n_events, 0) AS n_events, coalesce(n_users, 0) AS n_users
    FROM a FULL JOIN b ON a.day = b.day""")
def daily_merge(t: Tables) -> DataFrame:
    positive = decided(t).filter("is_positive").groupBy("day").agg(F.count("*").alias("n_positive"))
    events = t("events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n_events"), F.count_distinct("user_id").alias("n_users")
    )
    return joins.merge_daily([positive, events], fill=True)


SUBTYPES = ("class_pred", "class_prob", "name", "case_id", "due_date")


@query(f"""WITH {PREDS_SQL}
    SELECT attachment_id, {', '.join(
        f"arg_min(value, id) FILTER (subtype = '{s}' AND value IS NOT NULL) AS {s}" for s in SUBTYPES)}
    FROM preds WHERE subtype IN ({', '.join(f"'{s}'" for s in SUBTYPES)}) GROUP BY attachment_id""")
def prediction_pivot(t: Tables) -> DataFrame:
    return op.pivot_first(predictions(t), SUBTYPES, NAMES)


# All pairs that the predictions can have; the count of others stays 0.
PAIRS = tuple(
    f"{type_}__{subtype}" for type_, subtypes in (
        ("classifier_alpha", ("class_pred", "class_prob", "is_positive")), ("classifier_beta", ("class_pred", "class_prob")),
        ("extraction", ("", "case_id", "due_date", "name")),
    ) for subtype in subtypes
)


def _flatten_sql(pairs: tuple[str, ...]) -> str:
    columns = ", ".join(f"arg_min(value, id) FILTER (pair = '{p}' AND value IS NOT NULL) AS \"{p}\"" for p in pairs)
    listed = ", ".join(f"'{p}'" for p in pairs)
    return f"""WITH {PREDS_SQL}, keyed AS (SELECT *, type || '__' || coalesce(subtype, '') AS pair FROM preds)
    SELECT attachment_id, arg_min(ticket_uuid, id) AS ticket_uuid, arg_min(created_at, id) AS created_at, {columns},
        count(DISTINCT pair) FILTER (value IS NOT NULL AND pair NOT IN ({listed})) AS n_other_pairs
    FROM keyed GROUP BY attachment_id"""


@query(_flatten_sql(PAIRS))
def prediction_flatten(t: Tables) -> DataFrame:
    return op.flatten(predictions(t), ["ticket_uuid", "created_at"], NAMES, PAIRS)


@query(_flatten_sql(PAIRS[:3]))
def prediction_flatten_chosen(t: Tables) -> DataFrame:
    return op.flatten(predictions(t), ["ticket_uuid", "created_at"], NAMES, PAIRS[:3])


@query(f"""WITH {PREDS_SQL}
    SELECT attachment_id,
        CASE WHEN contains(arg_min(type, id) FILTER (subtype = 'class_pred' AND value = chr(39) || 'True' || chr(39)), 'alpha')
             THEN 'alpha'
             WHEN contains(arg_min(type, id) FILTER (subtype = 'class_pred' AND value = chr(39) || 'True' || chr(39)), 'beta')
             THEN 'beta' END AS winner,
        nullif(arg_min(coalesce({_NUMBER}, -1), id) FILTER (subtype = 'class_prob' AND type = 'classifier_alpha'), -1)
            AS prob_alpha,
        nullif(arg_min(coalesce({_NUMBER}, -1), id) FILTER (subtype = 'class_prob' AND type = 'classifier_beta'), -1)
            AS prob_beta
    FROM preds GROUP BY attachment_id""")
def prediction_class_summary(t: Tables) -> DataFrame:
    classes = {"alpha": "classifier_alpha", "beta": "classifier_beta"}
    return op.class_summary(predictions(t), classes, NAMES)


@query(f"""WITH {PREDS_SQL}
    SELECT id, coalesce(value = chr(39) || 'True' || chr(39), NULL) AS is_true,
           contains(value, 'True') AS has_true, {_NUMBER} AS number,
           lower(value) = chr(39) || 'false' || chr(39) AS is_false
    FROM preds""")
def quoted_literals(t: Tables) -> DataFrame:
    value = F.col("value")
    return predictions(t).select(
        "id", quoted_true(value).alias("is_true"), mentions_true(value).alias("has_true"),
        quoted_double(value).alias("number"), equals_quoted(value, "False").alias("is_false"),
    )


@query(f"""WITH {PREDS_SQL}, p AS (
        SELECT attachment_id, {', '.join(
            f"arg_min(value, id) FILTER (subtype = '{s}' AND value IS NOT NULL) AS {s}" for s in SUBTYPES)}
        FROM preds WHERE subtype IN ({', '.join(f"'{s}'" for s in SUBTYPES)}) GROUP BY attachment_id)
    SELECT attachment_id, coalesce(case_id, '') <> '' AND coalesce(name, '') <> ''
           AND coalesce(due_date, '') <> '' AS all_there FROM p""")
def parameters_present(t: Tables) -> DataFrame:
    wide = op.pivot_first(predictions(t), SUBTYPES, NAMES)
    there = all_present([F.col(name) for name in PARAMETERS])
    return wide.select("attachment_id", there.alias("all_there"))


SCORED_SQL = """scored AS (
    SELECT event_id, least(value / 100.0::double, 1.0::double) AS score,
           CASE WHEN event_type IN ('click', 'view') THEN event_type END AS slug,
           CASE WHEN value >= 75 THEN 'x' END AS name FROM events)"""


def banded(t: Tables) -> DataFrame:
    return t("events").select(
        "event_id", F.least(F.col("value") / 100.0, F.lit(1.0)).alias("score"),
        F.when(F.col("event_type").isin("click", "view"), F.col("event_type")).alias("slug"),
        F.when(F.col("value") >= 75, "x").alias("name"),
    )


def _band_sql(body: str) -> str:
    bands = ", ".join(f"('{n}', {lo}::double, {hi}::double, {str(n == '0.9-1.0').lower()})" for n, lo, hi in op.BANDS)
    return f"""WITH {SCORED_SQL}, bands(band, lo, hi, last) AS (VALUES {bands}), joined AS (
        SELECT b.band, s.* FROM bands b LEFT JOIN scored s
        ON s.score >= b.lo AND (s.score < b.hi OR (b.last AND s.score <= b.hi))) {body}"""


@query(_band_sql("SELECT band, count(event_id) AS n_rows FROM joined GROUP BY band"))
def score_bands(t: Tables) -> DataFrame:
    return op.band_counts(banded(t), "score")


@query(_band_sql(" UNION ALL ".join(f"""
    SELECT band, '{f}' AS field, count(event_id) AS total, count({f}) AS present,
           count(event_id) - count({f}) AS missing,
           coalesce(round_even(100.0::double * count({f}) / nullif(count(event_id), 0), 1), 0) AS pct
    FROM joined GROUP BY band""" for f in ("slug", "name"))))
def band_presence(t: Tables) -> DataFrame:
    return op.band_presence(banded(t), "score", ["slug", "name"])


# A user's day is an OCR job.
JOB_COLUMNS = (
    "event_id AS id",
    "concat(user_id, '/', substr(CAST(ts AS string), 1, 10)) AS job_id",
    """CASE WHEN event_type = 'signup' THEN 'SUBMITTED' WHEN event_type = 'purchase' THEN 'SUCCEEDED'
            WHEN event_type = 'error' THEN 'FAILED' ELSE 'IN_PROGRESS' END AS status""",
    "ts AS created_at",
)
JOBS_SQL = f"job_events AS (SELECT {', '.join(JOB_COLUMNS)} FROM events)"
OUTCOME_SQL = f"""{JOBS_SQL}, submitted AS (
        SELECT job_id, min(created_at) AS submitted_at FROM job_events WHERE status = 'SUBMITTED' GROUP BY job_id
    ), ended AS (
        SELECT e.*, row_number() OVER (PARTITION BY job_id ORDER BY id) AS rn
        FROM job_events e JOIN submitted s USING (job_id)
        WHERE status IN ('SUCCEEDED', 'FAILED') AND created_at >= submitted_at
    ), outcomes AS (
        SELECT s.job_id, s.submitted_at,
            CASE WHEN e.created_at <= s.submitted_at + INTERVAL 7200 SECOND THEN e.status
                 WHEN TIMESTAMP '2024-01-30 23:00:00' > s.submitted_at + INTERVAL 7200 SECOND THEN 'TIMEOUT'
                 ELSE 'SUBMITTED' END AS outcome
        FROM submitted s LEFT JOIN ended e ON e.job_id = s.job_id AND e.rn = 1)"""


def job_events(t: Tables) -> DataFrame:
    return t("events").selectExpr(*JOB_COLUMNS)


def _outcomes(t: Tables) -> DataFrame:
    return jobs.job_outcomes(job_events(t), 7200, "2024-01-30 23:00:00")


@query(f"WITH {OUTCOME_SQL} SELECT * FROM outcomes")
def job_outcome(t: Tables) -> DataFrame:
    return _outcomes(t)


@query(f"""WITH {OUTCOME_SQL}
    SELECT count(*) AS n_jobs, count(*) FILTER (outcome = 'SUCCEEDED') AS n_succeeded,
           count(*) FILTER (outcome = 'FAILED') AS n_failed,
           count(*) FILTER (outcome = 'TIMEOUT') AS n_timeout,
           count(*) FILTER (outcome = 'SUBMITTED') AS n_submitted FROM outcomes""")
def job_outcome_counts(t: Tables) -> DataFrame:
    return jobs.outcome_counts(_outcomes(t))


RESULT_COLUMNS = ("concat(user_id, '/', substr(CAST(ts AS string), 1, 10)) AS job_id", "props")


@query(f"""WITH {OUTCOME_SQL}, results AS (
        SELECT job_id, max(props) AS text FROM (SELECT {', '.join(RESULT_COLUMNS)} FROM events) GROUP BY job_id)
    SELECT o.job_id, o.submitted_at, o.outcome,
           CASE WHEN o.outcome = 'SUCCEEDED' THEN coalesce(r.text, '') ELSE '' END AS text
    FROM outcomes o LEFT JOIN results r USING (job_id)""")
def job_text(t: Tables) -> DataFrame:
    results = t("events").selectExpr(*RESULT_COLUMNS).groupBy("job_id").agg(F.max("props").alias("text"))
    return jobs.job_texts(_outcomes(t), results)


@query(f"""WITH {JOBS_SQL}
    SELECT job_id, min(created_at) AS first_seen FROM job_events GROUP BY job_id
    HAVING min(created_at) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY
       AND count(*) FILTER (status IN ('SUCCEEDED', 'FAILED')) = 0""")
def lost_jobs(t: Tables) -> DataFrame:
    return jobs.lost_jobs(job_events(t), "2024-01-31 00:00:00")


@query("""WITH known AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error')
    SELECT count(*) AS n_total, count(*) FILTER (k.user_id IS NOT NULL) AS n_known,
           count(*) FILTER (k.user_id IS NULL) AS n_new
    FROM (SELECT o_custkey AS user_id FROM orders) o LEFT JOIN known k USING (user_id)""")
def load_counters(t: Tables) -> DataFrame:
    known = t("events").filter("event_type = 'error'").select("user_id")
    return profile.load_counters(t("orders").select(F.col("o_custkey").alias("user_id")), known, "user_id")
