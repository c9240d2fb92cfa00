"""Incremental jobs, run to the end; each query returns the table they have written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperlane.functions.ids import text_hash
from paperlane.functions.parse import text_to_blocks
from paperlane.operators import corpus
from paperlane.plans.automation import JOB_COLUMNS, JOBS_SQL
from paperlane.plans.loading import AS_OF, PREFIX, corpus_sql, existing_corpus, new_rows
from paperlane.plans.registry import Tables, query
from paperlane.session import new_work_path
from paperlane.sources import batches
from paperlane.sources.key_index import KeyIndex, append_unknown
from paperlane.sources.tables import append_rows
from paperlane.streaming import exports, incremental as op, job_state


def stream_source(t: Tables, name: str) -> tuple[str, StructType]:
    """Path and schema of a table, whether it is one file or a folder."""
    return f"{t.folder}/{name}.parquet", t(name).schema


# An hour is closed once the watermark, one hour behind the newest event, has passed its end.
@query("""SELECT date_trunc('hour', ts) AS hour, count(*) AS n_messages,
    date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AS closed
    FROM events GROUP BY 1""")
def stream_hourly(t: Tables) -> DataFrame:
    path, checkpoint = new_work_path(t.spark, "hourly"), new_work_path(t.spark, "hourly-state")
    stream = op.read_stream(t.spark, *stream_source(t, "events"))
    op.run_hourly_counts(stream, "event_id", "ts", path, checkpoint, delay="1 hour")
    return op.read_hourly_counts(t.spark, path, delay="1 hour")


_ENRICHED = """SELECT doc_id, sha256(text) AS job_id, CAST(len(list_filter(string_split(text, chr(10)),
    lambda x: trim(x) <> '')) AS int) AS n_lines FROM documents"""


def _enrich(rows: DataFrame) -> DataFrame:
    lines = F.size(text_to_blocks(F.col("text")))
    return rows.select("doc_id", text_hash(F.col("text")).alias("job_id"), lines.alias("n_lines"))


# The second run finds the labelled documents in the index and enriches the others; the third one is a repetition.
@query(_ENRICHED)
def resume_append_indexed(t: Tables) -> DataFrame:
    root = new_work_path(t.spark, "enriched")
    index = KeyIndex(t.spark, root, "enriched", "doc_id", "bigint", f"enriched_keys_{root.rpartition('-')[2]}", 16)
    documents = t("documents")
    seen = documents.join(t("labels").select("doc_id"), "doc_id", "left_semi")
    for batch, rows in (("labelled", seen), ("all", documents), ("again", documents)):
        append_unknown(t.spark, rows, index, batch, _enrich)
    index.close()
    return batches.read_committed(t.spark, root, "enriched")


@query(_ENRICHED)
def resume_append(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "enriched")
    documents = t("documents")
    # a run that saw the labelled documents only, then one that sees all of them
    seen = documents.join(t("labels").select("doc_id"), "doc_id", "left_semi")
    op.resume_append(t.spark, seen, "doc_id", _enrich, path)
    return op.resume_append(t.spark, documents, "doc_id", _enrich, path)


@query("SELECT page_id, sha256(html) AS job_id FROM pages")
def stream_append(t: Tables) -> DataFrame:
    path, checkpoint = new_work_path(t.spark, "pages"), new_work_path(t.spark, "pages-state")

    def enrich(rows: DataFrame) -> DataFrame:
        return rows.select("page_id", text_hash(F.col("html")).alias("job_id"))

    # the second run finds no new file and adds nothing
    for _ in range(2):
        stream = op.read_stream(t.spark, *stream_source(t, "pages"))
        op.stream_append(stream, enrich, path, checkpoint)
    return t.spark.read.parquet(path)


@query(f"""SELECT sha256(text) AS job_id, '{PREFIX}' || sha256(text) || '.json' AS ocr_link, 'SUCCEEDED' AS status,
        TIMESTAMP '{AS_OF}' AS created_at FROM documents
    UNION ALL SELECT sha256(text), '{PREFIX}' || sha256(text) || '.json', 'SUCCEEDED', TIMESTAMP '{AS_OF}'
    FROM benchmark""")
def job_table_append(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "jobs")
    for name in ("documents", "benchmark"):
        rows = corpus.fill_ids(t(name).select("text"), PREFIX)
        append_rows(corpus.job_registrations(rows, AS_OF), path)
    return t.spark.read.parquet(path).select("job_id", "ocr_link", "status", "created_at")


# Two tables grow together. One batch comes twice, one run is cut off before its commit.
@query("""SELECT 'events' AS name, event_id FROM events
    UNION ALL SELECT 'errors', event_id FROM events WHERE event_type = 'error'""")
def batch_append(t: Tables) -> DataFrame:
    root = new_work_path(t.spark, "batches")
    events = t("events").select("event_id", "event_type")
    for part, name in enumerate(("even", "odd")):
        rows = events.filter(F.col("event_id") % 2 == part)
        batches.write_attempt(rows, root, "events", f"cut-off-{name}")
        for _ in range(2):
            batches.append_batch(t.spark, {"events": rows, "errors": rows.filter("event_type = 'error'")}, root, name)
    found = [batches.read_committed(t.spark, root, n).select(F.lit(n).alias("name"), "event_id") for n in ("events", "errors")]
    return found[0].unionByName(found[1])


@query(corpus_sql())
def corpus_upsert_indexed(t: Tables) -> DataFrame:
    root = new_work_path(t.spark, "corpus")
    index = KeyIndex(t.spark, root, "corpus", "ticket_uuid", "string", f"corpus_keys_{root.rpartition('-')[2]}", 16)
    batches.append_batch(t.spark, {"corpus": existing_corpus(t)}, root, "start")
    rows = corpus.fill_ids(new_rows(t), PREFIX)
    # copies inside the new rows stay, so they have to come in the same batch; the last one is started twice
    half = F.pmod(F.xxhash64("ticket_uuid"), F.lit(2))
    for part in (0, 1, 1):
        append_unknown(t.spark, rows.filter(half == part), index, f"part {part}")
    index.close()
    return batches.read_committed(t.spark, root, "corpus")


# The watermark at the end is what the timers have run up to; it has whole milliseconds.
@query(f"""WITH {JOBS_SQL}, clock AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR AS now FROM events), submitted AS (
        SELECT job_id, min(created_at) AS submitted_at FROM job_events WHERE status = 'SUBMITTED' GROUP BY job_id
    ), ended AS (
        SELECT job_id, arg_min(created_at, id) AS ended_at, arg_min(status, id) AS status FROM job_events JOIN submitted USING (job_id)
        WHERE status IN ('SUCCEEDED', 'FAILED') AND created_at >= submitted_at GROUP BY job_id
    ), lost AS (SELECT job_id, min(created_at) AS first_seen FROM job_events GROUP BY job_id
        HAVING min(created_at) < (SELECT now - INTERVAL 7 DAY FROM clock) AND count(*) FILTER (status IN ('SUCCEEDED', 'FAILED')) = 0)
    SELECT job_id, submitted_at, CASE WHEN submitted_at IS NULL THEN NULL WHEN ended_at <= submitted_at + INTERVAL 7200 SECOND THEN status
        WHEN now > submitted_at + INTERVAL 7200 SECOND THEN 'TIMEOUT' ELSE 'SUBMITTED' END AS outcome, first_seen, first_seen IS NOT NULL AS lost
    FROM submitted FULL JOIN lost USING (job_id) LEFT JOIN ended USING (job_id), clock""")
def stream_job_states(t: Tables) -> DataFrame:
    folder, path, state = (new_work_path(t.spark, name) for name in ("job-events", "job-changes", "job-state"))
    events = t("events").selectExpr(*JOB_COLUMNS)
    day = F.dayofmonth("created_at")
    # three runs, each of which goes on where the one before has stopped
    for part in (day <= 10, (day > 10) & (day <= 20), day > 20):
        events.filter(part).write.mode("append").parquet(folder)
        stream = op.read_stream(t.spark, folder, events.schema)
        job_state.run_job_states(stream, path, state, 7200, 7, "1 hour")
    return job_state.read_job_states(t.spark, path).filter("submitted_at IS NOT NULL OR lost")


# Errors play the part of exports, one folder per hour; an hour without any is a gap in an hourly schedule.
@query("""WITH e AS (SELECT date_trunc('hour', ts) AS slot, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1),
    s AS (SELECT slot, n, CASE WHEN slot - lag(slot) OVER (ORDER BY slot) <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS new FROM e),
    r AS (SELECT slot, n, sum(new) OVER (ORDER BY slot) AS session FROM s),
    sessions AS (SELECT min(slot) AS first_export, max(slot) AS last_export, CAST(sum(n) AS bigint) AS n_messages FROM r GROUP BY session),
    done AS (SELECT * FROM sessions WHERE last_export + INTERVAL 1 HOUR <= (SELECT max(slot) - INTERVAL 2 HOUR FROM e)),
    gaps AS (SELECT 'errors' AS feed, lag(last_export) OVER (ORDER BY first_export) AS last_export, first_export AS next_export, n_messages FROM done)
    SELECT * FROM gaps WHERE last_export IS NOT NULL""")
def stream_export_gaps(t: Tables) -> DataFrame:
    root, path, state = (new_work_path(t.spark, name) for name in ("exports", "sessions", "sessions-state"))
    base = f"{root}/errors"
    messages = t("events").filter("event_type = 'error'").select(
        F.date_format("ts", "yyyy_MM_dd").alias("day"), F.date_format("ts", "HH00").alias("time"),
        F.col("event_id").cast("string").alias("messageId"), F.array(F.struct(F.col("event_type").alias("id"))).alias("attachments"),
    )
    # two runs: the second one goes on with the session that the first one left open
    for half in ("day < '2024_01_16'", "day >= '2024_01_16'"):
        part = messages.filter(half).repartition("day", "time")
        part.write.partitionBy("day", "time").mode("append").json(base)
        # files of Spark have a message per line
        stream = exports.read_export_stream(t.spark, base, exports.without_names, multiLine=False)
        exports.run_export_sessions(stream, path, state, "1 hour", "2 hours")
    return exports.schedule_gaps(t.spark, path)
