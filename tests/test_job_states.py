"""The states of all jobs at once against the rules for one job."""

import random

import pytest
from pyspark.sql import functions as F

from paperlane.streaming import incremental, job_state
from paperlane.streaming.job_state import DAY, ENDS, EVENTS, NO_ORDER, SECOND, STATES, TERMINAL, Job

KINDS = ("SUBMITTED", "SUCCEEDED", "FAILED", "IN_PROGRESS")


def columns(job, order, status, at):
    ended = status in TERMINAL
    return job, at if status == "SUBMITTED" else None, at, ended, order if ended and order != NO_ORDER else None, status == "SUCCEEDED"


def test_all_jobs_at_once_are_as_one_by_one(spark):
    pick = random.Random(8)
    kept, jobs, ends = {}, spark.createDataFrame([], STATES), spark.createDataFrame([], ENDS)
    for now in (4 * SECOND, 9 * SECOND, 3 * DAY):
        events = [
            (f"j{pick.randrange(60)}", pick.choice([*range(9), NO_ORDER]), pick.choice(KINDS), pick.randrange(12) * SECOND) for _ in range(150)
        ]
        # equal places of a job are told apart by time only
        events = list({(job, order, at): (job, order, status, at) for job, order, status, at in events}.values())
        events += events[:5]
        for job, *event in events:
            kept.setdefault(job, Job()).take(*event)
        states, all_ends = job_state.advance(jobs, ends, spark.createDataFrame([columns(*e) for e in events], EVENTS), now, 4, 2)
        rows = states.collect()
        jobs = spark.createDataFrame(rows, STATES)
        useful = job_state.thin(all_ends, jobs).collect()
        ends = spark.createDataFrame(useful, ENDS)
        assert len(rows) == len(kept)
        for row in rows:
            job = kept[row["job"]]
            job.thin()
            outcome, lost = job.outcome(now, 4 * SECOND), job.lost(now, 2 * DAY)
            assert row["told"].asDict() == {"submitted": job.submitted, "seen": job.seen if lost else None, "outcome": outcome, "lost": lost}
            assert {(e["order"], -e["back"]) for e in useful if e["job"] == row["job"]} <= {e[:2] for e in job.ends}
    again, _ = job_state.advance(jobs, ends, spark.createDataFrame([], EVENTS), now, 4, 2)
    assert again.filter("changed").count() == 0


def test_states_are_worked_out_by_built_in_functions(spark):
    empty = [spark.createDataFrame([], schema) for schema in (STATES, ENDS, EVENTS)]
    for table in job_state.advance(*empty, 0, 1, 1):
        assert "Python" not in table._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("files", [1, 100])
def test_late_events_and_the_watermark(spark, tmp_path, files):
    source, path, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    for number, rows in enumerate(([("a", "SUBMITTED", "10:00"), ("b", "SUBMITTED", "10:00")], [("c", "SUBMITTED", "15:00")], [("c", "FAILED", "15:10")], [("a", "FAILED", "10:01"), ("b", "SUBMITTED", "9:00")])):
        rows = spark.createDataFrame([(number, job, status, f"2024-01-01 {t}") for job, status, t in rows], "id bigint, job_id string, status string, s string")
        rows.select("id", "job_id", "status", F.to_timestamp_ntz("s", F.lit("yyyy-MM-dd H:mm")).alias("created_at")).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema

    def run():
        return job_state.run_job_states(incremental.read_stream(spark, source, schema, maxFilesPerTrigger=files), path, state, 3600, 7, "90 minutes")

    assert run() == "2024-01-01T13:40:00.000Z" and run() is None
    found = {r["job_id"]: (str(r["submitted_at"])[11:16], r["outcome"]) for r in job_state.read_job_states(spark, path).collect()}
    # file by file the last one comes too late, in one batch nothing does
    assert found == {"a": ("10:00", "TIMEOUT" if files == 1 else "FAILED"), "b": ("10:00" if files == 1 else "09:00", "TIMEOUT"), "c": ("15:00", "FAILED")}
