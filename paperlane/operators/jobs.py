"""Outcomes of OCR jobs, derived from a table of job events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TERMINAL = ("SUCCEEDED", "FAILED")


def job_outcomes(
    events: DataFrame, timeout_seconds: int, as_of: str, job: str = "job_id",
    status: str = "status", time: str = "created_at", order: str = "id",
) -> DataFrame:
    """One row per submitted job with its outcome.

    The first terminal state since the submission counts if it came within the timeout. Otherwise
    the job is TIMEOUT once the timeout has passed, and SUBMITTED before that.
    """
    state, stamp, rank = F.col(status), F.col(time), F.col(order)
    submitted = events.groupBy(job).agg(F.min(F.when(state == "SUBMITTED", stamp)).alias("submitted_at"))
    # both aggregates are partitioned by the job, so the join in between moves nothing again
    ends = events.filter(state.isin(*TERMINAL)).join(submitted.withColumnRenamed("submitted_at", "_from"), job)
    ended = ends.filter(stamp >= F.col("_from")).groupBy(job).agg(
        F.min_by(stamp, rank).alias("_ended_at"), F.min_by(state == "SUCCEEDED", rank).alias("_succeeded"),
    )
    per_job = submitted.filter("submitted_at IS NOT NULL").join(ended, job, "left")
    deadline = F.col("submitted_at") + F.expr(f"INTERVAL {int(timeout_seconds)} SECOND")
    in_time = F.coalesce(F.col("_ended_at") <= deadline, F.lit(False))
    ended = F.when(F.col("_succeeded"), "SUCCEEDED").otherwise("FAILED")
    late = F.lit(as_of).cast("timestamp_ntz") > deadline
    outcome = F.when(in_time, ended).when(late, "TIMEOUT").otherwise("SUBMITTED")
    return per_job.select(job, "submitted_at", outcome.alias("outcome"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Jobs per outcome in one row."""
    return outcomes.agg(
        F.count("*").alias("n_jobs"),
        *[
            F.count_if(F.col("outcome") == name).alias(f"n_{name.lower()}")
            for name in ("SUCCEEDED", "FAILED", "TIMEOUT", "SUBMITTED")
        ],
    )


def job_texts(outcomes: DataFrame, results: DataFrame, job: str = "job_id") -> DataFrame:
    """Text per job; a job that failed, timed out or left no result has the empty text."""
    done = outcomes.join(results.select(job, "text"), job, "left")
    text = F.when(F.col("outcome") == "SUCCEEDED", F.col("text"))
    return done.withColumn("text", F.coalesce(text, F.lit("")))


def lost_jobs(
    events: DataFrame, as_of: str, days: int = 7, job: str = "job_id", status: str = "status",
    time: str = "created_at",
) -> DataFrame:
    """Jobs older than the given number of days that never reached a terminal state."""
    per_job = events.groupBy(job).agg(
        F.min(time).alias("first_seen"), F.bool_or(F.col(status).isin(*TERMINAL)).alias("_ended")
    )
    age = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAY")
    return per_job.filter((F.col("first_seen") < age) & ~F.col("_ended")).select(job, "first_seen")
