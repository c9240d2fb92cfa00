"""Job outcomes as events arrive: what each job is now, with timers for what does not arrive.

The state of a job is what decides its outcome, whatever events come later: when it was submitted, when it was
first seen, whether it ended, and those ends that may still count. Time is the watermark, so results
do not depend on when or in how many pieces the events are read.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperlane.operators.jobs import TERMINAL
from paperlane.streaming.incremental import utc_clock, utc_instant

TOLD = "struct<submitted: bigint, seen: bigint, outcome: string, lost: boolean>"
STATES = f"job string, submitted bigint, seen bigint, ended boolean, first struct<order: bigint, back: bigint, succeeded: boolean>, told {TOLD}, changed boolean"
ENDS = "job string, order bigint, back bigint, succeeded boolean"
EVENTS = "job string, submitted bigint, seen bigint, ended boolean, order bigint, succeeded boolean"
CLOCK = "watermark bigint, before bigint"
CHANGE = "job string, submitted bigint, seen bigint, outcome string, lost boolean"
DAY, SECOND, MILLI = 86_400_000_000, 1_000_000, 1000
NO_ORDER = (1 << 63) - 1


class Job:
    """The rules for the state of one job, event by event; times are microseconds. ``advance`` applies them to all jobs at once."""

    def __init__(self, kept: tuple | None = None):
        submitted, seen, ended, ids, stamps, succeeded, told = kept or (None, None, False, [], [], [], None)
        self.submitted, self.seen, self.ended, self.told = submitted, seen, ended, told
        self.ends = list(zip(ids, stamps, succeeded, strict=True))

    def kept(self) -> tuple:
        columns = [list(c) for c in zip(*self.ends, strict=True)] or [[], [], []]
        return self.submitted, self.seen, self.ended, *columns, self.told

    def take(self, order: int, status: str, at: int) -> None:
        """One more event, in any order."""
        self.seen = at if self.seen is None else min(self.seen, at)
        if status == "SUBMITTED":
            self.submitted = at if self.submitted is None else min(self.submitted, at)
        if status in TERMINAL:
            self.ended = True
            # an end without a place in the order is never the first one
            if order != NO_ORDER:
                self.ends.append((order, at, status == "SUCCEEDED"))

    def thin(self) -> None:
        """Forget ends that can never count: the first one by order since the submission does, and the submission
        can only turn out to be earlier, so an end behind another one in order that is as late is of no use."""
        useful, latest = [], None
        for order, at, good in sorted(self.ends, key=lambda e: (e[0], -e[1])):
            if latest is None or at > latest:
                useful.append((order, at, good))
                latest = at
        self.ends = useful

    def outcome(self, now: int, timeout: int) -> str | None:
        if self.submitted is None:
            return None
        first = next((e for e in self.ends if e[1] >= self.submitted), None)
        if first is not None and first[1] <= self.submitted + timeout:
            return "SUCCEEDED" if first[2] else "FAILED"
        return "TIMEOUT" if now > self.submitted + timeout else "SUBMITTED"

    def lost(self, now: int, age: int) -> bool:
        return not self.ended and self.seen < now - age

    def timers(self, now: int, timeout: int, age: int) -> list[int]:
        """Times at which something changes if no event comes."""
        due = []
        if self.outcome(now, timeout) == "SUBMITTED":
            due.append(self.submitted + timeout)
        if not self.ended and not self.lost(now, age):
            due.append(self.seen + age)
        return due


def as_events(stream: DataFrame, job: str, status: str, time: str, order: str) -> DataFrame:
    """What the state needs to know of each event: its job, its time, and the parts of a state it may change."""
    at, ended = F.unix_micros(utc_instant(F.col(time))), F.col(status).isin(*TERMINAL)
    # an end without a place in the order is never the first one
    place = F.when(ended & (F.col(order).cast("long") != NO_ORDER), F.col(order).cast("long"))
    return stream.filter(F.col(job).isNotNull() & F.col(status).isNotNull() & F.col(time).isNotNull()).select(
        F.col(job).cast("string").alias("job"), F.when(F.col(status) == "SUBMITTED", at).alias("submitted"), at.alias("seen"), ended.alias("ended"),
        place.alias("order"), (F.col(status) == "SUCCEEDED").alias("succeeded"),
    )


def advance(jobs: DataFrame, ends: DataFrame, events: DataFrame, now: int, timeout_seconds: int, days: int) -> tuple[DataFrame, DataFrame]:
    """The states after some more events, as of ``now``, and all ends that have been kept or come, in columns of ``ENDS``.

    The same rules as those of ``Job``, for all jobs at once. ``told`` is what there is to tell of a job, ``changed``
    whether that is new.
    """
    came = events.filter("order IS NOT NULL").select("job", "order", (-F.col("seen")).alias("back"), "succeeded")
    ends = ends.unionByName(came)
    parts = jobs.select("job", "submitted", "seen", "ended", "told").unionByName(
        events.select("job", "submitted", "seen", "ended", F.lit(None).cast(TOLD).alias("told"))
    )
    summed = parts.groupBy("job").agg(
        F.min("submitted").alias("submitted"), F.min("seen").alias("seen"), F.bool_or("ended").alias("ended"), F.max("told").alias("before"),
    )
    # of equal places the latest end comes first
    late = ends.join(summed.select("job", "submitted"), "job").filter(-F.col("back") >= F.col("submitted"))
    first = late.groupBy("job").agg(F.min(F.struct("order", "back", "succeeded")).alias("first"))
    due = F.col("submitted") + timeout_seconds * SECOND
    outcome = (
        F.when(F.col("submitted").isNull(), F.lit(None))
        .when(-F.col("first.back") <= due, F.when(F.col("first.succeeded"), "SUCCEEDED").otherwise("FAILED"))
        .when(F.lit(now) > due, "TIMEOUT").otherwise("SUBMITTED")
    )
    judged = summed.join(first, "job", "left").withColumn("outcome", outcome)
    judged = judged.withColumn("lost", ~F.col("ended") & (F.col("seen") < now - days * DAY))
    told = F.struct("submitted", F.when(F.col("lost"), F.col("seen")).alias("seen"), "outcome", "lost")
    states = judged.select("job", "submitted", "seen", "ended", "first", told.alias("told"), (~told.eqNullSafe(F.col("before"))).alias("changed"))
    return states, ends


def thin(ends: DataFrame, states: DataFrame) -> DataFrame:
    """Ends that may still count: the first one by order since the submission does, and the submission can only turn
    out to be earlier. So none behind that end is of use, nor one behind another one that is as late."""
    known = ends.join(states.filter("first IS NOT NULL").select("job", "first"), "job", "left")
    useful = known.filter(F.col("first").isNull() | (F.struct("order", "back") <= F.struct("first.order", "first.back")))
    before = Window.partitionBy("job").orderBy("order", "back", "succeeded").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.min("back").over(before)
    return useful.withColumn("latest", latest).filter(F.col("latest").isNull() | (F.col("back") < F.col("latest"))).select("job", "order", "back", "succeeded")


def run_job_states(
    stream: DataFrame, path: str, checkpoint: str, timeout_seconds: int, days: int = 7, delay: str = "1 hour",
    job: str = "job_id", status: str = "status", time: str = "created_at", order: str = "id",
) -> str | None:
    """Follow all jobs through the events that arrived since the last run; then stop.

    Events later than ``delay`` behind the newest one are left out. Times without a zone are taken as UTC.
    Each batch writes the changes it has made into a folder of its own, which it replaces if it has to
    run again. The states lie next to the checkpoint, as of the last two batches, so that a batch that runs again finds
    what it started from. A job's state stays, as an event may come after any time; it is about a hundred bytes.
    Returns the watermark, up to which timers have run; None if there was nothing to do.
    """
    spark, root, done = stream.sparkSession, f"{checkpoint}/job-states", []
    wait = F.expr(f"unix_micros(timestamp'1970-02-01 00:00:00Z') - unix_micros(timestamp'1970-02-01 00:00:00Z' - INTERVAL {delay})")
    wait = spark.range(1).select(wait).first()[0] // MILLI

    def stored(name: str, schema: str, batch: int) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{root}/{name}/{batch % 2}") if batch >= 0 else spark.createDataFrame([], schema)

    def store(rows: DataFrame, name: str, schema: str, batch: int) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{root}/{name}/{batch % 2}")
        return stored(name, schema, batch)

    def write(rows: DataFrame, batch: int) -> None:
        clock = stored("clock", CLOCK, batch - 1).first()
        watermark, late = (clock["watermark"], clock["before"] if done else clock["watermark"]) if clock else (0, 0)
        came = store(rows, "events", EVENTS, batch)
        newest = came.agg(F.max("seen")).first()[0]
        now = max(watermark, newest // MILLI - wait) if newest is not None else watermark
        # as any operator with a watermark, a batch leaves out what the batch before it made late
        events = came.filter(F.col("seen") > late * MILLI)
        states, ends = advance(stored("jobs", STATES, batch - 1), stored("ends", ENDS, batch - 1), events, now * MILLI, timeout_seconds, days)
        states = store(states, "jobs", STATES, batch)
        store(thin(ends, states), "ends", ENDS, batch)
        states.filter("changed").select("job", "told.*").write.mode("overwrite").parquet(f"{path}/batch={batch}")
        store(spark.range(1).select(F.lit(now).cast("long").alias("watermark"), F.lit(watermark).cast("long").alias("before")), "clock", CLOCK, batch)
        done.append(now)

    query = (
        as_events(stream, job, status, time, order).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if not done:
        return None
    return datetime.fromtimestamp(done[-1] / 1000, UTC).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def read_job_states(spark: SparkSession, path: str) -> DataFrame:
    """``job_id``, ``submitted_at``, ``outcome``, ``lost`` and, if it is lost, ``first_seen`` of each job, as of the last batch."""
    changes = spark.read.schema(f"{CHANGE}, batch bigint").parquet(path)
    last = changes.groupBy("job").agg(F.max_by(F.struct("submitted", "seen", "outcome", "lost"), "batch").alias("last"))
    return last.select(
        F.col("job").alias("job_id"), utc_clock(F.timestamp_micros("last.submitted")).alias("submitted_at"), "last.outcome",
        utc_clock(F.timestamp_micros("last.seen")).alias("first_seen"), "last.lost",
    )
