"""Export files as they appear: messages with the time that their folder names, and gaps in the schedule."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperlane.functions.keys import export_key_time
from paperlane.sources.documents import EXPORT_SCHEMA
from paperlane.streaming.incremental import utc_clock, utc_instant

MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
LAYOUT = "*/*"  # a folder per day, and one per time of day in it


def without_names(path: Column) -> Column:
    """A path whose folders are called ``name=value``, with the values alone."""
    return F.regexp_replace(path, "/[^/=]+=", "/")


def read_export_stream(
    spark: SparkSession, base: str, key: Callable[[Column], Column] = lambda path: path, **options
) -> DataFrame:
    """Stream of the messages of all export files below a folder, with ``feed`` and ``exported_at``.

    New day and time folders are picked up as they appear. The time is read from the path, which ``key`` may
    first turn into an export key; the folder above those of the time names the feed. A file under a path
    that names no time gives rows without one. ``base`` may be a pattern for several feeds.
    """
    reader = spark.readStream.schema(EXPORT_SCHEMA).option("multiLine", True).options(**options)
    rows = reader.json(f"{base.rstrip('/')}/{LAYOUT}")
    path = key(F.col("_metadata.file_path"))
    feed = F.regexp_extract(path, "([^/]*)/[^/]*/[^/]*/[^/]*$", 1)
    return rows.withColumns({"feed": feed, "exported_at": utc_instant(export_key_time(path))})


def run_export_sessions(messages: DataFrame, path: str, checkpoint: str, every: str, delay: str) -> None:
    """Follow the schedule through all files that arrived since the last run; then stop.

    Exports of a feed that follow each other within ``every`` form one session. A session is written once it
    is complete, which is when the newest export is later than its end by ``delay``. Messages become
    sessions in the task that reads them, so a feed with most of the messages is few rows when it is dealt.
    """
    spark = messages.sparkSession
    before = spark.conf.get(MERGE_FIRST)
    timed = messages.filter("exported_at IS NOT NULL").withWatermark("exported_at", delay)
    sessions = timed.groupBy("feed", F.session_window("exported_at", every)).agg(
        F.count("*").alias("n_messages"), F.max("exported_at").alias("last_export"),
    )
    found = sessions.select(
        "feed", utc_clock(F.col("session_window.start")).alias("first_export"), utc_clock(F.col("last_export")).alias("last_export"), "n_messages",
    )
    spark.conf.set(MERGE_FIRST, "true")
    try:
        query = (
            found.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
        )
    finally:
        # the stream has its own copy of the settings
        spark.conf.set(MERGE_FIRST, before)
    query.awaitTermination()


def schedule_gaps(spark: SparkSession, path: str) -> DataFrame:
    """Times without an export between two complete sessions of a feed: the ``last_export`` before, the
    ``next_export`` after, and the messages of the session that follows.

    A feed has one session more than it has gaps, whatever the number of messages.
    """
    sessions = spark.read.parquet(path)
    before = F.lag("last_export").over(Window.partitionBy("feed").orderBy("first_export"))
    gaps = sessions.select("feed", before.alias("last_export"), F.col("first_export").alias("next_export"), "n_messages")
    return gaps.filter("last_export IS NOT NULL")
