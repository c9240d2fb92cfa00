"""Jobs that pick up what is new: resumable enrichment and export files.

Checkpoints and sinks lie in folders that all executors reach; the caller names them.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent

from paperlane.operators.joins import drop_known

REPORT_SECONDS = 120


def resume_append(
    spark: SparkSession, source: DataFrame, key: str, enrich: Callable[[DataFrame], DataFrame],
    path: str,
) -> DataFrame:
    """Enrich the rows whose key the output does not hold yet, append them, return the output.

    A run that was cut off is simply started again: the next run sees the keys that made it. Rows
    without a key could never be told from those already there; they are set aside.
    """
    done = _existing(spark, path)
    source = source.filter(F.col(key).isNotNull())
    pending = source if done is None else drop_known(source, done, [key])
    enrich(pending).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The output so far; None before the first run has written a file."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def stream_append(
    stream: DataFrame, enrich: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> None:
    """Enrich all files that arrived since the last run and append the rows; then stop.

    The checkpoint holds what was read, so a second run without new files adds nothing.
    """
    query = (
        enrich(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
    query.awaitTermination()


def read_stream(spark: SparkSession, path: str, schema, **options) -> DataFrame:
    """Stream of the parquet files of a table, which is a folder of files or one file.

    A plain path would have to be a folder, so its last letter becomes a pattern.
    """
    path = path.rstrip("/")
    return spark.readStream.schema(schema).options(**options).parquet(f"{path[:-1]}[{path[-1]}]")


def utc_instant(time: Column) -> Column:
    """A time without a zone, taken as UTC, as a point in time, whatever the zone of the session."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), time.cast("timestamp_ntz")).cast("timestamp")


def utc_clock(instant: Column) -> Column:
    """A point in time as a UTC time without a zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def unique_messages(stream: DataFrame, message_id: str, time: str, delay: str) -> DataFrame:
    """Messages whose id was not seen within the delay. Times without a zone are taken as UTC."""
    stamped = stream
    if isinstance(stream.schema[time].dataType, T.TimestampNTZType):
        stamped = stream.withColumn(time, utc_instant(F.col(time)))
    return stamped.withWatermark(time, delay).dropDuplicatesWithinWatermark([message_id])


def hourly_counts(messages: DataFrame, time: str) -> DataFrame:
    """Messages per hour (UTC, without a zone), with the time of the newest one."""
    counted = messages.groupBy(F.window(time, "1 hour")).agg(F.count("*").alias("n_messages"), F.max(time).alias("newest"))
    return counted.select(
        utc_clock(F.col("window.start")).alias("hour"), "n_messages", utc_clock(F.col("newest")).alias("newest")
    )


class _LateRows(StreamingQueryListener):
    """Adds up the rows that the batches of one query left out as too late, as each batch reports them.

    A query itself only remembers its last batches.
    """

    def __init__(self, name: str):
        self.name, self.run, self.late, self.ended = name, None, 0, threading.Event()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        if event.progress.runId == self.run:
            self.late += sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        if event.runId == self.run:
            self.ended.set()


def run_hourly_counts(
    stream: DataFrame, message_id: str, time: str, path: str, checkpoint: str, delay: str = "1 day"
) -> int:
    """Count the messages of all new files per hour of arrival; open hours are counted as well.

    Every batch writes the hours it has changed into its own folder, which it replaces if it has to
    run again. Returns the number of rows that came after the delay and were left out, in all batches of
    this run.
    """
    counts = hourly_counts(unique_messages(stream, message_id, time, delay), time)

    def write(hours: DataFrame, batch: int) -> None:
        hours.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    listener = _LateRows(f"hourly-{uuid.uuid4().hex}")
    streams = stream.sparkSession.streams
    streams.addListener(listener)
    try:
        query = (
            counts.writeStream.outputMode("update").foreachBatch(write).queryName(listener.name)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        # reports come in order and a little later than the batches; the end of the query is the last one
        if not listener.ended.wait(REPORT_SECONDS):
            raise TimeoutError("no report of the end of the query")
    finally:
        streams.removeListener(listener)
    return listener.late


def read_hourly_counts(spark: SparkSession, path: str, delay: str = "1 day") -> DataFrame:
    """Latest count of every hour, and whether it is closed: no message within the delay can change it."""
    hours = spark.read.parquet(path)
    latest = hours.groupBy("hour").agg(F.max_by("n_messages", "batch").alias("n_messages"))
    newest = hours.agg(F.max("newest")).scalar()
    end = F.col("hour") + F.expr("INTERVAL 1 HOUR")
    return latest.select("hour", "n_messages", (end <= newest - F.expr(f"INTERVAL {delay}")).alias("closed"))
