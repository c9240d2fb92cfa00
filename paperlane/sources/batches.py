"""Tables that grow by whole batches: a batch is there with all its tables and rows, or not at all.

Below a root folder each table has a folder of data folders, one per attempt to write a batch. What counts
is a log of commits next to them: one small file per batch, written after all its data, that names the
data folders. Readers take only the folders that the log names, so they never see the rows of a run that
was cut off or is still writing; a batch that is in the log is not written again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "commits"
COMMIT = "batch string, attempt string, tables array<string>, merged array<string>"


def commits(spark: SparkSession, root: str) -> DataFrame:
    """Committed batches: ``batch``, the ``attempt`` that counts, the ``tables`` it wrote and the batches it
    holds ``merged``.

    If two runs wrote the same batch at the same time, both have its rows; the first attempt by name counts.
    """
    try:
        log = spark.read.schema(COMMIT).json(f"{root}/{LOG}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], COMMIT)
    first = F.min_by(F.struct("attempt", "tables", "merged"), "attempt").alias("_first")
    return log.groupBy("batch").agg(first).select("batch", "_first.attempt", "_first.tables", "_first.merged")


def live(spark: SparkSession, root: str) -> DataFrame:
    """Committed batches whose rows have not been merged into another one."""
    all_ = commits(spark, root)
    merged = all_.select(F.explode("merged").alias("batch"))
    return all_.join(merged, "batch", "left_anti")


def append_batch(spark: SparkSession, rows: Mapping[str, DataFrame], root: str, batch: str) -> bool:
    """Add the rows of a batch to all the tables at once; False if the batch is there already.

    A run that was cut off is started again under the same name: what it left is not in the log. The
    commit is a file that Spark puts in place when it is complete, so it is there whole or not at all.
    """
    if commits(spark, root).filter(F.col("batch") == batch).limit(1).count():
        return False
    attempt = uuid.uuid4().hex
    for name, table in rows.items():
        write_attempt(table, root, name, attempt)
    commit_attempt(spark, root, batch, attempt, list(rows))
    return True


def write_attempt(table: DataFrame, root: str, name: str, attempt: str) -> None:
    """Write the rows of one table; nobody sees them yet."""
    if name == LOG:
        raise ValueError(f"a table cannot be called {LOG}")
    table.write.parquet(f"{root}/{name}/{attempt}")


def commit_attempt(
    spark: SparkSession, root: str, batch: str, attempt: str, names: Sequence[str], merged: Sequence[str] = ()
) -> None:
    """Make an attempt count, in place of the batches it holds merged."""
    entry = spark.range(1).select(
        F.lit(batch).alias("batch"), F.lit(attempt).alias("attempt"),
        *(F.array(*map(F.lit, x)).cast("array<string>").alias(c) for c, x in (("tables", names), ("merged", merged))),
    )
    entry.coalesce(1).write.mode("append").json(f"{root}/{LOG}")


def read_committed(spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All rows of a table in committed batches, as they are now; the folders are listed once.

    What passes through the driver is the name of one folder per batch. Without any batch the schema
    has to be given.
    """
    wanted = live(spark, root).filter(F.array_contains("tables", name)).select("attempt")
    paths = [f"{root}/{name}/{row['attempt']}" for row in wanted.collect()]
    if not paths:
        if schema is None:
            raise ValueError(f"no batch holds {name}")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*sorted(paths))



def merge_batches(spark: SparkSession, root: str, merge: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None) -> str | None:
    """Put the rows of all batches into one, so that readers open few files; its name, or None if there is
    nothing to merge.

    ``merge`` may combine the rows of a table, such as partial sums; other tables keep their rows. Batches
    stay known, and count as merged once the new one is committed, so readers see the same rows before and after.
    Only one run may merge at a time; appending may go on meanwhile.
    """
    found = live(spark, root).orderBy("batch").collect()
    if len(found) < 2:
        return None
    attempt = uuid.uuid4().hex
    names = sorted({name for row in found for name in row["tables"]})
    for name in names:
        paths = sorted(f"{root}/{name}/{row['attempt']}" for row in found if name in row["tables"])
        rows = spark.read.parquet(*paths)
        write_attempt((merge or {}).get(name, lambda df: df)(rows), root, name, attempt)
    commit_attempt(spark, root, f"merged-{attempt}", attempt, names, [row["batch"] for row in found])
    return f"merged-{attempt}"
