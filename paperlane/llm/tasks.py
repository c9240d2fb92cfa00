"""Text work in Python tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_CHARS = 1 << 20
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def slices(texts: Iterable[str | None], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Consecutive texts in groups of a bounded size; a missing text is empty."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def columns_besides(df: DataFrame, added: Iterable[str], keep: Sequence[str] | None) -> list[str]:
    """Columns that stay: those asked for, or all, without those that are added (in any case of letters)."""
    names = {x.lower() for x in added}
    return [c for c in (df.columns if keep is None else keep) if c.lower() not in names]


def schema_with(df: DataFrame, added: dict[str, str]) -> T.StructType:
    """Schema of a table with added columns at its end."""
    fields = (T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in added.items())
    return T.StructType([*df.schema.fields, *fields])


def tune_batches(spark: SparkSession) -> SparkSession:
    """Batches of fewer rows for Python tasks, as texts are long; a smaller setting stays."""
    before = int(spark.conf.get(BATCH_SETTING))
    if not 0 < before <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return spark


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The files of shuffles are removed as soon as the query they belong to has ended."""
    before = spark.conf.get(CLEANUP_SETTING)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_SETTING, before)


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for the jobs run inside."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def map_texts(
    df: DataFrame, text: str, added: dict[str, str], start: Callable[[], Callable[[list[str]], Sequence[Sequence]]],
    keep: Sequence[str] | None = None, stop: Callable[[], None] | None = None,
) -> DataFrame:
    """Add columns made from a text column, row by row, without a shuffle.

    ``start`` runs once per task and gives the function from a group of texts to the values of each
    added column; ``stop`` runs when the task ends. ``keep`` names the columns that stay (all by
    default); added columns replace those of the same name.
    """
    kept = columns_besides(df, added, keep)
    schema = schema_with(df.select(*kept), added)
    types = [f.dataType for f in schema.fields[len(kept) :]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        work, arrow = start(), [to_arrow_type(t) for t in types]
        try:
            for batch in batches:
                at = 0
                for group in slices(x.as_py() for x in batch.column(batch.num_columns - 1)):
                    values = [pa.array(v, t) for v, t in zip(work(group), arrow, strict=True)]
                    part = batch.slice(at, len(group))
                    at += len(group)
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], *values], names=[*kept, *added])
        finally:
            if stop is not None:
                stop()

    return df.select(*kept, F.col(text).alias("_text_")).mapInArrow(run, schema)
