"""Queries of the training-data operators, each with the SQL that checks it, if there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paperlane.llm.tasks import tune_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of session and folder under its own name."""

    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder; the session is set up for long texts."""
    tune_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
