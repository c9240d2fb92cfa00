"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from paperlane.functions.numbers import round_even
from paperlane.session import tune


class Tables:
    """The parquet tables of one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(tune(spark), folder))


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        REGISTRY[name or build.__name__] = Query(build, sql)
        return build

    return register


def r6(column: Column | str) -> Column:
    """Six digits, half to even, as ``round_even(x, 6)`` in the SQL."""
    return round_even(column, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Round the named columns."""
    return df.withColumns({name: r6(name) for name in names})
