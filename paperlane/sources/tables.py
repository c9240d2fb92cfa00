"""Tables: CSV, parquet, SQL and JDBC."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_corpus(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV corpus whose texts hold line breaks and doubled quotes.

    One task reads a file; ``records.read_split_corpus`` gives a large file to many. Convert it to parquet once
    and read that from then on.
    """
    reader = spark.read.schema(schema).option("header", True)
    return reader.option("multiLine", True).option("escape", '"').csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table."""
    return spark.read.parquet(path)


def read_many(spark: SparkSession, pattern: str, file_format: str = "parquet", **options) -> DataFrame:
    """All chunk files of a pattern or folder as one table."""
    return spark.read.options(**options).load(pattern, format=file_format)


def read_sql(
    spark: SparkSession, query: str, args: Mapping | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Result of a query; values travel as named arguments, never as pasted text."""
    for name, view in (views or {}).items():
        view.createOrReplaceTempView(name)
    try:
        # the plan is resolved here, so the views are not needed any longer
        return spark.sql(query, args=dict(args or {}))
    finally:
        for name in views or {}:
            spark.catalog.dropTempView(name)


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: int | str, upper: int | str,
    partitions: int, **options,
) -> DataFrame:
    """Database table read by several connections, split on a numeric or time column."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, **options,
    ).load()


def write_table(
    df: DataFrame, path: str, file_format: str = "parquet", replaces: Sequence[str] | None = None, **options
) -> None:
    """Write a table to a folder of its own.

    An existing folder is left alone, with an error, unless ``replaces`` names the tables that the
    rows come from: then the folder is replaced, if none of them lies in it or around it. A table must
    not replace its own input, which would be deleted before it is read.
    """
    target = location(path)
    for source in replaces or ():
        at = location(source)
        if at == target or at.startswith(f"{target}/") or target.startswith(f"{at}/"):
            raise ValueError(f"{path} is an input of the table to be written")
    mode = "errorifexists" if replaces is None else "overwrite"
    df.write.mode(mode).options(**options).save(path.rstrip("/"), format=file_format)


def location(path: str) -> str:
    """A path in full, with its scheme: relative paths start from the working folder."""
    scheme, mark, rest = path.partition("://")
    if mark:
        return f"{scheme}://{os.path.normpath(rest)}"
    return "file://" + os.path.abspath(path.removeprefix("file:"))


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a parquet table in one job."""
    df.write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """Add rows to a database table, many per statement."""
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, **options).save()
