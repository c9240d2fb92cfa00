"""Numbers for the rows of a sorted table, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlane.session import materialize

PLACE_BITS = 33  # of a number that Spark gives to the rows of a partition


def numbered(df: DataFrame, order: Sequence[Column], number: str, label: str) -> DataFrame:
    """Number all rows from 0 in an order. Rows that are equal in the order may come either way.

    Ranges of the order are dealt to tasks, so equal keys do not gather unless whole rows are equal
    in the order. What is added up in one place is one count per partition. The numbered table is
    written once, so that all who read it see the same numbers.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(dealt.withColumn("_place", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("_part", F.shiftright("_place", PLACE_BITS))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition of a table: always few
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.join(F.broadcast(counts), "_part").withColumn(number, F.col("_before") + inside).drop("_part", "_place", "_before")
