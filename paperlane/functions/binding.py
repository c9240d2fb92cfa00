"""Evaluate a costly expression once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def evaluate_once(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression that uses a costly value several times but computes it once.

    Inside a condition or a coalesce Spark does not share repeated parts of an expression.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
