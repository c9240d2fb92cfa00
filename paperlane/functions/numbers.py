"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column | str, digits: int = 0) -> Column:
    """Round half to even the way array libraries do: scale, round to an integer, scale back.

    Spark's ``bround`` works on the shortest decimal form, which turns values next to a tie into
    ties.
    """
    column = F.col(value) if isinstance(value, str) else value
    scale = 10.0 ** digits
    return F.rint(column * scale) / scale if digits else F.rint(column)
