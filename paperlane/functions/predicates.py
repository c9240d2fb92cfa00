"""Row predicates with the null rules spelled out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differs(column: Column, value) -> Column:
    """Inequality that keeps rows whose value is missing."""
    return ~column.eqNullSafe(F.lit(value) if not isinstance(value, Column) else value)


def half_open(column: Column, low, high) -> Column:
    """``low <= x < high``."""
    return (column >= low) & (column < high)


def strictly_between(column: Column, low, high) -> Column:
    """``low < x < high``, both ends excluded."""
    return (column > low) & (column < high)


def lookback(column: Column, as_of: str, days: int, include_today: bool = False) -> Column:
    """The ``days`` whole days before ``as_of``, and that day too if asked for."""
    today = F.lit(as_of).cast("date")
    start = F.date_sub(today, days).cast("timestamp_ntz")
    end = F.date_add(today, 1 if include_today else 0).cast("timestamp_ntz")
    return half_open(column, start, end)


def id_family(column: Column, mark: str = "-") -> Column:
    """True where the id contains the mark that separates two id families."""
    return column.contains(mark)


def is_blank(column: Column) -> Column:
    """The empty string; a missing value is a different case and gives NULL."""
    return column == ""


def is_present(column: Column) -> Column:
    """Neither missing nor empty; never NULL."""
    return column.isNotNull() & (column != "")


def all_present(columns: Sequence[Column]) -> Column:
    """Every parameter is there. A missing value counts as absent."""
    result = F.lit(True)
    for column in columns:
        result = result & is_present(column)
    return result


def equals_quoted(column: Column, word: str) -> Column:
    """Case-insensitive match of a word stored with single quotes around it."""
    return F.lower(column) == f"'{word.lower()}'"


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Those of the wanted columns that the table has, in the wanted order."""
    return df.select(*[name for name in names if name in df.columns])


def keys_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reorder so that the key columns lead."""
    return df.select(*keys, *[name for name in df.columns if name not in keys])
