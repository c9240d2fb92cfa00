"""Checks on tables before they are loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A table does not meet a requirement."""


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of missing values of each column, from one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def check_required(df: DataFrame, columns: Sequence[str]) -> None:
    """Fail when a required column lacks a value anywhere."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise QualityError(f"missing required columns: {absent}")
    counts = missing_counts(df, columns).first().asDict()
    empty = {name: n for name, n in counts.items() if n}
    if empty:
        raise QualityError(f"empty entry in required columns: {empty}")


def type_mismatches(existing: DataFrame, new: DataFrame) -> dict[str, dict[str, str]]:
    """Shared columns whose types differ; looks at the schemas only."""
    have = {field.name: field.dataType.simpleString() for field in existing.schema}
    want = {field.name: field.dataType.simpleString() for field in new.schema}
    return {
        name: {"existing": have[name], "new": want[name]}
        for name in want
        if name in have and have[name] != want[name]
    }


def type_report(existing: DataFrame, new: DataFrame) -> DataFrame:
    """One row per shared column of another type: name, both types, and the new values it concerns."""
    wrong = type_mismatches(existing, new)
    kinds = F.lit(None) if not wrong else F.create_map(*[F.lit(x) for n, w in wrong.items() for x in (n, f"{w['existing']}|{w['new']}")])
    counts = new.agg(F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in wrong])
    long = counts.unpivot(["_rows"], list(wrong) or ["_rows"], "name", "n_rows").filter(F.col("name").isin(*wrong) if wrong else F.lit(False))
    kind = kinds[F.col("name")] if wrong else F.lit("|")
    return long.select("name", F.substring_index(kind, "|", 1).alias("have"), F.substring_index(kind, "|", -1).alias("want"), "n_rows")


def check_types(existing: DataFrame, new: DataFrame) -> None:
    """Fail when a shared column has different types."""
    wrong = type_mismatches(existing, new)
    if wrong:
        raise QualityError(f"column types differ: {wrong}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def link_mismatches(df: DataFrame, stored: str, derived: Column) -> DataFrame:
    """Rows whose stored link is not the one that follows from the job id."""
    return df.filter(~F.col(stored).eqNullSafe(derived))


def check_links(df: DataFrame, stored: str, derived: Column) -> None:
    """Fail when a stored link is not the derived one."""
    wrong = link_mismatches(df, stored, derived).limit(1).count()
    if wrong:
        raise QualityError(f"{stored} does not follow from the job id")


def quality_report(
    df: DataFrame, required: Sequence[str], keys: Sequence[str], stored: str, derived: Column
) -> DataFrame:
    """One row per check with the number of offending rows."""
    measures = [
        *[(f"missing_{c}", F.count_if(F.col(c).isNull())) for c in required],
        (f"link_{stored}", F.count_if(~F.col(stored).eqNullSafe(derived))),
    ]
    flat = df.agg(*[measure.alias(name) for name, measure in measures])
    report = flat.unpivot([], [name for name, _ in measures], "check_name", "n_rows")
    repeated = duplicate_keys(df, keys).agg(
        F.lit(f"repeated_{'_'.join(keys)}").alias("check_name"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
    )
    return report.unionByName(repeated)
