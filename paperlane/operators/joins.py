"""Equi-joins of tickets, attachments, predictions and labels.

Sides are never forced to be broadcast: Spark checks their sizes, and adaptive execution splits the
partitions of a hot key. Where a join type cannot be split, the operator is built from ones that can.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ticket_chain(
    tickets: DataFrame, attachments: DataFrame, predictions: DataFrame, jobs: DataFrame,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Ticket, attachment, prediction and OCR job in one row; newest first.

    ``wanted`` is a table of ticket ids and replaces one query per id. The predictions, by far the
    largest side, are joined last and so shuffled once.
    """
    if wanted is not None:
        tickets = only_listed(tickets, wanted, ["ticket_uuid"])
    processed = attachments.join(jobs, "attachment_id").join(tickets, "ticket_uuid")
    return predictions.join(processed, "attachment_id").orderBy(
        F.desc("created_at"), "attachment_id", "prediction_id"
    )


def enrich(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str = "_right",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Left join that keeps every left row; clashing names of the right side get a suffix.

    A missing key matches nothing.
    """
    return _merge(left, right, keys, suffix, columns, "left")


def match(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str = "_right",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join with the right side cut to the columns asked for."""
    return _merge(left, right, keys, suffix, columns, "inner")


def _merge(left, right, keys, suffix, columns, how) -> DataFrame:
    keys = list(keys)
    wanted = [c for c in (columns or right.columns) if c not in keys]
    renamed = {c: f"{c}{suffix}" for c in wanted if c in left.columns}
    return left.join(right.select(*keys, *wanted).withColumnsRenamed(renamed), keys, how)


def _with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the key as one struct; NULL, which matches nothing, where a part is missing."""
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return df.withColumn("_key", F.when(known, F.struct(*keys)))


def _key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of a table.

    As a struct they no longer show the planner how they are partitioned. A join then shuffles both
    sides itself, and adaptive execution splits a hot key only in such shuffles.
    """
    return _with_key(df.select(*keys).na.drop().distinct(), keys).select("_key")


def outer_with_parents(children: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of children with parents that are unique by key.

    A full outer join cannot be split when one parent has very many children, so this is the left
    join plus the parents without a child.
    """
    with_parents = children.join(parents, list(keys), "left")
    childless = drop_known(parents, children, keys)
    return with_parents.unionByName(childless, allowMissingColumns=True)


def merge_daily(
    frames: Sequence[DataFrame], day: str = "day", how: str = "full", fill: bool = False
) -> DataFrame:
    """Join daily statistics on the day; optionally all missing numbers become 0."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.join(frame, day, how)
    return merged.na.fill(0) if fill else merged


def drop_known(new: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not known yet; a missing key is never known."""
    rows = _with_key(new, keys).join(_key_set(known, keys), "_key", "left_anti")
    return rows.select(*new.columns)


def only_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is listed."""
    rows = _with_key(df, keys).join(_key_set(listed, keys), "_key", "left_semi")
    return rows.select(*df.columns)


def drop_listed(df: DataFrame, lists: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows that are in none of the lists."""
    keys = list(keys)
    listed = lists[0].select(*keys)
    for other in lists[1:]:
        listed = listed.unionByName(other.select(*keys))
    return drop_known(df, listed, keys)


def flag_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Add a flag that tells whether the key is listed."""
    marks = _key_set(listed, keys).withColumn("_listed", F.lit(True))
    rows = _with_key(df, keys).join(marks, "_key", "left")
    return rows.select(*df.columns, F.coalesce("_listed", F.lit(False)).alias(flag))


def id_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids that only one of two sources has, with the side they come from.

    Both sources are counted together per id, which needs no join and one shuffle.
    """
    both = left.select(key, F.lit(True).alias("_left")).unionByName(
        right.select(key, F.lit(False).alias("_left"))
    )
    sides = both.groupBy(key).agg(
        F.bool_or("_left").alias("_in_left"), F.bool_or(~F.col("_left")).alias("_in_right")
    )
    side = F.when(F.col("_in_left"), "left_only").otherwise("right_only")
    return sides.filter(F.col("_in_left") != F.col("_in_right")).select(key, side.alias("side"))


def map_values(column: Column, mapping: Mapping[str, str]) -> Column:
    """New name of a value, or the value itself when the mapping does not know it."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), column) if pairs else column


def map_by_table(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """As ``map_values`` with a mapping table ``(old, new)``, unique by ``old``."""
    renamed = mapping.select(F.col("old").alias(column), F.col("new").alias("_new"))
    joined = df.join(renamed, column, "left")
    return joined.withColumn(column, F.coalesce("_new", column)).select(*df.columns)


def lookup_with_fallback(
    df: DataFrame, first: DataFrame, second: DataFrame, key: str, value: str, order: str
) -> DataFrame:
    """Value from the first source, else from the second, else NULL.

    A key may occur several times in the first source; its last row counts. The second source is
    unique by key.
    """
    latest = _with_key(
        first.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, order).alias("_first")),
        [key],
    ).select("_key", "_first", F.lit(True).alias("_in"))
    backup = second.select(key, F.col(value).alias("_second"))
    found = _with_key(df.join(backup, key, "left"), [key]).join(latest, "_key", "left")
    # a key the first source knows keeps that source's value, even a missing one
    chosen = F.when(F.col("_in"), F.col("_first")).otherwise(F.col("_second"))
    return found.select(*df.columns, chosen.alias(value))


def orphans(children: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows without a parent."""
    return drop_known(children, parents, keys)


def mismatches(df: DataFrame, found: str, truth: str) -> DataFrame:
    """Rows where two columns disagree; missing on both sides counts as equal."""
    return df.filter(~F.col(found).eqNullSafe(F.col(truth)))


def apply_corrections(
    df: DataFrame, corrections: DataFrame, key: str, label: str
) -> DataFrame:
    """Overwrite labels by key with the corrected ones."""
    fixed = corrections.select(key, F.col(label).alias("_fixed"))
    joined = df.join(fixed, key, "left")
    return joined.withColumn(label, F.coalesce("_fixed", label)).select(*df.columns)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all of tables whose columns may differ; what a table lacks is missing."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked
