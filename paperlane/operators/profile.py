"""Counts, shares, coverage and distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlane.operators.joins import flag_listed
from paperlane.operators.order import running_totals, value_cuts

QUARTILES = (0.25, 0.5, 0.75)


def value_counts(
    df: DataFrame, column: str, keep_missing: bool = False, shares: bool = False
) -> DataFrame:
    """Rows per value, most frequent first; with ``shares`` also the part of all counted rows."""
    rows = df if keep_missing else df.filter(F.col(column).isNotNull())
    counts = rows.groupBy(column).agg(F.count("*").alias("n_rows"))
    if shares:
        # the total of the counts, which Spark takes from the same shuffle
        counts = counts.withColumn("share", F.col("n_rows") / counts.agg(F.sum("n_rows")).scalar())
    return counts.orderBy(F.desc("n_rows"), column)


def distinct_counts(
    df: DataFrame, columns: Sequence[str], approximate: bool = False
) -> DataFrame:
    """One row with the number of distinct known values of each column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns])


def null_profile(df: DataFrame) -> DataFrame:
    """Missing and known values per column, from one pass over the table."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    long = counts.unpivot(["_rows"], list(df.columns), "column_name", "n_known")
    return long.select("column_name", (F.col("_rows") - F.col("n_known")).alias("n_missing"), "n_known")


def coverage(df: DataFrame, column: str) -> DataFrame:
    """First and last value of a time column."""
    return df.agg(F.min(column).alias("first_value"), F.max(column).alias("last_value"))


def text_coverage(df: DataFrame, text: str) -> DataFrame:
    """Rows, and rows that have a text."""
    return df.agg(F.count("*").alias("n_rows"), F.count(text).alias("n_with_text"))


def calendar_parts(column: Column) -> dict[str, Column]:
    """Day, hour and short weekday of a time."""
    return {
        "day": F.to_date(column),
        "hour": F.hour(column),
        "weekday": F.date_format(column, "E"),
    }


def hour_day_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per hour of the day and date, with the weekday; only pairs that occur."""
    parts = calendar_parts(F.col(column))
    keyed = df.select(parts["day"].alias("day"), parts["hour"].alias("hour"))
    counts = keyed.groupBy("day", "hour").agg(F.count("*").alias("n_rows"))
    return counts.withColumn("weekday", F.date_format("day", "E"))


def hour_day_matrix(
    df: DataFrame, column: str, days: Sequence[str] | None = None, others: str = "other_days"
) -> DataFrame:
    """One row per hour, one column per day (yyyy-MM-dd), 0 where there is no row.

    Without a list of days all that occur are found first. With one, the column ``others`` counts the
    rows of days that are not listed, so that none is lost unseen. Rows without a time belong nowhere.
    """
    keyed = df.select(
        F.date_format(column, "yyyy-MM-dd").alias("day"), F.hour(column).alias("hour")
    ).filter("day IS NOT NULL")
    if days is None:
        found = keyed.select("day").distinct().orderBy("day")
        days = [row["day"] for row in found.collect()]
        return keyed.groupBy("hour").pivot("day", days).count().na.fill(0)
    keyed = keyed.withColumn("day", F.when(F.col("day").isin(*days), F.col("day")).otherwise(others))
    return keyed.groupBy("hour").pivot("day", [*days, others]).count().na.fill(0)


def known_per_day(df: DataFrame, time: str, columns: Sequence[str]) -> DataFrame:
    """Known values of every column per day."""
    return df.groupBy(F.to_date(time).alias("day")).agg(*[F.count(c).alias(c) for c in columns])


def distinct_per_day(df: DataFrame, time: str, columns: dict[str, str]) -> DataFrame:
    """Distinct values per day; ``columns`` maps a column to the name of its count."""
    return df.groupBy(F.to_date(time).alias("day")).agg(
        *[F.count_distinct(F.col(c)).alias(name) for c, name in columns.items()]
    )


def status_distribution(df: DataFrame, status: str, total_name: str = "TOTAL") -> DataFrame:
    """Rows per status with their percentage, and a total row."""
    # rollup copies its input, so it gets the few counts and not the rows
    per_status = df.groupBy(status).agg(F.count("*").alias("_n"))
    counts = per_status.rollup(status).agg(
        F.sum("_n").alias("n_rows"), F.grouping(F.col(status)).alias("is_total")
    )
    name = F.when(F.col("is_total") == 1, F.lit(total_name)).otherwise(F.col(status))
    # a handful of rows: the statuses and their total
    total = F.max(F.when(F.col("is_total") == 1, F.col("n_rows"))).over(Window.partitionBy())
    return counts.select(
        name.alias(status), "n_rows",
        F.try_divide(F.lit(100.0) * F.col("n_rows"), total).alias("percent"),
    )


def describe(df: DataFrame, value: str, group: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of a number per group.

    Quartiles are exact and interpolate linearly. They are read off running counts over the
    distinct values, so that no task holds all values of a group. Rows without a group are left
    out.
    """
    known = df.select(group, value).filter(F.col(value).isNotNull() & ~F.isnan(value))
    ranked = running_totals(known, value, {"n": F.count("*")}, value_cuts(known, value), [group])

    def at(share: float) -> Column:
        return F.lit(share) * (F.col("n_all") - 1)

    picks = []
    for share in QUARTILES:
        name = f"q{int(share * 100)}"
        for edge, rank in (("low", F.floor(at(share))), ("high", F.ceil(at(share)))):
            picked = F.min(F.when(F.col("n_upto") > rank, F.col(value)))
            picks.append(picked.alias(f"_{edge}_{name}"))
    edges = ranked.groupBy(group, "n_all").agg(*picks)

    quartiles = []
    for share in QUARTILES:
        name = f"q{int(share * 100)}"
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        quartiles.append((low + (at(share) - F.floor(at(share))) * (high - low)).alias(name))

    # one row per group on both sides
    moments = known.groupBy(group).agg(
        F.count("*").alias("n_values"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"), F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
    )
    names = [f"q{int(share * 100)}" for share in QUARTILES]
    return moments.join(edges.select(group, *quartiles), group).select(
        group, "n_values", "mean", "std", "minimum", *names, "maximum"
    )


def describe_all(df: DataFrame, value: str) -> DataFrame:
    """Minimum, maximum and mean of a number."""
    return df.agg(
        F.min(value).alias("minimum"), F.max(value).alias("maximum"), F.avg(value).alias("mean")
    )


def describe_mixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known values, distinct values, most frequent value and its frequency per column.

    Columns are compared as text; the smallest value wins a tie.
    """
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], list(columns), "column_name", "item").filter("item IS NOT NULL")
    counts = long.groupBy("column_name", "item").agg(F.count("*").alias("n"))
    # least (-n, item) is the most frequent item, and the smallest one among equals
    best = F.min(F.struct((-F.col("n")).alias("negative"), F.col("item").alias("item")))
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("n_known"), F.count("*").alias("n_distinct"), best.alias("_best")
    ).select(
        "column_name", "n_known", "n_distinct", F.col("_best.item").alias("top_item"),
        (-F.col("_best.negative")).alias("top_count"),
    )


def histogram(
    df: DataFrame, value: str, low: float, high: float, bins: int, label: str | None = None
) -> DataFrame:
    """Rows per equal-width bin, optionally per label; the last bin is closed.

    Every bin is listed, with 0 if it is empty. Bin -1 has the values below the range, bin ``bins``
    those above it; missing values and NaN are in no bin.
    """
    known = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    inside = F.floor((F.col(value) - F.lit(low)) / F.lit(high - low) * F.lit(bins))
    position = F.when(F.col(value) < low, -1).when(F.col(value) > high, bins).otherwise(F.least(inside, F.lit(bins - 1)))
    keyed = known.withColumn("bin", position.cast("int"))
    every = F.sequence(F.lit(-1), F.lit(bins))
    if label is None:
        # one row with the counts of the bins that occur, opened to all bins
        counts = keyed.groupBy("bin").agg(F.count("*").alias("n"))
        found = counts.agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))
        rows = found.select("found", F.explode(every).alias("bin"))
        return rows.select("bin", F.coalesce(F.col("found")[F.col("bin")], F.lit(0)).alias("n_rows"))
    counts = keyed.groupBy(label, "bin").agg(F.count("*").alias("n"))
    found = counts.groupBy(label).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))
    rows = found.select(label, "found", F.explode(every).alias("bin"))
    return rows.select(label, "bin", F.coalesce(F.col("found")[F.col("bin")], F.lit(0)).alias("n_rows"))


def match_counts(df: DataFrame, found: Column) -> DataFrame:
    """Rows per number of matches; no match at all counts as 0."""
    n = F.coalesce(F.size(F.coalesce(found, F.expr("array()").cast("array<string>"))), F.lit(0))
    return df.select(n.alias("n_matches")).groupBy("n_matches").agg(F.count("*").alias("n_rows"))


def key_union(df: DataFrame, mapping: Column) -> DataFrame:
    """All keys that occur in a map column."""
    return df.select(F.explode(F.map_keys(mapping)).alias("key")).distinct()


def distinct_lengths(df: DataFrame, column: str) -> DataFrame:
    """Text lengths that occur."""
    return df.select(F.length(column).alias("length")).filter("length IS NOT NULL").distinct()


def export_totals(messages: DataFrame, message_id: str, attachments: str) -> DataFrame:
    """Messages and attachments of exports, repeated ones included, and the distinct messages."""
    return messages.agg(
        F.count("*").alias("n_messages"),
        F.count_distinct(message_id).alias("n_distinct_messages"),
        F.coalesce(F.sum(F.size(attachments)), F.lit(0)).alias("n_attachments"),
        F.count_if(F.size(attachments) == 0).alias("n_without_attachment"),
    )


def load_counters(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows offered for a load, those already known and those to be written."""
    # counted per key first: a hot key is one row in the join
    offered = new.groupBy(key).agg(F.count("*").alias("_n"))
    marked = flag_listed(offered, known, [key], "_known")
    return marked.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_total"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col("_n"))), F.lit(0)).alias("n_known"),
        F.coalesce(F.sum(F.when(~F.col("_known"), F.col("_n"))), F.lit(0)).alias("n_new"),
    )
