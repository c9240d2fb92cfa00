"""Attribute/value predictions: decisions, daily rates, pivots and score bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlane.functions.numbers import round_even
from paperlane.functions.parse import mentions_true, quoted_double, quoted_true
from paperlane.functions.predicates import is_present
from paperlane.operators.order import first_value, keep_first

# Score bands; the last one includes its upper end.
BANDS = (
    ("0.5-0.6", 0.5, 0.6), ("0.6-0.7", 0.6, 0.7), ("0.7-0.8", 0.7, 0.8),
    ("0.8-0.9", 0.8, 0.9), ("0.9-1.0", 0.9, 1.0),
)


@dataclass(frozen=True)
class PredictionNames:
    """Which rows of the attribute/value table mean what."""

    entity: str = "attachment_id"
    ticket: str = "ticket_uuid"
    order: str = "id"
    created_at: str = "created_at"
    type: str = "type"
    subtype: str = "subtype"
    value: str = "value"
    flag: str = "is_positive"
    probability: str = "class_prob"
    class_flag: str = "class_pred"
    classifier: str = "classifier"
    parameters: Sequence[str] = field(default=("case_id", "name", "due_date"))


def decisions(
    predictions: DataFrame, names: PredictionNames = PredictionNames(), threshold: float = 0.95,
    flag_only: bool = False,
) -> DataFrame:
    """One row per attachment: positive, complete, automatic.

    The first flag row decides if there is one: positive iff its value mentions True. Otherwise the
    first probability of the classifier decides; unreadable or absent means negative. A positive
    attachment is complete if the first value of every parameter is there. With ``flag_only`` an
    attachment without a flag row is undecided (NULL).

    Rows of one attachment are combined before the shuffle. Values are reduced to flags and numbers
    first, so with a numeric order column Spark aggregates by hash, without sorting; the ticket, which
    may be a text, is taken from the first row by a limit per attachment.
    """
    subtype, value, order = F.col(names.subtype), F.col(names.value), F.col(names.order)
    is_flag = subtype == names.flag
    is_probability = (subtype == names.probability) & (F.col(names.type) == names.classifier)
    facts = predictions.groupBy(names.entity).agg(
        F.min_by(F.to_date(names.created_at), order).alias("day"),
        F.coalesce(F.bool_or(is_flag), F.lit(False)).alias("_has_flag"),
        first_value(mentions_true(value), is_flag, order).alias("_flag"),
        first_value(quoted_double(value), is_probability, order).alias("_probability"),
        *[
            first_value(is_present(value), subtype == parameter, order).alias(f"_has_{parameter}")
            for parameter in names.parameters
        ],
    )
    known_order = predictions.filter(order.isNotNull())
    tickets = keep_first(known_order, [names.entity], [order]).select(
        F.col(names.entity).alias("_entity"), F.col(names.ticket).alias("ticket_uuid")
    )
    facts = facts.join(tickets, F.col(names.entity).eqNullSafe(F.col("_entity")), "left")
    by_flag = F.coalesce("_flag", F.lit(False))
    by_probability = F.coalesce(F.col("_probability") >= threshold, F.lit(False))
    otherwise = F.lit(None).cast("boolean") if flag_only else by_probability
    positive = F.when(F.col("_has_flag"), by_flag).otherwise(otherwise)
    complete = F.coalesce("is_positive", F.lit(False))
    for parameter in names.parameters:
        complete = complete & F.coalesce(f"_has_{parameter}", F.lit(False))
    return (
        facts.withColumn("is_positive", positive)
        .withColumn("is_complete", complete)
        .withColumn("is_automatic", F.coalesce("is_positive", F.lit(False)) & F.col("is_complete"))
        .select(names.entity, "ticket_uuid", "day", "is_positive", "is_complete", "is_automatic")
    )


def undecided(decided: DataFrame) -> DataFrame:
    """Quality count of attachments without a decision."""
    return decided.agg(
        F.count("*").alias("n_attachments"),
        F.count_if(F.col("is_positive").isNull()).alias("n_undecided"),
    )


def daily_rate(decided: DataFrame, incoming: DataFrame | None = None) -> DataFrame:
    """Automatic attachments per day and their percentage of the incoming ones.

    ``incoming`` (day, incoming) may come from another table; then days of either side appear and a
    day without incoming attachments has no rate. By default it is the number of decisions.
    """
    automatic = F.count_if("is_automatic").alias("automized")
    if incoming is None:
        daily = decided.groupBy("day").agg(F.count("*").alias("incoming"), automatic)
    else:
        daily = incoming.join(decided.groupBy("day").agg(automatic), "day", "full")
    rate = F.try_divide(F.lit(100.0) * F.col("automized"), F.col("incoming"))
    return daily.select("day", "incoming", "automized", rate.alias("automation_perc"))


def rate_summary(daily: DataFrame) -> DataFrame:
    """Totals, overall rate and the spread of the daily rates, in one row."""
    overall = F.try_divide(F.lit(100.0) * F.sum("automized"), F.sum("incoming"))
    return daily.agg(
        F.sum("incoming").alias("total_incoming"), F.sum("automized").alias("total_automized"),
        overall.alias("overall_perc"), F.avg("automation_perc").alias("mean_perc"),
        F.min("automation_perc").alias("min_perc"), F.max("automation_perc").alias("max_perc"),
        F.stddev_samp("automation_perc").alias("std_perc"), F.count("*").alias("n_days"),
    )


def daily_volume(decided: DataFrame) -> DataFrame:
    """Positive, automatic and negative attachments and automatic tickets per day.

    ``decided`` has one row per attachment, so rows count attachments. A ticket is automatic if at
    least one of its attachments is complete.
    """
    complete = F.col("is_complete")
    # tickets first, so that each is one row when the days are counted
    tickets = decided.groupBy("day", "ticket_uuid").agg(
        F.count_if("is_positive").alias("n_positive"),
        F.count_if(F.col("is_positive") & complete).alias("n_automatic"),
        F.count_if(~F.col("is_positive")).alias("n_negative"),
        F.count("*").alias("n_attachments"), F.coalesce(F.bool_or(complete), F.lit(False)).alias("_complete"),
    )
    known = F.col("ticket_uuid").isNotNull()
    daily = tickets.groupBy("day").agg(
        *[F.sum(n).alias(n) for n in ("n_positive", "n_automatic", "n_negative", "n_attachments")],
        F.count_if(known & F.col("_complete")).alias("n_automatic_tickets"), F.count_if(known).alias("n_tickets"),
    )
    share = F.try_divide(F.lit(100.0) * F.col("n_automatic_tickets"), F.col("n_tickets"))
    return daily.withColumn("ticket_automation_perc", share)


def pivot_first(
    predictions: DataFrame, subtypes: Sequence[str], names: PredictionNames = PredictionNames()
) -> DataFrame:
    """One row per attachment with the first known value of each listed subtype."""
    subtype = F.col(names.subtype)
    wide = _first_values(predictions.filter(subtype.isin(*subtypes)), subtype, names)
    return wide.select(names.entity, *[F.col("_values")[wanted].alias(wanted) for wanted in subtypes])


def _first_values(rows: DataFrame, name: Column, names: PredictionNames) -> DataFrame:
    """One row per attachment with a map from a name to its first known value.

    The first rows are cut out per name before they travel, and texts are gathered by hash.
    """
    named = rows.select(names.entity, name.alias("_name"), F.col(names.value).alias("_value"), F.col(names.order).alias("_order"))
    known = F.col("_value").isNotNull() & F.col("_name").isNotNull()
    # a row of its own keeps attachments without any value
    kept = named.select(names.entity, F.when(known, F.col("_name")).alias("_name"), "_value", "_order")
    first = keep_first(kept, [names.entity, "_name"], ["_order"])
    pair = F.when(F.col("_name").isNotNull(), F.struct("_name", "_value"))
    return first.groupBy(names.entity).agg(F.map_from_entries(F.collect_list(pair)).alias("_values"))


def pair_name(names: PredictionNames = PredictionNames()) -> Column:
    """``type__subtype``; a missing subtype gives ``type__``, a missing type no name."""
    return F.concat(F.col(names.type), F.lit("__"), F.coalesce(names.subtype, F.lit("")))


def found_pairs(predictions: DataFrame, names: PredictionNames = PredictionNames()) -> list[str]:
    """Every pair of type and subtype that occurs, in order; they become columns, so they are few."""
    rows = predictions.select(pair_name(names).alias("pair")).filter("pair IS NOT NULL").distinct()
    return [row["pair"] for row in rows.orderBy("pair").collect()]


def flatten(
    predictions: DataFrame, metadata: Sequence[str], names: PredictionNames = PredictionNames(),
    pairs: Sequence[str] | None = None, others: str = "n_other_pairs",
) -> DataFrame:
    """One row per attachment: metadata of its first row and one column per ``type__subtype``.

    Without a list of pairs all that occur are found first. With one, the column ``others`` counts the
    known pairs of an attachment that are not listed. A missing subtype gives the pair ``type__``; rows
    without a type belong to no pair.
    """
    listed = found_pairs(predictions, names) if pairs is None else pairs
    first = keep_first(predictions, [names.entity], [F.col(names.order)]).select(
        F.col(names.entity).alias("_entity"), *metadata
    )
    values = _first_values(predictions, pair_name(names), names)
    wide = values.join(first, F.col(names.entity).eqNullSafe(F.col("_entity")))
    columns = [F.col("_values")[p].alias(p) for p in listed]
    if pairs is not None:
        unlisted = F.array_except(F.map_keys("_values"), F.array(*map(F.lit, pairs)).cast("array<string>"))
        columns.append(F.size(unlisted).cast("long").alias(others))
    return wide.select(names.entity, *metadata, *columns)


def class_summary(
    predictions: DataFrame, classes: Mapping[str, str], names: PredictionNames = PredictionNames()
) -> DataFrame:
    """Winning class and class probabilities per attachment.

    ``classes`` maps a class to the type that holds its probability, in the order of testing. The
    winner is the class whose name occurs in the type of the first class row that is exactly true;
    NULL if there is none. A missing probability stays NULL.
    """
    subtype, value, order = F.col(names.subtype), F.col(names.value), F.col(names.order)
    is_true = (subtype == names.class_flag) & quoted_true(value)
    is_probability = subtype == names.probability
    # the position of the class has a fixed width, its name has not
    position = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(classes))):
        position = F.when(F.col(names.type).contains(name), F.lit(i)).otherwise(position)
    summary = predictions.groupBy(names.entity).agg(
        first_value(position, is_true, order).alias("_position"),
        *[
            first_value(quoted_double(value), is_probability & (F.col(names.type) == kind), order)
            .alias(f"prob_{name}")
            for name, kind in classes.items()
        ],
    )
    winner = F.get(F.array(*[F.lit(name) for name in classes]), F.col("_position"))
    return summary.withColumn("_position", winner).withColumnRenamed("_position", "winner")


def _in_band(score: Column, band: tuple[str, float, float]) -> Column:
    _, low, high = band
    last = band == BANDS[-1]
    return (score >= low) & ((score <= high) if last else (score < high))


def band_counts(df: DataFrame, score: str) -> DataFrame:
    """Rows per score band; a band without rows shows 0."""
    column = F.nanvl(F.col(score), F.lit(None).cast("double"))
    flat = df.agg(*[F.count_if(_in_band(column, band)).alias(band[0]) for band in BANDS])
    return flat.unpivot([], [F.col(f"`{band[0]}`") for band in BANDS], "band", "n_rows")


def band_presence(df: DataFrame, score: str, fields: Sequence[str]) -> DataFrame:
    """Per band and field: rows, rows with the field, rows without it, percentage to one digit."""
    column = F.nanvl(F.col(score), F.lit(None).cast("double"))
    cells, measures = [], []
    for i, band in enumerate(BANDS):
        inside = _in_band(column, band)
        measures.append(F.count_if(inside).alias(f"_total_{i}"))
        for j, name in enumerate(fields):
            known = inside & F.col(name).isNotNull()
            measures.append(F.count_if(known).alias(f"_known_{i}_{j}"))
            cells.append(F.struct(
                F.lit(band[0]).alias("band"), F.lit(name).alias("field"),
                F.col(f"_total_{i}").alias("total"), F.col(f"_known_{i}_{j}").alias("present"),
            ))
    rows = df.agg(*measures).select(F.inline(F.array(*cells)))
    share = F.try_divide(F.lit(100.0) * F.col("present"), F.col("total"))
    return rows.select(
        "band", "field", "total", "present", (F.col("total") - F.col("present")).alias("missing"),
        F.coalesce(round_even(share, 1), F.lit(0.0)).alias("pct"),
    )
