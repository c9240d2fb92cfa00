"""Growing the labelled corpus and loading labels and OCR jobs from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.functions.ids import fill_column, name_uuid, result_link, text_hash
from paperlane.functions.predicates import differs
from paperlane.operators.joins import drop_known, stack
from paperlane.operators.order import keep_first, shuffled_rank
from paperlane.operators.quality import check_required, check_types

GENERATED = ("ticket_uuid", "attachment_id", "ocr_job_id", "ocr_link")


def fill_ids(df: DataFrame, link_prefix: str) -> DataFrame:
    """Fill ticket id, attachment id, OCR job id and result link; existing values stay."""
    text = F.col("text")
    for name in ("ticket_uuid", "attachment_id"):
        df = fill_column(df, name, name_uuid(text, name))
    df = fill_column(df, "ocr_job_id", text_hash(text))
    return fill_column(df, "ocr_link", result_link(F.col("ocr_job_id"), link_prefix))


def upsert_corpus(
    existing: DataFrame, new: DataFrame, required: Sequence[str], link_prefix: str,
    dedupe_new: Sequence[str] = (),
) -> DataFrame:
    """Existing corpus plus the new rows whose ticket id it does not hold.

    New rows are checked for empty required fields and for column types. Copies inside the new rows
    stay unless ``dedupe_new`` names the columns whose order says which copy is the first.
    """
    check_required(new, required)
    new = fill_ids(new, link_prefix)
    check_types(existing, new)
    added = drop_known(new, existing, ["ticket_uuid"])
    if dedupe_new:
        added = keep_first(added, ["ticket_uuid"], dedupe_new)
    return stack([existing, added])


def ensure_labels(
    defs: DataFrame, types: DataFrame, nature: str, as_of: str, dry_run: bool = False,
    subtype: str = "none",
) -> tuple[DataFrame, DataFrame]:
    """Label ids of all document types, and the definitions that have to be written.

    A type already defined under the same subtype and nature keeps its smallest id. Missing types
    get the ids after the largest one in use; in a dry run they get no id.
    """
    wanted = types.select("document_type").filter("document_type IS NOT NULL").distinct()
    same = defs.filter((F.col("subtype") == subtype) & (F.col("nature") == nature))
    known = same.groupBy(F.col("type").alias("document_type")).agg(F.min("id").alias("label_id"))
    missing = drop_known(wanted, known, ["document_type"])
    if dry_run:
        numbered = missing.withColumn("label_id", F.lit(None).cast("long"))
    else:
        ranked = shuffled_rank(missing, [], "document_type", rank="_rank", size="_size")
        last = F.coalesce(defs.agg(F.max("id")).scalar(), F.lit(0))
        numbered = ranked.select("document_type", (last + F.col("_rank")).cast("long").alias("label_id"))
    stamp = F.lit(as_of).cast("timestamp_ntz")
    new_defs = numbered.select(
        F.col("label_id").alias("id"), F.col("document_type").alias("type"),
        F.lit(subtype).alias("subtype"), F.lit(nature).alias("nature"),
        stamp.alias("created_at"), stamp.alias("updated_at"),
        F.lit(None).cast("string").alias("datatype"),
    )
    found = wanted.join(known, "document_type")
    return found.unionByName(numbered), new_defs


def loadable(df: DataFrame, excluded_type: str) -> DataFrame:
    """Rows of all document types but one; a missing type stays."""
    return df.filter(differs(F.col("document_type"), excluded_type))


def new_tickets(df: DataFrame, ticket_labels: DataFrame) -> DataFrame:
    """Rows whose ticket has no label yet."""
    return drop_known(df, ticket_labels, ["ticket_uuid"])


def label_assignments(new: DataFrame, label_ids: DataFrame, as_of: str) -> DataFrame:
    """Label rows to append; rows whose type has no label id are skipped."""
    ids = label_ids.filter("label_id IS NOT NULL")
    stamp = F.lit(as_of).cast("timestamp_ntz")
    empty = F.lit(None).cast("string")
    return new.join(ids, "document_type").select(
        "ticket_uuid", empty.alias("source_id"), empty.alias("comment_id"), "attachment_id",
        "label_id", F.lit("True").alias("value"), stamp.alias("created_at"), stamp.alias("updated_at"),
    )


def job_registrations(new: DataFrame, as_of: str) -> DataFrame:
    """OCR job rows to append, for all new rows, those without a label too."""
    stamp = F.lit(as_of).cast("timestamp_ntz")
    return new.select(
        "attachment_id", F.col("ocr_job_id").alias("job_id"), F.lit("SUCCEEDED").alias("status"),
        "ocr_link", stamp.alias("created_at"), stamp.alias("updated_at"),
    )


def plan_load(
    corpus: DataFrame, defs: DataFrame, ticket_labels: DataFrame, nature: str, excluded_type: str,
    as_of: str, dry_run: bool = False,
) -> dict[str, DataFrame]:
    """The three tables a load would append, and the label ids of all types it has.

    Nothing is written; that is a call of its own.
    """
    check_required(corpus, GENERATED)
    rows = loadable(corpus, excluded_type)
    label_ids, new_defs = ensure_labels(defs, rows, nature, as_of, dry_run)
    new = new_tickets(rows, ticket_labels)
    return {
        "label_ids": label_ids, "label_defs": new_defs,
        "ticket_labels": label_assignments(new, label_ids, as_of),
        "ocr_jobs": job_registrations(new, as_of),
    }
