"""Deterministic ids derived from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlane.functions.binding import evaluate_once

UUID_LENGTH = 36


def name_uuid(text: Column, purpose: str) -> Column:
    """Version-5 UUID of ``purpose:text`` in the nil namespace (RFC 4122 section 4.3)."""
    namespace = F.unhex(F.lit("0" * 32))
    name = F.encode(F.concat(F.lit(f"{purpose}:"), text), "UTF-8")

    def dashed(digest: Column) -> Column:
        # the variant keeps the low two bits of the nibble and sets the high ones to 10
        variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
        return F.concat(
            F.substring(digest, 1, 8), F.lit("-"),
            F.substring(digest, 9, 4), F.lit("-5"),
            F.substring(digest, 14, 3), F.lit("-"),
            variant, F.substring(digest, 18, 3), F.lit("-"),
            F.substring(digest, 21, 12),
        )

    return evaluate_once(F.sha1(F.concat(namespace, name)), dashed)


def text_hash(text: Column) -> Column:
    """SHA-256 of the text, lower-case hex."""
    return F.sha2(text, 256)


def fill_column(df: DataFrame, name: str, generated: Column) -> DataFrame:
    """Keep the values of a column and generate the missing ones; add the column if absent."""
    value = F.coalesce(F.col(name), generated) if name in df.columns else generated
    return df.withColumn(name, value)


def renew_uuid(existing: Column, generated: Column) -> Column:
    """Replace an id that is missing or is itself a generated UUID; keep any other id."""
    return F.when(
        existing.isNull() | (F.length(existing) == UUID_LENGTH), generated
    ).otherwise(existing)


def result_link(job_id: Column, prefix: str) -> Column:
    """Address of the result file of an OCR job."""
    return F.concat(F.lit(prefix), job_id, F.lit(".json"))
