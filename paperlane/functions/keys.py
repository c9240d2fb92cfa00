"""Object addresses, dated keys and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File extensions that are skipped, and those that cannot be processed.
IRRELEVANT_EXTENSIONS = ("vcf", "gif", "p7s", "asc", "ics", "bin")
UNSUPPORTED_EXTENSIONS = ("html", "mp4")


def uri_bucket(uri: Column) -> Column:
    """Bucket of ``scheme://bucket/key``; NULL when the text is no such address."""
    return F.nullif(F.regexp_extract(uri, r"^[a-z0-9]+://([^/]+)/", 1), F.lit(""))


def uri_key(uri: Column) -> Column:
    """Object key of ``scheme://bucket/key``; NULL when the text is no such address."""
    return F.nullif(F.regexp_extract(uri, r"(?s)^[a-z0-9]+://[^/]+/(.+)$", 1), F.lit(""))


def file_name(key: Column) -> Column:
    """Text after the last slash; NULL stays NULL."""
    return F.substring_index(key, "/", -1)


def file_extension(name: Column) -> Column:
    """Lower-case text after the last dot of a file name."""
    return F.lower(F.substring_index(name, ".", -1))


def file_route(name: Column) -> Column:
    """``irrelevant``, ``unsupported`` or ``process``, by file extension."""
    extension = file_extension(name)
    return (
        F.when(extension.isin(*IRRELEVANT_EXTENSIONS), "irrelevant")
        .when(extension.isin(*UNSUPPORTED_EXTENSIONS), "unsupported")
        .otherwise("process")
    )


def dated_key(as_of: Column, source_id: Column, name: Column, base: str, prefix: str) -> Column:
    """``base/yyyy-MM-dd/prefix_id/file``; the day is an argument, never the wall clock."""
    day = F.date_format(as_of, "yyyy-MM-dd")
    folder = F.concat(F.lit(f"{prefix}_"), source_id)
    return F.concat_ws("/", F.lit(base), day, folder, name)


def export_key(created_at: Column, base: str, name: str = "export_data.json") -> Column:
    """``base/yyyy_MM_dd/HHmm/name`` of a UTC time."""
    return F.concat_ws(
        "/", F.lit(base), F.date_format(created_at, "yyyy_MM_dd"),
        F.date_format(created_at, "HHmm"), F.lit(name),
    )


def export_key_time(key: Column) -> Column:
    """UTC time held in the two folders above the file name; NULL for a malformed key."""
    digits = F.regexp_extract(
        key, r"(?:^|/)([0-9]{4}_[0-9]{2}_[0-9]{2}/[0-9]{4})/[^/]*$", 1
    )

    def part(start: int, length: int) -> Column:
        return F.substring(digits, start, length).try_cast("int")

    return F.try_make_timestamp_ntz(
        part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(14, 2), F.lit(0)
    )


def review_link(key: Column, base: str) -> Column:
    """Link a reviewer can open."""
    return F.concat(F.lit(base), key)
