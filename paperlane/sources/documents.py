"""OCR results and exports kept as JSON files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlane.functions.parse import BLOCK_TYPE, blocks_to_text, text_to_blocks
from paperlane.session import new_work_path
from paperlane.sources.tables import location

EXPORT_SCHEMA = "messageId string, attachments array<struct<id:string>>"
EXPORT_ROWS = 10_000  # messages of a file
FILES_PER_READ = 10_000  # names in one filter of a scan


def blocks_json(text: Column) -> Column:
    """A text as the JSON array of its line blocks."""
    return F.to_json(text_to_blocks(text))


def text_from_json(blocks: Column) -> Column:
    """Text of a JSON array of blocks; no or unreadable JSON gives the empty text."""
    return blocks_to_text(F.from_json(blocks, BLOCK_TYPE))


def write_ocr_blocks(df: DataFrame, path: str, job_id: str = "ocr_job_id", text: str = "text") -> None:
    """One JSON array per job id, as a table keyed by the job id."""
    df.select(F.col(job_id).alias("job_id"), blocks_json(F.col(text)).alias("blocks")) \
        .write.mode("overwrite").parquet(path)


def path_below(path: Column, folder: str) -> Column:
    """What follows the folder in the address of one of its files, with percent signs decoded."""
    whole = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    # a plus sign stands for itself in a path
    decoded = F.url_decode(F.replace(whole, F.lit("+"), F.lit("%2B")))
    top = re.sub(r"^[a-z]+://[^/]*", "", location(folder))
    return F.when(decoded.startswith(f"{top}/"), F.substr(decoded, F.lit(len(top) + 2)))


def read_ocr_blocks(
    spark: SparkSession, links: DataFrame, folder: str, link: str = "ocr_link", root: str = "", files: int = FILES_PER_READ
) -> DataFrame:
    """Text per link from a folder with one JSON file per job; without a file the text is empty.

    A link is ``root`` and the path of its file below the folder. The folder is listed, and only files that a
    link names are opened. Their names reach the scan as a filter on the path, ``files`` at a time, so the
    driver holds a bounded number of them besides the listing that any scan has there.
    """
    below = F.when(F.col(link).startswith(root), F.substr(F.col(link), F.lit(len(root) + 1)))
    wanted = links.withColumn("_file", below)
    found = named_files(spark, wanted.select("_file"), folder)
    whole = spark.read.text(folder, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("_path"), F.col("value").alias("_json")
    )
    store, rest = new_work_path(spark, "ocr"), found.toLocalIterator()
    columns = "_file string, _json string"
    spark.createDataFrame([], columns).write.parquet(store)
    while paths := [row["_path"] for row in islice(rest, files)]:
        # the scan drops all other files before it deals out work
        part = whole.filter(F.col("_path").isin(paths)).select(path_below(F.col("_path"), folder).alias("_file"), "_json")
        part.write.mode("append").parquet(store)
    return wanted.join(spark.read.schema(columns).parquet(store), "_file", "left").select(
        *links.columns, text_from_json(F.col("_json")).alias("text")
    )


def named_files(spark: SparkSession, wanted: DataFrame, folder: str) -> DataFrame:
    """Full paths (``_path``) of the files below a folder that ``_file`` names; no file is opened."""
    # the contents are a column that is not asked for, so that the scan has no reason to open a file
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    paths = listed.select("path", F.col("_metadata.file_path").alias("_path"))
    paths = paths.select(path_below(F.col("_path"), folder).alias("_file"), "_path")
    return paths.join(wanted.filter("_file IS NOT NULL").distinct(), "_file", "left_semi").select("_path")


def write_exports(messages: DataFrame, path: str, rows: int = EXPORT_ROWS) -> None:
    """Files with a JSON array of at most ``rows`` messages each.

    Messages are chunked as they lie in their partitions, so no file depends on a key, and there are
    more files for more rows.
    """
    chunk = F.expr(f"monotonically_increasing_id() div {rows}")
    numbered = messages.select(F.struct(*messages.columns).alias("message"), chunk.alias("chunk"))
    arrays = numbered.groupBy("chunk").agg(F.to_json(F.collect_list("message")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


def read_exports(spark: SparkSession, base: str, days: Sequence[str]) -> DataFrame:
    """Messages of all export files in the folders of the given days (yyyy_MM_dd).

    Only files whose path below the day mentions ``export`` count. All files are listed, however
    many there are.
    """
    paths = [f"{base}/{day}" for day in days]
    rows = spark.read.schema(EXPORT_SCHEMA).json(paths, multiLine=True, recursiveFileLookup=True)
    keyed = rows.withColumn("export_key", F.col("_metadata.file_path"))
    # the key below the base starts with the day
    below_day = F.regexp_replace(path_below(F.col("export_key"), base), "^[^/]*/", "")
    return keyed.filter(below_day.contains("export"))
