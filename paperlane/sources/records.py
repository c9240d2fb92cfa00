"""CSV files whose quoted texts hold line breaks, read by many tasks per file.

Where a record ends depends on all quotes before, so such a file seems to have one reader only. But what a
line does to the reader's state is a small function: it leaves it inside or outside of quotes, given
where it starts. Lines are read in splits; the functions of a split's lines are composed in the split, those of
whole splits are composed per file, and then every line knows where it starts. Lines of one record
are glued; the few records that cross splits are glued from their pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
SPLIT = ("file", "block")


def _closing_states(line: Column) -> Column:
    """Whether a line ends inside quotes, if it starts outside (``o``) and if it starts inside (``i``).

    A quote opens a value where the value begins: at the start of the line, after a comma, or right after
    a closing quote, as a doubled quote is a quote that closes and opens. Elsewhere outside it is plain text;
    inside, it closes.
    """
    pieces = F.slice(F.split(line, QUOTE), 1, F.size(F.split(line, QUOTE)) - 1)
    opens = F.transform(pieces, lambda piece, at: (piece == "") | piece.endswith(","))

    def after(inside: bool) -> Column:
        return F.aggregate(opens, F.lit(inside), lambda state, may_open: ~state & may_open)

    return F.struct(after(False).alias("o"), after(True).alias("i"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with their split, their order inside it and the function of each.

    ``fixed`` is the state after a line that does not depend on the state before, ``turns`` tells whether it
    turns the state around; a line without quotes does neither.
    """
    # the line break is named, so that a carriage return stays part of the line
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )
    # one task for each split, as it was read
    ends = F.when(F.contains("line", F.lit(QUOTE)), _closing_states(F.col("line")))
    lines = raw.repartition(*SPLIT).withColumn("_ends", ends)
    fixed = F.when(F.col("_ends.o") == F.col("_ends.i"), F.col("_ends.o"))
    turns = F.coalesce(F.col("_ends.o") & ~F.col("_ends.i"), F.lit(False))
    return lines.select(*SPLIT, "at", "line", fixed.alias("fixed"), turns.cast("int").alias("turns"))


def _odd(count: Column) -> Column:
    return count % 2 == 1


def _differ(one: Column, other: Column) -> Column:
    return one != other


def _composed(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines with what the lines before them in their split do (``base``, ``turned``), and the same for whole splits.

    A fixed state is stored as it would have been at the start of the split, undoing the turns up to it, so
    the last one and the number of turns say all.
    """
    upto = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.withColumn("_turned", F.sum("turns").over(upto))
    counted = counted.withColumn("_base", _differ(F.col("fixed"), _odd(F.col("_turned"))))
    counted = counted.withColumn("base", F.last("_base", ignorenulls=True).over(before))
    counted = counted.withColumn("turned", F.col("_turned") - F.col("turns"))
    splits = counted.groupBy(*SPLIT).agg(
        F.max_by("_base", F.when(F.col("_base").isNotNull(), F.col("at"))).alias("split_base"), F.sum("turns").alias("split_turns"),
    )
    return counted.select(*SPLIT, "at", "line", "base", "turned"), splits


def _starts(splits: DataFrame) -> DataFrame:
    """Whether each split starts inside quotes (``inside``) and whether it ends there (``open``); few rows per file."""
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    turned = splits.withColumn("_turned", F.sum("split_turns").over(upto))
    # a split's fixed state counts from its own start; undo the turns of the splits before it as well
    own = _differ(F.col("split_base"), _odd(F.col("_turned") - F.col("split_turns")))
    based = turned.withColumn("_base", F.last(own, ignorenulls=True).over(upto))
    after = based.withColumn("open", _differ(F.coalesce("_base", F.lit(False)), _odd(F.col("_turned"))))
    in_order = Window.partitionBy("file").orderBy("block")
    return after.select(*SPLIT, F.coalesce(F.lag("open").over(in_order), F.lit(False)).alias("inside"), "open")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as they stand: ``file``, ``block`` (the split it starts in), ``number`` in that
    split from 1, and ``record``, with the line breaks inside it and without the one at its end.

    Quotes follow RFC 4180: a quoted value begins right after a comma or line break, and a quote inside it is
    doubled. A quote inside an unquoted value is text. Lines end with LF or CR LF. A quote that is never
    closed takes in the rest of its file.
    """
    lines, splits = _composed(_lines(spark, path))
    placed = lines.join(_starts(splits), list(SPLIT))
    inside = _differ(F.coalesce(F.col("base"), F.col("inside")), _odd(F.col("turned")))
    starts = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    numbered = placed.withColumn("number", F.sum((~inside).cast("long")).over(starts))
    # same keys as the windows, so the lines are not shuffled again; number 0 goes on with an earlier split's record
    line_order = F.sort_array(F.collect_list(F.struct("at", "line")))
    glued = numbered.groupBy(*SPLIT, "number").agg(line_order.alias("_lines"), F.first("open").alias("open"))
    last = Window.partitionBy(*SPLIT)
    pieces = glued.select(
        *SPLIT, "number", F.array_join("_lines.line", "\n").alias("record"),
        (F.col("open") & (F.col("number") == F.max("number").over(last))).alias("unfinished"),
    )
    whole = pieces.filter("number > 0 AND NOT unfinished").select(*SPLIT, "number", "record")
    parts = pieces.filter("number = 0 OR unfinished")
    # at most two pieces of a split: its first may end, and its last may begin, a record of several splits
    begins = Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("number") > 0, F.struct("block", "number")), ignorenulls=True).over(begins)
    owners = parts.select(*SPLIT, "number").select("*", owner.alias("_owner"))
    owned = parts.join(owners, [*SPLIT, "number"])
    joined = owned.groupBy("file", "_owner").agg(F.sort_array(F.collect_list(F.struct("block", "record"))).alias("_pieces"))
    crossing = joined.select("file", "_owner.block", "_owner.number", F.array_join("_pieces.record", "\n").alias("record"))
    found = whole.unionByName(crossing)
    return found.withColumn("record", F.regexp_replace("record", "\r\\z", "")).filter("record <> ''")


def read_split_corpus(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV corpus with line breaks and doubled quotes in its texts, each file read by as many tasks as it has splits.

    Columns are taken by place. Rows equal those of ``tables.read_corpus``, but line breaks inside a value stay
    as they are, where that one turns CR LF into LF if lines end so. Empty lines are left out.
    """
    records = read_records(spark, path)
    if header:
        # the first record of a file starts its first split
        records = records.filter("NOT (block = 0 AND number = 1)")
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"escape": QUOTE, "multiLine": "true"}
    return records.select(F.from_csv("record", ddl, options).alias("row")).select("row.*")
