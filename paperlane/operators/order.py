"""First, last and nth rows, samples, and ranks that never sort a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 60
CELLS_PER_PARTITION = 4


def cell_count(df: DataFrame) -> int:
    """Cells that ranks and running totals are cut into: a few per shuffle partition.

    They decide which task handles a row, never a result.
    """
    return CELLS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order; missing keys form one group.

    Spark turns the filter into a group limit that runs before the shuffle, so a hot key sends one
    row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_value(value: Column, condition: Column, order: Column) -> Column:
    """Aggregate: the value of the first row that meets the condition, even if it is missing."""
    return F.min_by(value, F.when(condition, order))


def first_known(value: Column, condition: Column, order: Column) -> Column:
    """Aggregate: the first value that meets the condition and is not missing."""
    return F.min_by(value, F.when(condition & value.isNotNull(), order))


def last_value(value: Column, order: Column) -> Column:
    """Aggregate: the value of the last row, as when later rows overwrite earlier ones."""
    return F.max_by(value, order)


def preview(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first n rows."""
    return df.orderBy(*order).limit(n)


def nth_row(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """Row number n, counted from 1; empty when there are fewer rows."""
    return df.orderBy(*order).limit(n).offset(n - 1)


def hash_order(key: str, seed: int) -> Column:
    """Pseudo-random order of a key, the same in every run, layout and engine.

    The first 60 bits of the MD5 of ``key:seed`` as a number; ties are left to the key.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    # never missing, which also spares joins on it a check that would compute it once more
    return F.coalesce(number, F.lit(0).cast("long"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows picked at random but reproducibly; all rows when there are fewer."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def sample_others(
    df: DataFrame, picked: DataFrame, key: str, n: int, seed: int = 42
) -> DataFrame:
    """A sample without the rows picked before."""
    return sample_rows(df.join(picked.select(key), key, "left_anti"), key, n, seed)


def review_set(df: DataFrame, flag: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """All positive rows and n sampled negative ones."""
    negatives = sample_rows(df.filter(~F.col(flag)), key, n, seed)
    return df.filter(flag).unionByName(negatives)


def _spread_keys(df: DataFrame, group: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add the group as one struct, which plain equality also joins where a part is missing."""
    if not group:
        return df, []
    return df.withColumn("_group", F.struct(*group)), ["_group"]


def shuffled_rank(
    df: DataFrame, group: Sequence[str], key: str, seed: int = 42, rank: str = "rank",
    size: str = "group_size",
) -> DataFrame:
    """Number the rows of each group in hash order from 1, and add the size of the group.

    ``key`` identifies a row. Rows are spread over hash cells; a row's rank is the number of rows
    in the cells before its own plus its rank inside the cell. One task sorts one cell of one
    group, so a group with a third of all rows is still spread over all executors.
    """
    rows, keys = _spread_keys(df.withColumn("_hash", hash_order(key, seed)), group)
    width = HASH_BITS - (cell_count(df) - 1).bit_length()
    rows = rows.withColumn("_cell", F.shiftright("_hash", width).cast("int"))

    # at most one row per cell and group
    counts = rows.groupBy(*keys, "_cell").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select(
        *keys, "_cell", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias(size),
    )

    # the cell leads, as sorting is fastest on a plain number
    inside = Window.partitionBy("_cell", *keys).orderBy("_hash", key)
    ranked = rows.withColumn("_inside", F.row_number().over(inside))
    # same keys as the window, so the rows are not shuffled again
    return ranked.join(cells, ["_cell", *keys]).select(
        *df.columns, (F.col("_before") + F.col("_inside")).alias(rank), size
    )


def value_cuts(df: DataFrame, column: str, cells: int | None = None) -> list[float]:
    """Cut points that spread the values of a column evenly over cells; at most ``cells`` numbers.

    The cuts only decide which task handles a value, never a result, so they may be approximate.
    """
    cells = cells or cell_count(df)
    shares = [i / cells for i in range(1, cells)]
    cuts = df.approxQuantile(column, shares, 0.5 / cells)
    return sorted({cut for cut in cuts if cut == cut})


def running_totals(
    df: DataFrame, value: str, measures: dict[str, Column], cuts: list[float],
    group: Sequence[str] = (), descending: bool = False,
) -> DataFrame:
    """Sums per distinct value with their running sums, without one global window.

    ``measures`` are aggregates that add up, such as counts. For a measure ``n`` the result has
    ``n``, the running sum ``n_upto``, this value included, and the sum of the whole group
    ``n_all``.

    The cuts split the values into cells. The sums of whole cells are few rows and are accumulated
    first, straight from the table; then each cell accumulates its own values. Equal values are
    summed before the shuffle, so a hot value is one row per task.
    """
    cell = Bucketizer(
        splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol=value, outputCol="_cell"
    )
    rows, keys = _spread_keys(cell.transform(df).withColumn("_cell", F.col("_cell").cast("int")), group)
    summed = [measure.alias(name) for name, measure in measures.items()]
    to_here = Window.unboundedPreceding, Window.currentRow
    before = Window.unboundedPreceding, -1

    cell_order = F.col("_cell").desc() if descending else F.col("_cell").asc()
    over_cells = Window.partitionBy(*keys).orderBy(cell_order).rowsBetween(*before)
    # at most one row per cut and group
    per_cell = rows.groupBy(*keys, "_cell").agg(*summed)
    cells = per_cell.select(
        *keys, "_cell",
        *[F.coalesce(F.sum(n).over(over_cells), F.lit(0)).alias(f"_before_{n}") for n in measures],
        *[F.sum(n).over(Window.partitionBy(*keys)).alias(f"{n}_all") for n in measures],
    )

    value_order = F.col(value).desc() if descending else F.col(value).asc()
    over_values = Window.partitionBy("_cell", *keys).orderBy(value_order).rowsBetween(*to_here)
    hist = rows.groupBy(*group, *keys, "_cell", value).agg(*summed)
    within = hist.select("*", *[F.sum(n).over(over_values).alias(f"_within_{n}") for n in measures])
    # same keys as the window, so the values are not shuffled again
    return within.join(cells, ["_cell", *keys]).select(
        *group, value, *measures,
        *[(F.col(f"_before_{n}") + F.col(f"_within_{n}")).alias(f"{n}_upto") for n in measures],
        *[f"{n}_all" for n in measures],
    )
