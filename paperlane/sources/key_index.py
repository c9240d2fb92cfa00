"""The keys that a growing table holds, kept so that a load never moves the old ones.

Keys lie in a table of buckets. New keys are dealt to the same buckets, so a load shuffles only its own keys,
and each bucket of old ones is read where it lies. The index follows the commits of ``batches``: keys
of a committed batch that are not in it yet are added before it is asked, so a run that was cut off between
the two leaves nothing out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlane.sources import batches

BUCKETS = 64
INDEXED = "indexed"  # the table of batches whose keys the index holds


class KeyIndex:
    """Distinct values of one column of a committed table.

    ``name`` is the index's name in the session's catalog; its files lie below ``root``, so another session
    opens them again under any name. The number of buckets is fixed when the index is made.
    """

    def __init__(self, spark: SparkSession, root: str, table: str, key: str, kind: str, name: str, buckets: int = BUCKETS):
        self.spark, self.root, self.table, self.key, self.name, self.buckets = spark, root, table, key, name, buckets
        self.path = f"{root}/{table}-keys"
        column = T.StructField(key, T.DataType.fromDDL(kind)).dataType.simpleString()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (`{key}` {column}) USING parquet "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def keys(self) -> DataFrame:
        """All keys; some may be there twice."""
        return self.spark.table(self.name)

    def add(self, rows: DataFrame) -> None:
        """Add the keys of some rows, one file per bucket."""
        column = F.col(f"`{self.key}`")
        keys = rows.select(column).filter(column.isNotNull()).distinct().repartition(self.buckets, column)
        keys.write.bucketBy(self.buckets, self.key).sortBy(self.key).mode("append").format("parquet").option("path", self.path).saveAsTable(self.name)

    def close(self) -> None:
        """Take the name out of the catalog; the files stay and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def catch_up(self) -> int:
        """Add the keys of batches that were committed since the last time; their number."""
        # a batch of merged ones holds no new keys
        held = batches.commits(self.spark, self.root).filter(F.array_contains("tables", self.table) & (F.size("merged") == 0))
        log = f"{self.path}-log"
        known = batches.commits(self.spark, log)
        missing = [r["attempt"] for r in held.join(known, "batch", "left_anti").select("attempt").collect()]
        if missing:
            self.add(self.spark.read.parquet(*sorted(f"{self.root}/{self.table}/{attempt}" for attempt in missing)))
            for row in held.filter(F.col("attempt").isin(missing)).select("batch", "attempt").collect():
                # cut off before this, the keys are added twice, which changes nothing
                batches.commit_attempt(self.spark, log, row["batch"], row["attempt"], [INDEXED])
        return len(missing)

    def unknown(self, rows: DataFrame) -> DataFrame:
        """Rows whose key the table does not hold; a missing key is never held.

        The distinct keys of the rows are dealt to the buckets, and the rows then meet those that are held:
        a hot key of new rows is one row at the buckets, and can be split when the rows meet it.
        """
        column = F.col(f"`{self.key}`")
        asked = rows.select(column).filter(column.isNotNull()).distinct()
        held = asked.repartition(self.buckets, column).join(self.keys().hint("merge"), self.key, "left_semi")
        return rows.join(held, self.key, "left_anti")


def append_unknown(
    spark: SparkSession, rows: DataFrame, index: KeyIndex, batch: str, enrich: Callable[[DataFrame], DataFrame] = lambda df: df
) -> bool:
    """Add the rows of a batch whose key is new to the indexed table; False if the batch is there already.

    ``enrich`` is applied to these rows alone, so costly work is not done again. It keeps the key.
    """
    index.catch_up()
    return batches.append_batch(spark, {index.table: enrich(index.unknown(rows))}, index.root, batch)
