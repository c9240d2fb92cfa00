"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are written for."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "paperlane", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC clock and adaptive execution; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def work_root(spark: SparkSession) -> str:
    """Shared folder of the cluster, named by ``spark.checkpoint.dir``.

    Only a local master may go without that setting: there, and only there, one temporary folder
    serves all calls of the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="paperlane-")


def new_work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{work_root(spark)}/paperlane/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For data that several jobs use: it is computed once, and the loss of an executor does not bring
    its whole lineage back.
    """
    path = new_work_path(df.sparkSession, label)
    df.write.parquet(path)
    # the schema is known, so no job has to look into the files
    return df.sparkSession.read.schema(df.schema).parquet(path)
