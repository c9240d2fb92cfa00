"""Joins whose small side is broadcast only if its measured size allows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20
ROW_BYTES, VALUE_BYTES = 64, 16


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table with a broadcast hint if it has few rows; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def broadcast_within(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table of plain columns with a broadcast hint if its rows take few bytes in memory; else
    as it is, for a shuffled join. The bytes of all its texts are summed, so the bound is proven."""
    plain = (T.StringType, T.BinaryType, T.NumericType, T.BooleanType)
    if not all(isinstance(f.dataType, plain) for f in df.schema.fields):
        raise TypeError("only plain columns have a size that is known without looking into them")
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    text_bytes = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts), F.lit(0)).cast("long")
    rows, used = df.agg(F.count("*"), F.coalesce(F.sum(text_bytes), F.lit(0))).first()
    return F.broadcast(df) if used + rows * (ROW_BYTES + VALUE_BYTES * len(df.columns)) <= limit else df
