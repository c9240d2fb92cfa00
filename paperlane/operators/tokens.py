"""Token statistics and search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlane.functions.numbers import round_even
from paperlane.functions.text import TAGS, count_tag


def token_frequency(df: DataFrame, tokens: str, normalize: bool = True) -> DataFrame:
    """Occurrences of each token, by default divided by the number of documents (two digits)."""
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(
        F.count("*").alias("n_total")
    )
    if normalize:
        documents = df.agg(F.count("*")).scalar()
        frequency = round_even(F.col("n_total") / documents, 2)
    else:
        frequency = F.col("n_total").cast("double")
    return counts.withColumn("frequency", frequency).orderBy(F.desc("frequency"), "token")


def rows_with_token(
    df: DataFrame, tokens: str, token: str, also: Column | None = None
) -> DataFrame:
    """Rows whose token list holds the token; ``also`` is a second condition."""
    found = df.filter(F.array_contains(tokens, token))
    return found if also is None else found.filter(also)


def tag_counts(
    df: DataFrame, text: str, kind: str, tags: Sequence[str] = TAGS
) -> DataFrame:
    """Occurrences of each tag per document type, and ln(count + 1)."""
    # unpivoted names must be plain, so tags travel by position
    names = [f"_tag_{i}" for i in range(len(tags))]
    sums = df.groupBy(kind).agg(
        *[F.sum(count_tag(F.col(text), tag)).alias(n) for n, tag in zip(names, tags)]
    )
    cells = [F.struct(F.lit(tag).alias("tag"), F.col(n).alias("n")) for n, tag in zip(names, tags)]
    long = sums.select(kind, F.inline(F.array(*cells)))
    return long.select(kind, "tag", F.col("n").alias("n_found"), F.log1p("n").alias("log_count"))
