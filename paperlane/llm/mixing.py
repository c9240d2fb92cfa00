"""Mix sources to target weights: how often each document is repeated.

Words are counted per document and summed per source. Sources share the words of the mix by weight; what
would repeat a source too often goes to the others. The rate of a source is its target over its size;
each of its documents is emitted floor(rate) times, and once more with a probability equal to the
fraction, by a hash of the document and a seed. Decisions hang on nothing but the row, so a task that
runs again decides alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlane.llm.numbering import numbered
from paperlane.llm.sizes import broadcast_within
from paperlane.llm.tasks import columns_besides
from paperlane.session import materialize

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 42
CHANCE_DIGITS = 13  # hexadecimal digits of a hash; 52 bits are exact as a double
ADDED = ("size", "source_size", "target", "copies")


def word_count(text: Column) -> Column:
    """Number of the words that white space parts; 0 for a missing text.

    Each word shrinks to one sign together with the space before it, so no list of words is built.
    """
    shrunk = F.regexp_replace(text, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++", "x")
    return F.coalesce(F.octet_length(F.regexp_replace(shrunk, r"[\x20\x09-\x0D]++", "")), F.lit(0)).cast("long")


def chance(key: Sequence[Column], seed: int) -> Column:
    """A number from 0 to below 1 that follows from a row; missing parts count as empty."""
    parts = [F.coalesce(k.cast("string"), F.lit("")) for k in key]
    digits = F.substring(F.md5(F.concat_ws(":", *parts, F.lit(str(seed))).cast("binary")), 1, CHANCE_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**CHANCE_DIGITS))


@dataclass(frozen=True)
class Level:
    """What a unit of weight gets: ``words`` shared by ``weight``, after the sources that are full."""

    words: int
    weight: int

    def full(self, most: int) -> Column:
        """Whether a source would get more than it may give. Whole numbers, so there is no rounding."""
        share = F.lit(self.words).cast("decimal(38,0)") * F.col("weight")
        room = F.lit(self.weight).cast("decimal(38,0)") * (F.col("source_size") * most)
        return share > room


def fill(sources: DataFrame, most: int) -> Level:
    """Raise the level until no more source is full.

    Each round adds up full and other sources anew. The level only rises and is exact after each round,
    so this is Newton's method on a function of straight pieces and ends after a few rounds.
    """
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = Level(total or 0, weight or 0), 0
    while level.weight:
        found = sources.filter(level.full(most)).agg(F.count("*"), F.sum("source_size"), F.sum("weight")).first()
        if found[0] == full:
            break
        full, level = found[0], Level(total - most * found[1], weight - found[2])
    return level


def source_targets(sized: DataFrame, source: str, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source_size``, ``weight``, ``target`` and ``rate`` of each source of rows with a ``size``.

    Sources in the order of their code points, the missing one last, take the weights in turn. All
    sources together share the sum of all sizes; a target stops at ``most`` times the source's size.
    A source without words has target and rate 0.
    """
    sums = sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    ranked = numbered(sums, [F.col("source").asc_nulls_last()], "_rank_", "sources")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank_") % len(weights)).cast("int") + 1)
    ranked = ranked.withColumn("weight", turn.cast("long")).drop("_rank_")
    level = fill(ranked, most)
    share = (F.col("weight") * F.lit(level.words)).cast("double") / F.lit(float(max(level.weight, 1)))
    target = F.when(level.full(most) if level.weight else F.lit(True), (F.col("source_size") * most).cast("double")).otherwise(share)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    return ranked.withColumn("target", target).withColumn("rate", F.least(rate, F.lit(float(most))))


def repetitions(
    docs: DataFrame, text: str, source: str, key: Sequence[str], weights: Sequence[int] = WEIGHTS, most: int = MOST,
    seed: int = SEED, keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add to each document its ``size`` in words, the ``source_size`` and ``target`` of its source, and
    the number of ``copies`` that the mix takes, ``most`` at most.

    ``key`` names the columns whose values decide the extra copy; rows that agree in them are
    taken alike. Rows are never merged, so repeated rows stay. A missing text has no words, a missing
    source is a source of its own. Columns of the same names are replaced. An empty table stays empty.
    """
    kept = columns_besides(docs, ADDED, keep)
    decided = chance([F.col(f"`{k}`") for k in key], seed)
    names = [f"_{i}" for i in range(len(kept))]
    kept_columns = [F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)]
    rows = docs.select(
        *kept_columns, F.col(f"`{source}`").alias("_source_"), word_count(F.col(f"`{text}`")).alias("size"), decided.alias("_chance_"),
    )
    # counted and hashed once; both the sums and the rows that are returned come from here
    rows = materialize(rows, "sized")
    targets = materialize(source_targets(rows, "_source_", weights, most), "targets")
    found = rows.join(
        broadcast_within(targets.select("source", "source_size", "target", "rate")), F.col("_source_").eqNullSafe(F.col("source")),
    )
    whole = F.floor("rate")
    copies = (whole + (F.col("_chance_") < F.col("rate") - whole).cast("long")).cast("long")
    return found.select(
        *(F.col(n).alias(c) for n, c in zip(names, kept, strict=True)), "size", "source_size", "target", copies.alias("copies"),
    )


def mixed(repeated: DataFrame, copy: str = "copy") -> DataFrame:
    """The mix itself: each row of ``repetitions`` as often as it is taken, numbered from 1."""
    taken = repeated.filter("copies > 0")
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
