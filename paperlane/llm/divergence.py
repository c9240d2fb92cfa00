"""How far the sources of a language differ in their words, by cube partitioning.

Terms are counted per language and source. The comparison of all groups of a language is a cube: one
group, the other group, term. It is cut into cells of (group block, group block, term block). The counts
of one block of groups in one block of terms are a slice; a slice is sent to each cell that needs it,
each cell sums what its terms add to the divergence of its pairs of groups, and the sums of the cells
are added up along the axis of terms. No task sees all terms of a group or all groups of a term.

The share of a term in a group is p = 1 + floor(SCALE * (count + SMOOTHING) / (N + SMOOTHING * V)), with
N the sum of the counts of all V terms kept; all numbers are whole, so sums do not depend on their order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlane.llm.numbering import numbered
from paperlane.llm.sizes import broadcast_within
from paperlane.session import materialize

SCALE, SMOOTHING = 1_000_000_000, 5
LEAST_DOCUMENTS = 30
TOP_TERMS = 50
GROUP_BLOCK, TERM_BLOCK = 32, 4096  # a slice has at most about their product of counts
HELD_TERMS = 500_000  # partial counts that a task holds before it passes them on
PIECE_BYTES = 1 << 20

# UTF-8 bytes: letters A-Z in lower case, what parts terms as spaces, all else as it is
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time; a term is never cut."""
    at = 0
    while at < len(text):
        end = min(at + PIECE_BYTES, len(text))
        while end < len(text) and FOLDED[text[end]] != 32:
            end += 1
        yield text[at:end].translate(FOLDED).split()
        at = end


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and numbers of documents per (language, source, term), as far as one task has them.

    The empty term stands for the group itself, which is there even without terms.
    """
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, documents) in held.items():
            n = len(documents)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(documents.keys(), pa.string()),
                    pa.array([counts[t] for t in documents], pa.int64()), pa.array(documents.values(), pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i) for i in range(3)), strict=True):
            group = lang.as_py(), source.as_py()
            if group not in held:
                held[group] = Counter(), Counter({b"": 1})
            counts, documents = held[group]
            before = len(documents)
            own: set[bytes] = set()
            for words in words_of(text.as_py()):
                counts.update(words)
                own.update(words)
            documents.update(own)
            size += len(documents) - before
            if size > HELD_TERMS:
                yield from passed_on()
                size = 0
    yield from passed_on()


def share(count: Column, total: Column, kept: Column) -> Column:
    """The share of a term, exactly; products of two large counts do not fit a long."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")
    below = (total + kept * SMOOTHING).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


class Counted:
    """Terms kept and their counts; each step is stored, as several later ones read it."""

    def __init__(self, docs: DataFrame, text: str, lang: str, source: str, least_documents: int, group_block: int, term_block: int):
        def filled(name: str) -> Column:
            return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))

        rows = docs.select(filled(lang).alias("lang"), filled(source).alias("source"), filled(text).cast("binary").alias("text"))
        parts = rows.mapInArrow(count_terms, "lang string, source string, term string, n bigint, docs bigint")
        counts = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        counts = materialize(counts, "terms")
        kept = counts.filter("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        kept = materialize(kept.filter(F.col("docs") >= least_documents).select("lang", "term", "lang_n"), "kept")

        langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
        langs = materialize(langs.withColumn("term_blocks", F.expr(f"(kept + {term_block} - 1) div {term_block}")), "langs")
        # the place of a term in its block; a block holds about as many as the bound
        placed = kept.join(broadcast_within(langs.select("lang", "term_blocks")), "lang")
        placed = placed.withColumn("block", F.pmod(F.xxhash64("term"), F.col("term_blocks"))).drop("term_blocks")
        placed = placed.withColumn("place", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")))
        found = counts.select("lang", "source", "term", "n").join(placed, ["lang", "term"])
        found = materialize(found, "found")

        # groups in order, so that a block of them is a run of numbers
        totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counts.filter("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left")
        groups = groups.join(langs, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
        groups = numbered(groups, [F.col("lang"), F.col("source")], "number", "groups")
        first = groups.groupBy("lang").agg(F.min("number").alias("first"), F.count("*").alias("groups"))
        groups = groups.join(broadcast_within(materialize(first, "first")), "lang")
        groups = groups.withColumn("inside", F.col("number") - F.col("first")).drop("number", "first")
        groups = groups.withColumn("group_block", F.expr(f"inside div {group_block}"))
        groups = groups.withColumn("group_place", F.col("inside") % group_block).drop("inside", "term_blocks")
        # share of a term that a group does not have
        groups = groups.withColumn("p0", F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))).otherwise(0))
        self.groups = materialize(groups.withColumn("group_blocks", F.expr(f"(groups + {group_block} - 1) div {group_block}")), "groups")

        shares = found.join(broadcast_within(self.groups), ["lang", "source"])
        shares = shares.withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
        shares = shares.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("kept")))
        names = ["lang", "source", "term", "n", "p", "q", "p0", "block", "place", "group_block", "group_place", "group_blocks"]
        self.shares = materialize(shares.select(*names), "shares")

    def heads(self) -> DataFrame:
        """The members of each block of groups, in order, each with its share of a term it lacks."""
        member = F.sort_array(F.collect_list(F.struct("group_place", "source", "p0"))).alias("members")
        heads = self.groups.groupBy("lang", "group_block", "group_blocks", "kept").agg(member)
        return heads.select("lang", "group_block", "group_blocks", "kept", F.col("members.source").alias("sources"), F.col("members.p0").alias("p0s"))

    def slices(self) -> DataFrame:
        """One row per block of groups and block of terms that have any counts in common."""
        entry = F.struct("group_place", "place", "p")
        cut = self.shares.groupBy("lang", "group_block", "block").agg(F.collect_list(entry).alias("entries"))
        return cut.select("lang", "group_block", "block", *(F.col(f"entries.{c}").alias(f"{c}s") for c in ("group_place", "place", "p")))


def compare(cell: pd.DataFrame) -> pd.DataFrame:
    """What the terms of one cell add to the divergence of its pairs of groups.

    Terms that both groups lack are all alike. So block -1, which has no counts, tells what all terms
    would add if both lacked them, and other cells add the difference to that for the terms they hold.
    """
    rows = {row.group_block: row for row in cell.itertuples()}
    first = cell.iloc[0]
    one, other = rows[first["one"]], rows[first["other"]]

    def numbers(values: np.ndarray | None) -> np.ndarray:
        return np.zeros(0, dtype=np.int64) if values is None else np.asarray(values, dtype=np.int64)

    terms = np.unique(np.concatenate([numbers(one.places), numbers(other.places)]))

    def shares(row: tuple) -> np.ndarray:
        out = np.repeat(numbers(row.p0s)[:, None], len(terms), axis=1)
        out[numbers(row.group_places), np.searchsorted(terms, numbers(row.places))] = numbers(row.ps)
        return out

    left, right = shares(one), shares(other)
    out = []
    for i, name in enumerate(one.sources):
        lacking = np.abs(one.p0s[i] - numbers(other.p0s))
        sums = lacking * one.kept if first["block"] < 0 else np.abs(left[i] - right).sum(axis=1) - lacking * len(terms)
        # inside one block each pair once
        start = i + 1 if one is other else 0
        out += [(first["lang"], name, item, int(x)) for item, x in zip(other.sources[start:], sums[start:], strict=True)]
    return pd.DataFrame(out, columns=["lang", "one_source", "other_source", "part_sum"])


def divergences(counted: Counted) -> DataFrame:
    """``lang``, ``source``, ``item`` (another source) and ``value`` for all pairs of groups of a language."""
    heads, slices = materialize(counted.heads(), "heads"), materialize(counted.slices(), "slices")
    blocks = heads.select("lang", F.lit(-1).cast("long").alias("block")).unionByName(slices.select("lang", "block")).distinct()
    # a cell needs both its slices, also where one has no counts
    wanted = heads.join(blocks, "lang").join(slices, ["lang", "group_block", "block"], "left")
    wanted = wanted.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("group_blocks") - 1)))
    wanted = wanted.withColumn("one", F.least("group_block", "met")).withColumn("other", F.greatest("group_block", "met"))
    parts = wanted.groupBy("lang", "one", "other", "block").applyInPandas(
        compare, "lang string, one_source string, other_source string, part_sum bigint",
    )
    sums = parts.groupBy("lang", "one_source", "other_source").agg(F.sum("part_sum").alias("value"))
    both = F.array(
        F.struct(F.col("one_source").alias("source"), F.col("other_source").alias("item")),
        F.struct(F.col("other_source").alias("source"), F.col("one_source").alias("item")),
    )
    return sums.select("lang", "value", F.explode(both).alias("pair")).select("lang", "pair.source", "pair.item", "value")


def raised_terms(counted: Counted) -> DataFrame:
    """``lang``, ``source``, ``item`` (a term) and ``value`` of the terms that a source has more often than its language."""
    more = counted.shares.filter("n > 0 AND p > q")
    return more.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK,
) -> DataFrame:
    """Rank, for each source of each language, all other sources by divergence (part ``pair``) and the
    terms raised most against the language (part ``term``, the first ``top_terms``).

    Missing texts, languages and sources are empty strings, which form groups like others. A language
    keeps the terms that at least ``least_documents`` of its documents hold; without any, all
    divergences are 0. Repeated rows count each time. Equal values are ranked by item. Other columns are
    not read, whatever their names. An empty table gives no rows.
    """
    counted = Counted(docs, text, lang, source, least_documents, group_block, term_block)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = divergences(counted).withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order))
    terms = raised_terms(counted).withColumn("part", F.lit("term")).withColumn("rank", F.row_number().over(order))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*names).unionByName(terms.filter(F.col("rank") <= top_terms).select(*names))
