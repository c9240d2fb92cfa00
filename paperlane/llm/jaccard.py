"""Exact near-duplicate classes of documents by the Jaccard similarity of their word shingles.

Two sets of sizes x and y are linked when their overlap reaches T, the smallest number with
``100 T >= percent * (x + y - T)``; for a set of x shingles alone, T is at least x * percent / 100.
That makes the search a T-occurrence problem over inverted lists (shingle -> sets), solved as in
DivideSkip: the longest lists of a set are left out of the merge and only probed for the sets that
the short ones bring up.

1. *Occurrence filter.* A set can have a partner only if enough of its shingles occur in other texts.
   Tasks announce packed 32-bit shingle prints, dealt over ranges of the hash, and learn how many of
   theirs occur elsewhere. Wrong prints only let through too many. Nothing else goes on.
2. *Order.* Shingles are ordered by the length of their list, as far as it is long, then by hash. Any
   order is right; this one keeps long lists out of the merge.
3. *Merge.* Of x shingles in that order, the first x - T + 1 are merged: partners share one of them.
   All sets of a list meet under the name of its lowest set. Lists of near copies have the same
   lowest set, so a set goes to few places, and no pairs are formed before they meet.
4. *Probe.* A meeting is split into blocks of bounded size, and each two blocks are compared in one
   task: short lists count their pairs, long ones are probed for all sets at once, as columns of
   0 and 1 whose product counts what two sets share. A spanning forest of the links goes on to the
   components. For the number of links, a pair that meets under several names counts under the lowest
   one only, and each set gets one number for each two blocks; pairs are listed on demand.

Shingles are 64-bit hashes. Documents with equal texts, and texts with equal sets, are one node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlane.llm.components import components
from paperlane.llm.hashing import BASE, WordHasher, lowered, mix
from paperlane.llm.sizes import broadcast_if_small
from paperlane.llm.tasks import columns_besides
from paperlane.session import materialize

SHINGLE, PERCENT = 5, 75
TEXT_PER_RANGE, LEAST_RANGES = 48 << 20, 16  # bytes of text whose prints one task of the filter compares
SLICE_BYTES = 1 << 22
LONG_LIST, LONG_LISTS = 32, 100_000  # lists at least so long, and so many of them, are put last
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 18  # of a meeting, in one block
SHORT, COLUMNS = 16, 1024  # lists whose pairs are counted one by one; long lists probed at once


def shingle_sets(texts: list[bytes], hasher: WordHasher, words: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words is one shingle."""
    hashes, counts = hasher(texts)
    out, at = [], 0
    for n in counts.tolist():
        own, at = hashes[at : at + n], at + n
        k = min(words, n)
        shingles = np.full(n - k + 1 if n else 0, n if n < words else words, dtype=np.uint64)
        for j in range(k):
            shingles = mix(shingles * np.uint64(BASE) + own[j : j + len(shingles)])
        out.append(np.unique(shingles))
    return out


def least_overlap(n: int, percent: int) -> int:
    """Least overlap of a set of n shingles with any partner."""
    return -(-n * percent // 100)


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Keys and lowered texts of a batch of (key, text) without repeated keys, in groups of bounded size."""
    keys, texts, total, seen = [], [], 0, set()
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        if key in seen:
            continue
        seen.add(key)
        keys.append(key)
        texts.append(lowered(text.as_py()))
        total += len(texts[-1])
        if total >= size:
            yield keys, texts
            keys, texts, total = [], [], 0
    if keys:
        yield keys, texts


def announce(ranges: int, words: int, percent: int):
    """Per slice of texts and range: prints that one of its texts has, the texts they belong to, and
    prints that several have. One of the rows tells of the texts themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, number = WordHasher(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for keys, texts in slices(batch):
                sets = shingle_sets(texts, hasher, words)
                # of the first n - T + l shingles by hash, partners share l; here l = n / 4
                first = [s[: len(s) - least_overlap(len(s), percent) + quarter(len(s))] for s in sets]
                owner = np.repeat(np.arange(len(first), dtype=np.uint32), [len(x) for x in first])
                every = np.concatenate(first)
                order = np.argsort(every, kind="stable")
                every, owner = every[order], owner[order]
                new = np.ones(len(every), dtype=bool)
                new[1:] = every[1:] != every[:-1]
                starts = np.flatnonzero(new)
                counts = np.diff(np.append(starts, len(every)))
                alone = counts == 1
                shared = np.bincount(owner[~np.repeat(alone, counts)], minlength=len(keys))
                facts = b"".join(k + np.array([len(s), n], dtype=np.int32).tobytes() for k, s, n in zip(keys, sets, shared, strict=True))
                prints, owner = every[starts], owner[starts]
                place = (prints & np.uint64(0xFFFFF)) % np.uint64(ranges)
                order = np.lexsort((~alone, place))
                prints = (prints[order] >> np.uint64(20)).astype(np.uint32)
                place, alone, owner = place[order], alone[order], owner[order]
                cuts = np.searchsorted(place, np.arange(ranges + 1))
                rows: list[list] = [[] for _ in range(6)]
                telling = (number * 0x9E3779B1 >> 7) % ranges
                for r in range(ranges):
                    a, b = cuts[r], cuts[r + 1]
                    m = a + int(alone[a:b].sum())
                    if a == b and r != telling:
                        continue
                    narrow = np.uint16 if len(keys) < 1 << 16 else np.uint32
                    for column, value in zip(rows, (
                        number, r, prints[a:m].tobytes(), owner[a:m].astype(narrow).tobytes(), prints[m:b].tobytes(),
                        facts if r == telling else b"",
                    ), strict=True):
                        column.append(value)
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.binary()) for c in rows[2:])],
                    names=["slice", "range", "alone", "owner", "several", "facts"],
                )

    return run


def quarter(n: int) -> int:
    return -(-n // 4)


def answer(group: pd.DataFrame) -> pd.DataFrame:
    """Per slice, how many of the prints of each of its texts other slices or several texts announce."""
    alone = [np.frombuffer(x, dtype=np.uint32) for x in group["alone"]]
    several = [np.frombuffer(x, dtype=np.uint32) for x in group["several"]]
    values, counts = np.unique(np.concatenate([*alone, *several]), return_counts=True)
    common = np.append(values[counts > 1], np.uint32(0))
    texts, found = [], []
    for prints, owner in zip(alone, group["owner"], strict=True):
        owner = np.frombuffer(owner, dtype=np.uint16 if len(owner) == 2 * len(prints) else np.uint32)
        at = np.searchsorted(common[:-1], prints)
        n = np.bincount(owner[(at < len(common) - 1) & (common[at] == prints)])
        some = np.flatnonzero(n)
        texts.append(some.astype(np.uint32).tobytes())
        found.append(n[some].astype(np.uint32).tobytes())
    return pd.DataFrame({"slice": group["slice"].to_numpy(), "texts": texts, "found": found, "facts": group["facts"].to_numpy()})


def settle(group: pd.DataFrame) -> pd.DataFrame:
    """Texts of a slice: key, size of the set, and whether enough of it occurs in other texts."""
    facts = np.frombuffer(b"".join(group["facts"]), dtype=np.dtype([("key", "V16"), ("n", "<i4"), ("shared", "<i4")]))
    shared = facts["shared"].astype(np.int64)
    for texts, found in zip(group["texts"], group["found"], strict=True):
        shared[np.frombuffer(texts, dtype=np.uint32)] += np.frombuffer(found, dtype=np.uint32)
    n = facts["n"].astype(np.int64)
    return pd.DataFrame({"key": [k.tobytes() for k in facts["key"]], "n": n, "open": (n > 0) & (shared >= -(-n // 4))})


def occurrence_filter(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Size of the set of each distinct text, and whether it may have a partner."""
    volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(1 << 20, max(LEAST_RANGES, volume // TEXT_PER_RANGE))
    kinds = "slice bigint, range int, alone binary, owner binary, several binary, facts binary"
    told = texts.mapInArrow(announce(ranges, words, percent), kinds)
    answers = told.groupBy("range").applyInPandas(answer, "slice bigint, texts binary, found binary, facts binary")
    settled = answers.groupBy("slice").applyInPandas(settle, "key binary, n bigint, open boolean")
    return settled.groupBy("key").agg(F.max("n").alias("n"), F.bool_or("open").alias("open"))


def sets_of(texts: DataFrame, words: int) -> DataFrame:
    """Set digest and sorted shingles of texts, one row for each text of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = WordHasher(), set()
        for batch in batches:
            for keys, group in slices(batch):
                rows = [(k, s) for k, s in zip(keys, shingle_sets(group, hasher, words), strict=True) if k not in seen]
                seen.update(k for k, _ in rows)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for _, s in rows]
                shingles = pa.array([s.view(np.int64) for _, s in rows], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array(digests, pa.binary()), shingles], names=["key", "digest", "shingles"])

    return texts.mapInArrow(run, "key binary, digest binary, shingles array<bigint>")


def merged_lists(sets: DataFrame, percent: int) -> DataFrame:
    """Postings (shingle, node, n) of the shingles of each set that go into the merge."""
    lengths = sets.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("length"))
    long = lengths.filter(F.col("length") >= LONG_LIST).orderBy(F.desc("length"), "shingle").limit(LONG_LISTS).collect()
    long = sorted((r["shingle"], r["length"]) for r in long)
    names, weights = np.array([s for s, _ in long], dtype=np.int64), np.array([n for _, n in long], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, shingles in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = shingles.values.to_numpy()
                weight = np.zeros(len(own), dtype=np.int64)
                if len(names):
                    at = np.minimum(np.searchsorted(names, own), len(names) - 1)
                    weight = np.where(names[at] == own, weights[at], 0)
                first = own[np.lexsort((own, weight))][: len(own) - least_overlap(len(own), percent) + 1]
                yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(np.full(len(first), node)), pa.array(np.full(len(first), len(own), dtype=np.int32))], names=["shingle", "node", "n"])

    return sets.select("node", "shingles").mapInArrow(run, "shingle bigint, node bigint, n int")


def meetings(lists: DataFrame) -> DataFrame:
    """Distinct (head, node, n): sets that share a list meet under the lowest node of the list."""
    lists = materialize(lists, "lists")
    heads = lists.groupBy("shingle").agg(F.min("node").alias("head"), F.count("*").alias("length")).filter("length > 1")
    met = lists.join(materialize(heads.select("shingle", "head"), "heads"), "shingle")
    return materialize(met.select("head", "node", "n").distinct(), "meetings")


def block_pairs(met: DataFrame) -> DataFrame:
    """Each set once for every pair of blocks it belongs to: head, first and second block, side."""
    sizes = met.groupBy("head").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = materialize(sizes.filter("sets > 1").select("head", blocks.alias("blocks")), "sizes")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")
    placed = met.join(sizes, "head").select("head", "node", own, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return placed.select(
        "head", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", (F.col("own") > F.col("other")).alias("second")
    )


def shared_counts(values: np.ndarray, left: np.ndarray, right: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Overlaps of all sets of one side with all of the other.

    ``values`` are the shingles of both, ``left`` and ``right`` the number of the set on each side, -1
    where it is not on that side.
    """
    overlap = np.zeros(shape, dtype=np.int64)
    order = np.argsort(values, kind="stable")
    values, left, right = values[order], left[order], right[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    starts = np.flatnonzero(new)
    length = np.diff(np.append(starts, len(values)))
    # short lists: each pair of their sets counts one
    for n in range(1 if (left[right >= 0] >= 0).any() else 2, SHORT + 1):
        at = starts[length == n][:, None] + np.arange(n)
        if len(at):
            a, b = np.broadcast_arrays(left[at][:, :, None], right[at][:, None, :])
            both = (a >= 0) & (b >= 0)
            np.add.at(overlap, (a[both], b[both]), 1)
    # long lists: columns of 0 and 1
    long = np.flatnonzero(length > SHORT)
    for some in (long[k : k + COLUMNS] for k in range(0, len(long), COLUMNS)):
        place = np.concatenate([np.arange(starts[i], starts[i] + length[i]) for i in some])
        column = np.repeat(np.arange(len(some)), length[some])
        x, y = np.zeros((shape[0], len(some)), dtype=np.float32), np.zeros((shape[1], len(some)), dtype=np.float32)
        on = left[place] >= 0
        x[left[place][on], column[on]] = 1
        on = right[place] >= 0
        y[right[place][on], column[on]] = 1
        # a product counts at most COLUMNS shingles, which is exact; sums of any size are whole numbers
        overlap += (x @ y.T).astype(np.int64)
    return overlap


def alike(overlap: np.ndarray, sizes: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of the given sizes are linked, for a table of overlaps; in whole numbers of any size."""
    return 100 * overlap >= percent * (sizes[:, None] + others[None, :] - overlap)


def forest(links: np.ndarray) -> np.ndarray:
    """Root of each node of a symmetric table of links."""
    root = np.full(len(links), -1)
    for i in range(len(links)):
        if root[i] < 0:
            front = np.zeros(len(links), dtype=bool)
            front[i] = True
            while front.any():
                root[front] = i
                front = links[front].any(axis=0) & (root < 0)
    return root


def compare(percent: int, give: str = "forest"):
    """Links between two blocks, or within one.

    ``give`` is "forest" for a spanning forest (a, b); "counts" for that and, with b missing, the number n
    of rows linked to each set a; "pairs" for all linked pairs (a, b) with their overlap n. Counts and pairs
    leave out what also meets under a lower head.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        nodes = group["node"].to_numpy(dtype=np.int64)
        sets = group["shingles"].tolist()
        sizes = np.array([len(s) for s in sets])
        second = group["second"].to_numpy(dtype=bool)
        within = int(group["low"].iloc[0]) == int(group["high"].iloc[0])
        one, two = (np.arange(len(sets)),) * 2 if within else (np.flatnonzero(~second), np.flatnonzero(second))
        left, right = np.full(len(sets), -1), np.full(len(sets), -1)
        left[one], right[two] = np.arange(len(one)), np.arange(len(two))
        values = np.concatenate(sets)
        overlap = shared_counts(values, np.repeat(left, sizes), np.repeat(right, sizes), (len(one), len(two)))
        linked = alike(overlap, sizes[one], sizes[two], percent)
        if give != "forest":
            head = int(group["head"].iloc[0])
            lower = [h[h < head] for h in group["heads"]]
            numbers = [len(h) for h in lower]
            counted = linked.copy()
            if any(numbers):
                counted &= shared_counts(np.concatenate(lower), np.repeat(left, numbers), np.repeat(right, numbers), linked.shape) == 0
            if within:
                np.fill_diagonal(counted, False)
        if give == "pairs":
            i, j = np.nonzero(np.triu(counted) if within else counted)
            return pd.DataFrame({"a": nodes[one[i]], "b": nodes[two[j]], "n": overlap[i, j]})
        links = np.zeros((len(sets), len(sets)), dtype=bool)
        links[np.ix_(one, two)] = linked
        links |= links.T
        root = forest(links)
        child = np.flatnonzero(root != np.arange(len(root)))
        found = pd.DataFrame({"a": nodes[child], "b": nodes[root[child]]})
        if give == "forest":
            return found
        n, weights = np.zeros(len(sets), dtype=np.int64), group["weight"].to_numpy(dtype=np.int64)
        n[one] += counted @ weights[two]
        if not within:
            n[two] += weights[one] @ counted
        some = np.flatnonzero(n)
        counts = pd.DataFrame({"a": nodes[some], "n": n[some]})
        return pd.concat([found.astype("Int64"), counts.astype("Int64")]).reindex(columns=["a", "b", "n"]).astype("Int64")

    return run


def meeting_blocks(sets: DataFrame, percent: int, weights: DataFrame | None = None):
    """The sets of each two blocks that are compared; with all heads of a set if ``weights`` are given."""
    met = meetings(merged_lists(sets, percent))
    facts = sets.select("node", "shingles")
    if weights is not None:
        facts = facts.join(met.groupBy("node").agg(F.collect_list("head").alias("heads")), "node").join(weights, "node")
    return block_pairs(met).join(facts, "node").groupBy("head", "low", "high")


def classes(sets: DataFrame, percent: int, weights: DataFrame | None = None) -> DataFrame:
    """``node`` and ``root`` (the lowest node of its component) for every set.

    ``weights`` has the number of rows (``weight``) of each node; with it, ``links`` is the number of
    other rows that a row of the node is linked with.
    """
    blocks = meeting_blocks(sets, percent, weights)
    if weights is None:
        joined = components(blocks.applyInPandas(compare(percent), "a bigint, b bigint"))
        return sets.select("node").join(joined, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    found = materialize(blocks.applyInPandas(compare(percent, "counts"), "a bigint, b bigint, n bigint"), "links")
    joined = components(found.filter("b IS NOT NULL").select("a", "b"))
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    links = F.coalesce("n", F.lit(0)) + F.col("weight") - 1
    return weights.join(joined, "node", "left").join(counts, "node", "left").select("node", F.coalesce("root", "node").alias("root"), links.alias("links"))


def text_key(text: str) -> Column:
    """Name of a text; a missing one counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def stored_sets(docs: DataFrame, text: str, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes of the sets of distinct texts; the node of each that may have a partner; the sets of the nodes."""
    key = text_key(text)
    texts = docs.filter(F.col(text).isNotNull()).select(key.alias("key"), F.col(text).alias("text"))

    facts = materialize(occurrence_filter(texts, words, percent), "facts")
    hopeful = broadcast_if_small(facts.filter("open").select("key"))
    stored = materialize(sets_of(texts.join(hopeful, "key"), words), "sets")
    # eight of the sixteen bytes name a set, if that is unambiguous
    sizes = stored.agg(F.count_distinct("digest").alias("n"), *(F.count_distinct(F.substring("digest", at, 8)).alias(f"at_{at}") for at in (1, 9))).first()
    at = next((x for x in (1, 9) if sizes[f"at_{x}"] == sizes["n"]), None)
    if at is None:
        raise ValueError("two different sets have the same name")
    node = F.conv(F.hex(F.substring("digest", at, 8)), 16, -10).cast("bigint")
    stored = stored.withColumn("node", node)
    sets = materialize(stored.select("node", "shingles").dropDuplicates(["node"]), "nodes")
    return facts, stored.select("key", "node").distinct(), sets


def classes_by_text(docs: DataFrame, doc_id: str, text: str, words: int, percent: int, links: bool = False) -> DataFrame:
    """Per distinct text its key, the size of its set, the smallest id of its class and the class's name.

    With ``links`` also the number of other rows that a row of the text is linked with.
    """
    key = text_key(text)
    facts, stored, sets = stored_sets(docs, text, words, percent)
    low = materialize(docs.select(key.alias("key"), F.col(doc_id).alias("id")).groupBy("key").agg(F.min("id").alias("low"), F.count("*").alias("copies")), "low")
    weights = None
    if links:
        weights = materialize(stored.join(low, "key").groupBy("node").agg(F.sum("copies").alias("weight")), "weights")
    rooted = classes(sets, percent, weights)

    counted = ["links"] if links else []
    members = stored.join(rooted, "node").join(low, "key").select("key", "root", "low", *counted)
    members = materialize(members, "members")
    lowest = materialize(members.groupBy("root").agg(F.min("low").alias("lowest"), F.min("key").alias("first")), "lowest")
    named = members.join(lowest, "root").select("key", "lowest", "first", *counted)
    known = low.join(facts.select("key", "n"), "key", "left").join(named, "key", "left")
    known = known.select(
        F.col("key").alias("_key_"), F.coalesce("n", F.lit(0)).cast("long").alias("_n_"),
        F.when(F.col("first").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("_component_"), F.coalesce("first", "key").alias("_class_"),
        # a text without a partner is linked with its copies, if it has a word
        *(F.when(F.col("n") > 0, F.coalesce(c, F.col("copies") - 1)).otherwise(F.lit(0)).cast("long").alias("_links_") for c in counted),
    )
    return materialize(known, "known")


def near_duplicate_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE, percent: int = PERCENT,
    size: str = "n_shingles", component: str = "component_id", keep: Sequence[str] | None = None, links: str | None = "n_links",
) -> DataFrame:
    """Add to each document the size of its shingle set, the smallest id reachable by links, and their number.

    The number counts the other rows that the document itself is linked with, copies included; no
    column is added, and links are not counted, if ``links`` is None.

    Words are what white space parts, with A-Z in lower case. A missing or empty text has no set and
    is linked with nothing: its component is its own id. Rows with the same text or the same set are
    linked, however many there are; a missing id never names a component that has another id. Columns
    named like the added ones are replaced.
    """
    kept = columns_besides(docs, (size, component, *([links] if links else [])), keep)
    known = classes_by_text(docs, doc_id, text, words, percent, links is not None)
    found = docs.select(*kept, text_key(text).alias("_key_"), F.col(doc_id).alias("_id_")).join(known, "_key_", "left")
    named = F.when(F.col("_n_") > 0, F.col("_component_")).otherwise(F.col("_id_"))
    return found.select(*kept, F.col("_n_").alias(size), named.alias(component), *([F.col("_links_").alias(links)] if links else []))


def near_duplicate_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """All links between different sets: the smallest ids of both, and how many shingles they share.

    Each pair is listed once, as ``low_id``, ``high_id`` and ``n_shared``; documents with equal sets stand
    as one. In a group of near copies the number of pairs grows with the square of its size.
    """
    _, stored, sets = stored_sets(docs, text, words, percent)
    ids = docs.select(text_key(text).alias("key"), F.col(doc_id).alias("id"))
    ids = materialize(stored.join(ids, "key").groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("weight")), "ids")
    pairs = meeting_blocks(sets, percent, ids.select("node", "weight")).applyInPandas(compare(percent, "pairs"), "a bigint, b bigint, n bigint")
    for side in ("a", "b"):
        pairs = pairs.join(ids.select(F.col("node").alias(side), F.col("id").alias(f"{side}_id")), side)
    turned = F.col("b_id") < F.col("a_id")
    low, high = F.when(turned, F.col("b_id")).otherwise(F.col("a_id")), F.when(turned, F.col("a_id")).otherwise(F.col("b_id"))
    return pairs.select(low.alias("low_id"), high.alias("high_id"), F.col("n").alias("n_shared"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of every group of near duplicates: the one with the smallest id, if any has one.

    Rows without a word are in no group and stay. What goes is worked out on ids and keys of texts, so
    that texts only move if very many rows go.
    """
    key = text_key(text)
    rows = docs.select(key.alias("_key_"), F.col(doc_id).alias("_id_")).groupBy("_key_", "_id_").agg(F.count("*").alias("_rows_"))
    judged = materialize(rows, "rows").join(classes_by_text(docs, doc_id, text, words, percent), "_key_")
    stays = (F.col("_n_") == 0) | F.col("_id_").eqNullSafe(F.col("_component_"))
    judged = materialize(judged.withColumn("_stays_", stays), "judged")

    def without(df: DataFrame, listed: DataFrame, how: str = "left_anti") -> DataFrame:
        same = (F.col("_key_") == key) & F.col("_id_").eqNullSafe(F.col(doc_id))
        return df.join(broadcast_if_small(listed.select("_key_", "_id_")), same, how)

    first = without(docs, judged.filter("NOT _stays_"))
    # only rows with a repeated id, or classes without ids, leave several
    several = judged.filter("_stays_ AND _n_ > 0").groupBy("_class_").agg(F.sum("_rows_").alias("n")).filter("n > 1").select("_class_")
    several = materialize(judged.filter("_stays_").join(several, "_class_", "left_semi"), "several")
    if not several.limit(1).count():
        return first
    order = Window.partitionBy("_class_").orderBy(F.xxhash64(*docs.columns))
    marked = docs.withColumn("_text_key_", key).join(
        several.select("_key_", "_id_", "_class_"), (F.col("_key_") == F.col("_text_key_")) & F.col("_id_").eqNullSafe(F.col(doc_id))
    )
    chosen = marked.withColumn("_place_", F.row_number().over(order)).filter("_place_ = 1")
    return without(first, several).unionByName(chosen.select(docs.columns))
