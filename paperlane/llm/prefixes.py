"""The prefix trie of conversations, built as burst tries.

A turn is known by the hash of its role and text, and a prefix by a hash of its turns, so that neither
texts nor whole conversations travel. Equal conversations become one sequence with a number of copies.
A sequence is a table of rows, one per turn, so that one of any length can be spread over tasks.

All sequences start in one container below the root. A container is too large if more turns lie in it
than a task should hold; such a one bursts: its top becomes a head of the trie, and its sequences are
dealt to new containers by their next turn. This goes on level by level until all containers are small.
Each shard holds many containers; a container's sequences are sorted, and one sweep over them finds its
nodes, as neighbours share their longest common prefix. What lies under a head is summed from the
containers below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlane.llm.numbering import numbered
from paperlane.llm.sizes import broadcast_within
from paperlane.session import materialize

CONTAINER_TURNS = 50_000
SPAN = 4096  # turns of one conversation that one task adds up
HISTORY = 6  # a conversation takes fewer turns than this from the one it follows
FAMILY = 100
CHUNK_IDS = 50_000
ROOT = b""  # the prefix without turns
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_rows(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` from 0, ``turn_id``, ``chars`` and ``own`` (turns of the conversation) of
    each turn. Turns with equal numbers come in the order of their hashes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length of the role tells where the text starts
    turn_id = F.md5(F.concat_ws(":", F.char_length(role).cast("string"), role, text).cast("binary"))
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", F.unhex(turn_id).alias("turn_id"), F.char_length(text).cast("long").alias("chars"),
    )
    rows = numbered(rows, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_id")], "_number_", "turns")
    first = rows.groupBy(F.col("conv_id").alias("_conv_")).agg(F.min("_number_").alias("_first_"), F.count("*").alias("own"))
    rows = rows.join(first, F.col("conv_id") == F.col("_conv_"))
    return rows.select("conv_id", (F.col("_number_") - F.col("_first_")).alias("pos"), "turn_id", "chars", "own")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rebuilt conversations (``conv_id``, ``turns``) and their turns (``conv_id``, ``depth`` from 1,
    ``turn_id``, ``chars``)."""
    rows = materialize(turn_rows(turns), "positions")
    convs = rows.filter("pos = 0").select("conv_id", "own")
    wanted = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HISTORY).alias("wanted")
    convs = convs.select("conv_id", "own", wanted, (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("before"))
    older = convs.select(F.col("conv_id").alias("before"), F.col("own").alias("older"))
    convs = convs.join(older, "before", "left")
    taken = F.least("wanted", F.coalesce("older", F.lit(0)))
    kept = F.greatest(F.col("own") - F.col("wanted"), F.lit(0))
    convs = convs.select("conv_id", "before", "wanted", taken.alias("taken"), (taken + kept).alias("turns"))
    convs = materialize(convs, "rebuilt")

    heads = rows.filter((F.col("pos") < HISTORY - 1) & (F.col("conv_id") % FAMILY == 0)).select(F.col("conv_id").alias("before"), "pos", "turn_id", "chars")
    heads = heads.join(convs.filter("taken > 0"), "before").filter("pos < taken")
    heads = heads.select("conv_id", (F.col("pos") + 1).alias("depth"), "turn_id", "chars")
    # few conversations have fewer turns than they drop, so most rows pass
    tails = rows.join(convs.select("conv_id", "wanted", "taken"), "conv_id").filter("pos >= wanted")
    tails = tails.select("conv_id", (F.col("pos") - F.col("wanted") + F.col("taken") + 1).alias("depth"), "turn_id", "chars")
    return convs.select("conv_id", "turns"), heads.unionByName(tails)


def with_prefixes(rows: DataFrame) -> DataFrame:
    """Add ``prefix`` and ``parent``, 128-bit hashes of the turns up to each one and up to the one before.

    A prefix is hashed from two sums over its turns of a hash of turn and place. Sums of spans of a
    conversation are added up first, so a task handles one span and not a whole conversation.
    """
    hashes = (F.xxhash64("turn_id", "depth"), F.xxhash64("depth", "turn_id", F.lit("second")))
    rows = rows.withColumns({f"_x{i}": h.cast("decimal(20,0)") for i, h in enumerate(hashes)})
    rows = rows.withColumn("_span", F.expr(f"(depth - 1) div {SPAN}"))
    inside = Window.partitionBy("conv_id", "_span").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("conv_id", "_span").agg(*(F.sum(f"_x{i}").alias(f"_s{i}") for i in (0, 1)))
    spans = spans.select("conv_id", "_span", *(F.coalesce(F.sum(f"_s{i}").over(earlier), F.lit(0)).alias(f"_b{i}") for i in (0, 1)))
    sums = rows.select("*", *(F.sum(f"_x{i}").over(inside).alias(f"_u{i}") for i in (0, 1))).join(spans, ["conv_id", "_span"])

    def key(depth: Column, *of: Column) -> Column:
        parts = [depth.cast("string"), *(x.cast("decimal(38,0)").cast("string") for x in of)]
        return F.when(depth > 0, F.unhex(F.md5(F.concat_ws(":", *parts).cast("binary")))).otherwise(F.lit(ROOT))

    upto = [F.col(f"_b{i}") + F.col(f"_u{i}") for i in (0, 1)]
    before = [u - F.col(f"_x{i}") for i, u in enumerate(upto)]
    return sums.select("conv_id", "depth", "chars", key(F.col("depth"), *upto).alias("prefix"), key(F.col("depth") - 1, *before).alias("parent"))


def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of the same end, joined to texts of a bounded number of ids."""
    last, ids, out = None, [], []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["end", "first", "copies", "ids"])

    for batch in batches:
        for end, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (end != last or len(ids) == CHUNK_IDS):
                out.append((last, ids[0], len(ids), ",".join(map(str, ids))))
                ids = []
            last = end
            ids.append(conv)
        # a chunk goes on into the next batch
        if out:
            yield batch_of(out)
            out = []
    if ids:
        yield batch_of([(last, ids[0], len(ids), ",".join(map(str, ids)))])


def digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per end from its sorted chunks; what is held is the state of one digest."""
    last, state, first, copies, out = None, None, 0, 0, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["end", "conv_id", "copies", "ends_sha256"])

    for batch in batches:
        for end, start, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is not None and end == last:
                state.update(b",")
            else:
                if state is not None:
                    out.append((last, first, copies, state.hexdigest()))
                last, state, first, copies = end, hashlib.sha256(), start, 0
            state.update(ids.encode())
            copies += n
        if out:
            yield batch_of(out)
            out = []
    if state is not None:
        yield batch_of([(last, first, copies, state.hexdigest())])


def sequences(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """Distinct conversations: ``end`` (their whole prefix, empty for none), ``conv_id`` (the smallest), ``copies``, ``ends_sha256``.

    The ids of a large group of copies are sorted by range and joined in chunks by many tasks; only the
    chunks of a group, which the digest has to read in order, come to one task, one at a time.
    """
    ended = convs.filter("turns > 0").join(rows, (convs["conv_id"] == rows["conv_id"]) & (convs["turns"] == rows["depth"]))
    ended = ended.select(rows["prefix"].alias("end"), convs["conv_id"])
    ended = ended.unionByName(convs.filter("turns = 0").select(F.lit(ROOT).alias("end"), "conv_id"))
    dealt = ended.repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    chunks = dealt.mapInArrow(join_ids, "end binary, first bigint, copies bigint, ids string")
    chunks = chunks.repartition(F.col("end")).sortWithinPartitions("end", "first")
    return chunks.mapInArrow(digest_ids, "end binary, conv_id bigint, copies bigint, ends_sha256 string")


class Node:
    __slots__ = ("depth", "row", "parent", "conv", "convs", "children", "leaves", "saved")

    def __init__(self, depth: int, row: tuple, parent: Node | None):
        self.depth, self.row, self.parent = depth, row, parent
        self.conv, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0


FACTS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SWEPT = "above binary, " + ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'bigint'}" for c in FACTS)


def sweep(found: list[tuple]) -> list[Node]:
    """Nodes of one container, from its rows (conv_id, copies, depth, prefix, chars, ends) in order of
    conversation and depth.

    The sequences are sorted, so those under a node follow each other. A node is left when the next
    sequence parts from it, and then hands its sums to its parent.
    """
    held: dict[int, list[tuple]] = {}
    for row in found:
        held.setdefault(row[0], []).append(row)
    order = sorted(held.values(), key=lambda rows: [r[3] for r in rows])
    nodes: list[Node] = []
    path: list[Node] = []

    def leave() -> None:
        node = path.pop()
        node.leaves = node.leaves or 1
        node.saved += (node.convs - 1) * node.row[4]
        if path:
            up = path[-1]
            up.convs += node.convs
            up.conv = node.conv if up.conv is None else min(up.conv, node.conv)
            up.leaves += node.leaves
            up.saved += node.saved

    for rows in order:
        shared = 0
        while shared < min(len(path), len(rows)) and path[shared].row[3] == rows[shared][3]:
            shared += 1
        while len(path) > shared:
            leave()
        for row in rows[shared:]:
            up = path[-1] if path else None
            if up is not None:
                up.children += 1
            path.append(Node(row[2], row, up))
            nodes.append(path[-1])
        # the sequence ends in the last node, which its first holder may have passed through
        end = path[-1]
        end.convs += rows[0][1]
        end.conv = rows[0][0] if end.conv is None else min(end.conv, rows[0][0])
        end.row = rows[-1]
    while path:
        leave()
    return nodes


def sweep_containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the containers of a shard, whose rows come together and in order. Only tops know what is above."""
    last, above, over, rows = None, None, None, []

    def swept() -> pa.RecordBatch:
        out = [
            (
                None if n.parent else above, n.conv, n.depth, n.parent.conv if n.parent else over,
                n.convs, n.children, n.leaves, n.saved, n.row[5] or NOTHING,
            )
            for n in sweep(rows)
        ]
        kinds = (pa.binary(), *[pa.int64()] * 7, pa.string())
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["above", *FACTS])

    ready: list[pa.RecordBatch] = []
    for batch in batches:
        for container, up, parent_conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and container != last:
                ready.append(swept())
                rows = []
            last, above, over = container, up, parent_conv
            rows.append(tuple(row))
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
            ready = []
    if rows:
        yield swept()


class Burst:
    """Heads of the trie and the containers below them."""

    def __init__(self, rows: DataFrame, ends: DataFrame, most: int):
        """``rows`` has a row per turn of each distinct sequence: conv_id, copies, turns, depth, prefix,
        parent, chars and, for its last turn, ends."""
        self.rows, self.most = rows, most
        self.heads = self._burst(ends)

    def _burst(self, ends: DataFrame) -> DataFrame:
        """The root, and all prefixes under which more turns lie than a container may hold.

        Containers burst by their next turn, level by level. The levels of a round double, as a chain of
        turns that one large group shares would take a round each. A level without a container that is
        too large is the last, since no deeper one holds more.
        """
        at_root = F.max(F.when(F.col("end") == F.lit(ROOT), F.col("ends_sha256")))
        heads = ends.agg(
            F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("prefix"), F.lit(None).cast("binary").alias("parent"),
            F.sum("copies").alias("n_convs"), F.min("conv_id").alias("head_conv"), F.lit(0).cast("long").alias("chars"), at_root.alias("ends"),
        ).filter("n_convs IS NOT NULL")
        begin, width = 0, 1
        while True:
            level = self.rows.filter((F.col("depth") > begin) & (F.col("depth") <= begin + width))
            sums = level.groupBy("depth", "prefix", "parent").agg(
                F.sum(F.col("turns") - F.col("depth") + 1).alias("below"), F.sum("copies").alias("n_convs"),
                F.min("conv_id").alias("head_conv"), F.max("chars").alias("chars"), F.max("ends").alias("ends"),
            )
            found = materialize(sums.filter(F.col("below") > self.most).drop("below"), "heads")
            heads = heads.unionByName(found)
            begin, width = begin + width, 2 * width
            if not found.filter(F.col("depth") == begin).limit(1).count():
                return materialize(heads, "heads")

    def known(self, *columns: str) -> DataFrame:
        """Heads for a join with rows: a head of many rows is sent along or leaves these to be split."""
        return broadcast_within(self.heads.select("prefix", *columns))

    def containers(self) -> DataFrame:
        """All rows below the heads, with their ``container`` and the prefix and conversation of the head ``above`` it."""
        last = self.heads.agg(F.max("depth")).first()[0] or 0
        first_rows = self.rows.filter("depth = 1").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("prefix"))
        inside = self.rows.filter(F.col("depth") <= last).select("conv_id", "depth", "prefix").unionByName(first_rows)
        inside = inside.join(self.known("head_conv"), "prefix")
        # the head under which a sequence leaves the heads
        under = inside.groupBy("conv_id").agg(F.max(F.struct("depth", "head_conv")).alias("_head_"))
        rows = self.rows.join(under, "conv_id").filter("depth > _head_.depth")
        tops = rows.filter("depth = _head_.depth + 1")
        tops = tops.select(F.col("conv_id").alias("_conv_"), F.col("prefix").alias("container"), F.col("parent").alias("above"))
        return rows.withColumn("over", F.col("_head_.head_conv")).join(tops, F.col("conv_id") == F.col("_conv_"))

    def swept(self) -> DataFrame:
        """All nodes below the heads."""
        names = ["container", "above", "over", "conv_id", "copies", "depth", "prefix", "chars", "ends"]
        # a container has a bounded number of rows, and a shard many containers
        shards = self.containers().select(*names).repartition(F.col("container"))
        return shards.sortWithinPartitions("container", "conv_id", "depth").mapInArrow(sweep_containers, SWEPT)

    def head_nodes(self, swept: DataFrame) -> DataFrame:
        """Nodes of the heads, with sums over all that lies below.

        Every node belongs to its smallest conversation, whose own nodes are the lower end of its path. So
        what a conversation adds to a head on its path is the sum over its own nodes from there on:
        those of its container come as one sum, those among the heads are added up along the path.
        """
        tops = swept.filter("above IS NOT NULL")
        first_rows = self.rows.filter("depth = 1").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("prefix"))
        path = self.rows.select("conv_id", "depth", "prefix").unionByName(first_rows)
        path = path.join(self.known("head_conv", "n_convs", "chars"), "prefix")
        path = path.join(tops.select("conv_id", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")), "conv_id", "left")
        mine = F.when(F.col("conv_id") == F.col("head_conv"), (F.col("n_convs") - 1) * F.col("chars")).otherwise(0)
        deeper = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
        path = path.select("prefix", "leaves", (F.coalesce("saved", F.lit(0)) + F.sum(mine).over(deeper)).alias("saved"))
        sums = path.groupBy("prefix").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        children = tops.select(F.col("above").alias("prefix")).unionByName(self.heads.filter("depth > 0").select(F.col("parent").alias("prefix")))
        children = children.groupBy("prefix").agg(F.count("*").alias("children"))
        over = self.heads.select(F.col("prefix").alias("parent"), F.col("head_conv").alias("over"))
        found = self.heads.join(sums, "prefix", "left").join(children, "prefix", "left").join(over, "parent", "left")
        none = F.lit(0).cast("long")
        # a root without children is a leaf; other heads have children, as sequences are distinct
        return found.select(
            F.col("head_conv").alias("conv_id"), "depth", F.col("over").alias("parent_conv_id"), "n_convs",
            F.coalesce("children", none).alias("n_children"), F.greatest(F.coalesce("leaves", none), none + 1).alias("n_leaves"),
            F.coalesce("saved", none).alias("saved_tokens"), F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
        )


def prefix_trie(turns: DataFrame, most: int = CONTAINER_TURNS) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations; columns are listed in ``FACTS``.

    ``turns`` has conv_id, turn, role and text; other columns are not read. A missing role or text is
    empty; rows without conv_id belong to no conversation and are left out. A missing turn comes first;
    turns with equal numbers come in the order of a hash of role and text, so repeated rows are turns of
    their own. A conversation that has no turns left ends in the root. Without conversations there are no
    nodes, not even a root. ``most`` bounds the turns that a task holds at once and changes no result.
    """
    convs, rows = rebuilt(turns)
    prefixes = materialize(with_prefixes(rows), "prefixes")
    ends = materialize(sequences(convs, prefixes), "ends")
    kept = ends.filter(F.octet_length("end") > 0).join(convs.select("conv_id", "turns"), "conv_id")
    unique = prefixes.join(kept.select("conv_id", "copies", "turns", "ends_sha256"), "conv_id")
    unique = unique.withColumn("ends", F.when(F.col("depth") == F.col("turns"), F.col("ends_sha256"))).drop("ends_sha256")
    burst = Burst(materialize(unique, "sequences"), ends, most)
    swept = materialize(burst.swept(), "swept")
    return swept.select(*FACTS).unionByName(burst.head_nodes(swept))
