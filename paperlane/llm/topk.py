"""Exact search for the highest inner products with a bit-sliced index.

Vectors of whole numbers are stored in blocks; of each component a block keeps one bitmap per binary
digit. The inner products of a query with all vectors of a block are added up by bitmap arithmetic:
every digit of the query shifts the digits of the component (inverted for a negative one), and carry
save adders reduce the bitmaps of equal weight until one per digit of the sum is left. The highest
sums are then selected from the most significant digit downward; of the vectors on the boundary, all
equal by then, the smallest ids are taken. Blocks of queries meet blocks of vectors, and only the
best of each block go on.

Vectors with large components lie in blocks of their own, which have up to 64 digits; where a sum
could need more than 64 bits, it is put together as a Python integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlane.llm.tasks import rows_per_batch
from paperlane.session import materialize

SCALE, TOP = 64, 20
BLOCK_ROWS, LEAST_BLOCKS = 16_384, 8
QUERY_ROWS, QUERIES_AT_ONCE = 256, 16
LARGE = 1 << 27  # from here on components make a block with more digits, so they get blocks of their own
LONG = 1 << 63


def whole_numbers(vector: Column, scale: int) -> Column:
    """Components times ``scale``, rounded down; NULL for a vector that takes no part."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))

    def whole(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * scale)
        fits = (x.cast("double") * scale >= float(-LONG)) & (x.cast("double") * scale < float(LONG))
        return F.when(fits, scaled.cast("bigint")).otherwise(F.raise_error(F.lit("a component times the scale does not fit a long")).cast("bigint"))

    return F.when(good, F.transform(vector, whole))


def as_matrix(vectors) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def build_block(group: pd.DataFrame) -> pd.DataFrame:
    """Index of a block: ids in order, least component values, and the bitmaps of all digits."""
    group = group.sort_values("id")
    values = as_matrix(group["vector"].tolist())
    low = values.min(axis=0)
    # modulo 2^64, so that any difference of two longs is right
    raised = values.view(np.uint64) - low.view(np.uint64)
    digits = max(1, int(raised.max(initial=0)).bit_length())
    padded = np.zeros((-(-len(raised) // 64) * 64, raised.shape[1]), dtype=np.uint64)
    padded[: len(raised)] = raised
    slices = [np.packbits((padded >> np.uint64(b) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little") for b in range(digits)]
    return pd.DataFrame({
        "block": [int(group["block"].iloc[0])], "ids": [group["id"].to_numpy(dtype=np.int64).tobytes()],
        "low": [low.tobytes()], "digits": [digits], "slices": [b"".join(s.tobytes() for s in slices)],
    })


def add_up(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Digits of the sums of bitmaps; ``columns[k]`` holds the bitmaps of weight 2^k by query."""
    digits, k = [], 0
    while k < len(columns):
        column = columns[k]
        while column.shape[1] > 1:
            n = column.shape[1] // 3
            if n:
                a, b, c = column[:, :n], column[:, n : 2 * n], column[:, 2 * n : 3 * n]
                either = a ^ b
                total, carry = either ^ c, (a & b) | (either & c)
                rest = column[:, 3 * n :]
            else:
                a, b = column[:, :1], column[:, 1:2]
                total, carry, rest = a ^ b, a & b, column[:, 2:]
            column = np.concatenate([total, rest], axis=1) if rest.shape[1] else total
            if k + 1 == len(columns):
                columns.append(carry)
            else:
                columns[k + 1] = np.concatenate([columns[k + 1], carry], axis=1)
        digits.append(column[:, 0] if column.shape[1] else np.zeros(column.shape[::2], dtype=np.uint64))
        k += 1
    return digits


def highest(digits: list[np.ndarray], rows: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest sums among the rows of a bitmap; of equal ones the first."""
    sure, open_ = np.zeros_like(rows), rows
    if int(np.bitwise_count(rows).sum()) > top:
        for digit in reversed(digits):
            more = sure | (open_ & digit)
            n = int(np.bitwise_count(more).sum())
            if n > top:
                open_ = open_ & digit
            else:
                sure, open_ = more, open_ & ~digit
                if n == top:
                    break
    places = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    missing = top - len(places)
    if missing > 0:
        places = np.append(places, np.flatnonzero(np.unpackbits(open_.view(np.uint8), bitorder="little"))[:missing])
    return places


class Block:
    """A stored block, ready for queries."""

    def __init__(self, ids: bytes, low: bytes, digits: int, slices: bytes):
        self.ids, self.low, self.digits = np.frombuffer(ids, dtype=np.int64), np.frombuffer(low, dtype=np.int64), digits
        width = len(self.low)
        words = -(-len(self.ids) // 64)
        plain = np.frombuffer(slices, dtype=np.uint64).reshape(digits * width, words)
        # then the inverted bitmaps, and an empty one
        self.bitmaps = np.concatenate([plain, ~plain, np.zeros((1, words), dtype=np.uint64)])
        everyone = np.zeros(words * 64, dtype=np.uint8)
        everyone[: len(self.ids)] = 1
        self.rows = np.packbits(everyone, bitorder="little").view(np.uint64)

    def search(self, ids: np.ndarray, queries: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query its id, and the ids and scores of the highest vectors of the block.

        A score below all longs is None. One above all would be among the best, so it is an error.
        """
        width = len(self.low)
        q = np.zeros((len(queries), width), dtype=np.int64)
        q[:, : min(width, queries.shape[1])] = queries[:, :width]
        size, negative = np.abs(q).view(np.uint64), q < 0
        bits = max(1, int(size.max(initial=0)).bit_length())
        low_bits = int(np.abs(self.low).view(np.uint64).max(initial=0)).bit_length()
        wide = bits + max(self.digits, low_bits) + width.bit_length() > 61
        number = object if wide else np.int64
        # sums count a raised component, and for a negative factor what it lacks of the largest number
        offset = (q.astype(number) * self.low.astype(number)).sum(axis=1)
        offset = offset - (size.astype(number) * negative).sum(axis=1) * ((1 << self.digits) - 1)
        columns = []
        for k in range(bits + self.digits - 1):
            chosen: list[list[int]] = [[] for _ in q]
            for i in range(max(0, k - self.digits + 1), min(bits, k + 1)):
                for row, d in zip(*np.nonzero(size >> np.uint64(i) & np.uint64(1))):
                    chosen[row].append((k - i + negative[row, d] * self.digits) * width + d)
            most = max(map(len, chosen), default=0)
            index = np.full((len(q), most), len(self.bitmaps) - 1)
            for row, own in zip(index, chosen, strict=True):
                row[: len(own)] = own
            columns.append(self.bitmaps[index])
        digits = add_up(columns)
        for i, own in enumerate(ids.tolist()):
            rows = self.rows.copy()
            for at in range(np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, "right")):
                rows[at // 64] &= ~(np.uint64(1) << np.uint64(at % 64))
            mine = [d[i] for d in digits]
            places = highest(mine, rows, top)
            word, bit = places // 64, (places % 64).astype(np.uint64)
            scores = sum(((d[word] >> bit) & np.uint64(1)).astype(number) * (1 << k) for k, d in enumerate(mine)) + offset[i]
            if wide:
                if max(scores, default=0) >= LONG:
                    raise OverflowError(f"a score of the query {own} does not fit a long")
                scores = np.array([x if x >= -LONG else None for x in scores], dtype=object)
            yield own, self.ids[places], scores


def search_pairs(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["ids"], row["low"], row["digits"], row["slices"])
                ids, queries = np.frombuffer(row["query_ids"], dtype=np.int64), np.frombuffer(row["queries"], dtype=np.int64)
                queries = queries.reshape(len(ids), -1)
                for at in range(0, len(ids), QUERIES_AT_ONCE):
                    some = slice(at, at + QUERIES_AT_ONCE)
                    found = list(block.search(ids[some], queries[some], top))
                    owner = np.repeat([q for q, _, _ in found], [len(x) for _, x, _ in found])
                    names, scores = (np.concatenate([x[i] for x in found]) for i in (1, 2))
                    columns = [*(pa.array(x.astype(np.int64)) for x in (owner, names)), pa.array(scores, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    return run


def pack_queries(group: pd.DataFrame) -> pd.DataFrame:
    values = as_matrix(group["vector"].tolist())
    return pd.DataFrame({"part": [int(group["part"].iloc[0])], "query_ids": [group["id"].to_numpy(dtype=np.int64).tobytes()], "queries": [values.tobytes()]})


def top_inner_products(
    vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", top: int = TOP, scale: int = SCALE,
) -> DataFrame:
    """The ``top`` highest inner products of each query with all rows but its own.

    Components times ``scale`` are rounded down to whole numbers, products are exact. Returns
    ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``; ties go to the smaller id. Rows without
    an id, and vectors that are missing or hold a missing, infinite or undefined component, take no
    part. A whole number or a score of the result that does not fit a long is an error. Shorter
    vectors count as filled up with zeros. Of repeated query ids the least vector asks; repeated
    other rows all answer.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), whole_numbers(F.col(vector), scale).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.filter("id IS NOT NULL AND vector IS NOT NULL")
    large = F.exists("vector", lambda x: (x >= LARGE) | (x <= -LARGE))
    sizes = rows.agg(
        F.count_if(~large).alias("n"), F.count_if(large).alias("large"),
        F.count_if(F.col("asks") & ~large).alias("queries"), F.count_if(F.col("asks") & large).alias("large_queries"),
    ).first()

    def place(key: Column, usual: int, more: int) -> Column:
        """Number of a group; those with large components come after the others."""
        own = F.pmod(key, F.lit(usual))
        return (F.when(large, usual + F.pmod(key, F.lit(more))).otherwise(own) if more else own).cast("int")

    usual, more = max(LEAST_BLOCKS, -(-sizes["n"] // BLOCK_ROWS)), -(-sizes["large"] // BLOCK_ROWS)
    some, others = max(1, -(-sizes["queries"] // QUERY_ROWS)), -(-sizes["large_queries"] // QUERY_ROWS)
    blocks, parts = usual + more, some + others

    spread = rows.select(place(F.xxhash64("id", "vector"), usual, more).alias("block"), "id", "vector")
    index = spread.groupBy("block").applyInPandas(build_block, "block int, ids binary, low binary, digits int, slices binary")
    asked = rows.filter("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    asked = asked.select(place(F.xxhash64("id"), some, others).alias("part"), "id", "vector")
    asked = asked.groupBy("part").applyInPandas(pack_queries, "part int, query_ids binary, queries binary")
    with rows_per_batch(vectors.sparkSession, 1):
        # every block of vectors goes to each part of the queries
        pairs = materialize(index, "index").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        pairs = pairs.repartition(blocks * parts, "part", "block").join(materialize(asked, "queries"), "part")
        found = pairs.select("ids", "low", "digits", "slices", "query_ids", "queries").mapInArrow(search_pairs(top), "query_id bigint, vec_id bigint, score bigint")
        found = materialize(found, "found")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    fits = F.when(F.col("score").isNull(), F.raise_error(F.lit("a score does not fit a long")).cast("bigint")).otherwise(F.col("score"))
    return found.select("query_id", "rank", "vec_id", fits.alias("score"))
