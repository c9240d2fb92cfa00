"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of an n-gram binds (multiplies) the
vectors of its letters, each permuted (rotated) by its place; a document bundles (adds) the vectors
of all its n-grams; a language bundles the unit vectors of its documents. A document gets the
language whose profile has the largest cosine with its own vector.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlane.llm.tasks import map_texts

DIMENSIONS = 1024
ORDER = 3
UNKNOWN = "und"
UNIT = 1 << 20  # profiles add whole numbers, so the order of addition does not matter
BLOCK_DOCUMENTS, BLOCK_CHARS, BLOCK_GRAMS = 64, 1 << 19, 4096
TABLE = 1 << 22
SLICE_ROWS = 512
MAX_LANGUAGES = 10_000


class Letters:
    """Maps characters to small numbers: 0 is not seen yet, 1 no letter, from 2 on letters."""

    def __init__(self, dimensions: int):
        self.number = np.zeros(0x110000, dtype=np.int32)
        self.vectors = np.ones((2, dimensions), dtype=np.int8)
        self.vectors[1] = self._random(32)

    def _random(self, code: int) -> np.ndarray:
        bits = np.random.Generator(np.random.PCG64(code)).integers(0, 2, self.vectors.shape[1], dtype=np.int8)
        return bits * 2 - 1

    def __call__(self, text: str) -> np.ndarray:
        """Numbers of the letters of a text, with one 1 between words and at both ends."""
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        numbers = self.number[codes]
        if not numbers.all():
            for code in np.unique(codes[numbers == 0]):
                self.number[code] = 1
                if unicodedata.category(chr(code))[0] == "L":
                    self.number[code] = len(self.vectors)
                    self.vectors = np.vstack([self.vectors, self._random(int(code))])
            numbers = self.number[codes]
        return numbers[(numbers != 1) | (np.concatenate([[0], numbers[:-1]]) != 1)]


class Profiler:
    """Bundles the n-grams of documents."""

    def __init__(self, dimensions: int = DIMENSIONS, order: int = ORDER):
        self.dimensions, self.order = dimensions, order
        self.letters = Letters(dimensions)

    def grams(self, ids: np.ndarray, base: int) -> np.ndarray:
        """Vectors of n-grams given as numbers to a base, first letter highest."""
        out = np.ones((len(ids), self.dimensions), dtype=np.int8)
        for place in range(self.order):
            letter = ids // base ** (self.order - 1 - place) % base
            out *= np.roll(self.letters.vectors, self.order - 1 - place, axis=1)[letter]
        return out

    def block(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bundles of a few documents, as a matrix of whole numbers."""
        base = len(self.letters.vectors)
        counted = max(len(x) for x in texts) - self.order + 1 > 0
        bundles = np.zeros((len(texts), self.dimensions), dtype=np.float64)
        if not counted:
            return bundles
        ids, owner = [], []
        for i, x in enumerate(texts):
            n = max(0, len(x) - self.order + 1)
            gram = np.zeros(n, dtype=np.int64)
            for place in range(self.order):
                gram = gram * base + x[place : place + n]
            ids.append(gram)
            owner.append(np.full(n, i))
        ids, owner = np.concatenate(ids), np.concatenate(owner)
        if base**self.order <= TABLE:
            seen = np.zeros(base**self.order, dtype=np.int32)
            seen[ids] = 1
            distinct = np.flatnonzero(seen)
            seen[distinct] = np.arange(len(distinct))
            column = seen[ids]
        else:
            distinct, column = np.unique(ids, return_inverse=True)
        n = len(distinct)
        counts = np.bincount(owner * n + column, minlength=len(texts) * n).reshape(len(texts), n)
        for at in range(0, n, BLOCK_GRAMS):
            part = self.grams(distinct[at : at + BLOCK_GRAMS], base).astype(np.float32)
            bundles += counts[:, at : at + BLOCK_GRAMS].astype(np.float32) @ part
        return bundles

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For blocks of documents: index of the first one, unit vectors, and whether any letter is there."""
        start, block, size = 0, [], 0
        for i, text in enumerate(texts):
            block.append(self.letters(text or ""))
            size += len(block[-1])
            if len(block) == BLOCK_DOCUMENTS or size >= BLOCK_CHARS or i == len(texts) - 1:
                vectors = self.block(block)
                norms = np.linalg.norm(vectors, axis=1, keepdims=True)
                known = np.array([bool((x > 1).any()) for x in block])
                yield start, vectors / np.maximum(norms, 1), known
                start, block, size = i + 1, [], 0


def profiles(labelled: DataFrame, text: str, label: str, dimensions: int = DIMENSIONS, order: int = ORDER) -> dict[str, np.ndarray]:
    """Profile of each label: the sum of the unit vectors of its documents, over all rows.

    Rows without a label or without a letter teach nothing. Each task sends one vector per label.
    The result has a vector per label; more than ``MAX_LANGUAGES`` labels are refused.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, sums = Profiler(dimensions, order), {}
        for batch in (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
            names = batch.column(1).to_pylist()
            for start, vectors, known in profiler(batch.column(0).to_pylist()):
                whole = np.rint(vectors * UNIT).astype(np.int64)
                for i in np.flatnonzero(known):
                    name = names[start + i]
                    if name not in sums:
                        sums[name] = np.zeros(dimensions, dtype=np.int64)
                    sums[name] += whole[i]
        if sums:
            columns = [pa.array(list(sums)), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "vector"])

    rows = labelled.select(F.col(text).alias("text"), F.col(label).alias("label")).filter("text IS NOT NULL AND label IS NOT NULL")
    parts = rows.mapInArrow(bundle, "label string, vector array<bigint>")
    sums = parts.select("label", F.posexplode("vector")).groupBy("label", "pos").agg(F.sum("col").alias("value"))
    vectors = sums.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("v")).select("label", F.col("v.value").alias("v"))
    found = {row["label"]: np.array(row["v"], dtype=np.float64) for row in vectors.limit(MAX_LANGUAGES + 1).collect()}
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    return found


def identify(
    df: DataFrame, text: str, known: dict[str, np.ndarray], out: str = "lang_pred", score: str = "score",
    dimensions: int = DIMENSIONS, order: int = ORDER, keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the best label of each text and its cosine, from 0 to 1.

    ``UNKNOWN`` with 0 where the text is missing or has no letter, or nothing was learned. Equal
    cosines go to the first label in alphabetical order. Columns of the same names are replaced;
    rows are never merged, so repeated rows stay.
    """
    names = sorted(known)
    matrix = np.array([known[x] for x in names]).reshape(len(names), dimensions)
    matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1)

    def start():
        profiler = Profiler(dimensions, order)

        def work(texts: list[str]) -> list[list]:
            labels, scores = [], []
            for _, vectors, letters in profiler(texts):
                cosines = np.clip(np.round(vectors @ matrix.T, 9), 0, 1) if names else np.zeros((len(letters), 1))
                best = cosines.argmax(axis=1)
                labels += [names[b] if names and k else UNKNOWN for b, k in zip(best, letters, strict=True)]
                scores += np.where(letters, cosines[np.arange(len(best)), best], 0.0).tolist()
            return [labels, scores]

        return work

    return map_texts(df, text, {out: "string", score: "double"}, start, keep)


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether a key falls into the part that is not learned from; a missing key never does."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))
