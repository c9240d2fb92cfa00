"""Language-model scores from an n-gram trie in Elias-Fano form.

Texts are packed into slices of some megabytes that hold each token as a small number. Exchanges
follow one after another, each over ranges of a hash: words give their training counts and get the
corpus count and a global number; then the n-grams of each level, from pairs up to the order, give
their training counts as (number of the context, number of the word), and each range builds its part
of the trie, answers the n-grams asked about with their probability, count and number, and is gone
before the next level. No task sees the whole model, and nothing of it passes through the driver.

A part of a level lists its contexts (words, or n-grams one word shorter) and, in Elias-Fano form,
monotone pointers to their successors, and one Elias-Fano sequence of all successors, made monotone by
the place of the context, with a quantised probability each. An n-gram is found by successor search
relative to its context. All are memory-mapped from an unnamed file that ends with the task.

An n-gram is only asked about if training has its context. If no other slice mentions the context, all
its successors are in the slice at hand, so they are counted there, with the same result.

Probabilities are smoothed towards the shorter context: P(w | u v) = c(u v w) / (c(u v) + M) +
M / (c(u v) + M) P(w | v), and so on down to P(w) = (c(w) + 1) / (N + V + 1). The share of an n-gram is
quantised to 8 bits, rounded down and below 1; the rest of a context follows from its count. So what follows
a context has at most a probability of 1 in all. The first word of a text has just the start of the
text as context.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlane.llm.hashing import BASE, WordHasher, lowered, mix
from paperlane.llm.tasks import columns_besides, rows_per_batch, shuffles_removed
from paperlane.session import materialize

END = np.uint64(0x1F83D9ABFB41BD6B)  # stands for the end of a text
WEIGHT = 4.0
LEVELS = 254
CODEC = "zstd"
PACK_BYTES = 1 << 22
TEXT_PER_RANGE, LEAST_RANGES = 16 << 20, 16
HOT_SHARE = 8  # a context with more than this part of a range's tokens is spread over ranges
PACKS_PER_BATCH = 4


def decades(tokens: int, weight: float) -> int:
    """Powers of ten that the shares of n-grams take up, as none is below that of one token among all."""
    return max(1, math.ceil(math.log10(tokens + weight + 1)))


def quantise(p: np.ndarray, span: int) -> np.ndarray:
    """Levels 1 to 254 of a share below 1, even in its logarithm, rounded down."""
    level = np.floor((np.log10(np.maximum(p, 1e-300)) + span) / span * LEVELS)
    return (np.clip(level, 0, LEVELS - 1) + 1).astype(np.uint8)


def restore(level: np.ndarray, span: int) -> np.ndarray:
    """Share of a level; level 0 stands for none."""
    table = np.concatenate([[0.0], 10 ** (span * np.arange(LEVELS) / LEVELS - span)])
    return table[level]


def squeeze(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers as few bytes: differences if they rise, then all low bytes, all second bytes, and so on."""
    values = values.astype("<u8")
    if rising and len(values):
        values = np.diff(values, prepend=np.uint64(0))
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), CODEC, asbytes=True)


def unsqueeze(data: bytes, rising: bool = False) -> np.ndarray:
    n = int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], n * data[0], CODEC), dtype=np.uint8).reshape(data[0], n)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, : data[0]] = planes.T
    out = out.view("<u8").ravel()
    return np.cumsum(out, dtype=np.uint64) if rising else out


def mapped(values: np.ndarray) -> np.ndarray:
    """The array in a memory-mapped file without a name."""
    if not len(values):
        return values
    with tempfile.TemporaryFile() as file:
        values.tofile(file)
        file.flush()
        return np.memmap(file, dtype=values.dtype, mode="r", shape=values.shape)


class EliasFano:
    """A rising sequence of numbers: low bits as they are, high bits in unary."""

    def __init__(self, values: np.ndarray, universe: int):
        n = max(len(values), 1)
        self.n = len(values)
        self.shift = max(0, (universe // n).bit_length() - 1)
        low = values & np.uint64((1 << self.shift) - 1)
        self.low = mapped(low.astype(np.min_scalar_type((1 << self.shift) - 1)))
        high = (values >> np.uint64(self.shift)).astype(np.int64)
        size = len(values) + (universe >> self.shift) + 2
        bits = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
        bits[high + np.arange(len(values))] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        zeros = 64 - np.bitwise_count(words).astype(np.int64)
        self.bits = mapped(words)
        self.zeros = mapped(np.concatenate([[0], np.cumsum(zeros)]))  # before each 64 bits

    def _before_zero(self, k: np.ndarray) -> np.ndarray:
        """Number of values whose high part is below k: the ones before the k-th zero, from 1 on."""
        word = np.maximum(np.searchsorted(self.zeros, k, "left") - 1, 0)
        left = k - self.zeros[word]
        part = ~self.bits[word]
        place = np.zeros(len(k), dtype=np.int64)
        # halve the part that holds the zero looked for
        for width in (32, 16, 8, 4, 2, 1):
            low = part & np.uint64((1 << width) - 1)
            inside = np.bitwise_count(low).astype(np.int64)
            above = inside < left
            left -= np.where(above, inside, 0)
            place += np.where(above, width, 0)
            part = np.where(above, part >> np.uint64(width), low)
        return np.where(k > 0, word * 64 + place - (k - 1), 0)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at some places."""
        ones = np.flatnonzero(np.unpackbits(self.bits.view(np.uint8), bitorder="little"))
        return (ones[i] - i).astype(np.uint64) << np.uint64(self.shift) | self.low[i].astype(np.uint64)

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value that is not below each given one, and whether it is that value."""
        if not self.n:
            return np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=bool)
        high = (values >> np.uint64(self.shift)).astype(np.int64)
        low = (values & np.uint64((1 << self.shift) - 1)).astype(self.low.dtype)
        begin, end = self._before_zero(high), self._before_zero(high + 1)
        last = end.copy()
        while (open_ := begin < end).any():
            middle = (begin + end) // 2
            less = open_ & (self.low[np.minimum(middle, self.n - 1)] < low)
            begin = np.where(less, middle + 1, begin)
            end = np.where(open_ & ~less, middle, end)
        return begin, (begin < last) & (self.low[np.minimum(begin, self.n - 1)] == low)


class Trie:
    """Contexts and their successors."""

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray, seen: np.ndarray, weight: float, span: int):
        """From distinct n-grams, sorted, with their counts and the counts of their contexts."""
        self.contexts, first = np.unique(context, return_index=True)
        self.universe = int(word.max()) + 1 if len(word) else 1
        place = np.searchsorted(self.contexts, context)
        self.words = EliasFano(place.astype(np.uint64) * np.uint64(self.universe) + word, max(1, len(self.contexts)) * self.universe)
        self.pointers = EliasFano(np.append(first, len(context)).astype(np.uint64), len(context) + 1)
        self.probability = mapped(quantise(count / (seen + weight), span))

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Levels and places of the n-grams; level 0 where the trie does not have one."""
        if not len(self.contexts):
            return np.zeros(len(word), dtype=np.uint8), np.zeros(len(word), dtype=np.int64)
        place = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        known = (self.contexts[place] == context) & (word < self.universe)
        wanted = place.astype(np.uint64) * np.uint64(self.universe) + np.where(known, word, np.uint64(0))
        at, held = self.words.successor(wanted)
        ends = self.pointers.get(place + 1).astype(np.int64)
        found = known & (at < ends) & held
        at = np.minimum(at, len(self.probability) - 1)
        return np.where(found, self.probability[at], 0).astype(np.uint8), at


PACK = "pack bigint, words binary, end bigint, counts binary, tokens binary, lengths binary, train binary"


def by_count(seen: np.ndarray) -> np.ndarray:
    return np.argsort(-seen.astype(np.int64), kind="stable")


def pack_texts(kept: Sequence[str], ranges: int) -> Callable:
    """Slices of documents: their rows, distinct words with training counts, and tokens by number.

    Words come by range and hash, so that what the ranges say of them comes in the same order, and their
    hashes are not needed any more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, number = WordHasher(), TaskContext.get().partitionId() << 32
        for batch in batches:
            at, size, texts = 0, 0, []
            train = np.array(batch.column(batch.num_columns - 1).to_pylist(), dtype=bool)
            column = batch.column(batch.num_columns - 2)
            for i, text in enumerate(column):
                texts.append(lowered(text.as_py()))
                size += len(texts[-1])
                if size < PACK_BYTES and i < len(column) - 1:
                    continue
                hashes, counts = hasher(texts)
                tokens = np.insert(hashes, np.cumsum(counts), END)
                lengths = counts + 1
                words, local = np.unique(tokens, return_inverse=True)
                dealt = np.argsort(word_range(words, ranges), kind="stable")
                words, back = words[dealt], np.empty(len(dealt), dtype=np.int64)
                back[dealt] = np.arange(len(dealt))
                local = back[local]
                own = train[at : i + 1]
                seen = np.bincount(local[np.repeat(own, lengths)], minlength=len(words))
                rows = pa.StructArray.from_arrays([c.slice(at, i + 1 - at) for c in batch.columns[:-2]], names=list(kept))
                # numbers by falling count are small, and take fewer bytes
                often = np.empty(len(words), dtype=np.int64)
                often[by_count(seen)] = np.arange(len(words))
                values = (
                    squeeze(words, rising=True), squeeze(seen), squeeze(often[local]), squeeze(lengths), own.tobytes(),
                )
                first, *others = (pa.array([v], pa.binary()) for v in values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), first, pa.array([int(np.flatnonzero(words == END)[0])]), *others, pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)],
                    names=["pack", "words", "end", "counts", "tokens", "lengths", "train", "rows"],
                )
                number += 1
                at, size, texts = i + 1, 0, []

    return run


def split(place: np.ndarray, ranges: int) -> Iterator[tuple[int, np.ndarray]]:
    """Entries of each range that has any."""
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange(ranges + 1))
    for r in np.flatnonzero(np.diff(cuts)).tolist():
        yield r, order[cuts[r] : cuts[r + 1]]


def word_range(words: np.ndarray, ranges: int) -> np.ndarray:
    return ((words >> np.uint64(7)) % np.uint64(ranges)).astype(np.int64)


def announce_words(ranges: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, counts = unsqueeze(words, rising=True), unsqueeze(counts)
                rows = [(r, squeeze(words[some], rising=True), squeeze(counts[some])) for r, some in split(word_range(words, ranges), ranges)]
                columns = [pa.array([r for r, _, _ in rows], pa.int32()), pa.array([pack] * len(rows), pa.int64()), *(pa.array([x[i] for x in rows], pa.binary()) for i in (1, 2))]
                yield pa.RecordBatch.from_arrays(columns, names=["range", "pack", "words", "counts"])

    return run


def count_words(ranges: int) -> Callable:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Corpus count and number of the words of each pack; totals once."""
        parts = [unsqueeze(x, rising=True) for x in group["words"]]
        words, which = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.bincount(which, weights=np.concatenate([unsqueeze(x) for x in group["counts"]]), minlength=len(words)).astype(np.int64)
        ids = np.arange(len(words), dtype=np.int64) * ranges + int(group["range"].iloc[0])
        ends = np.cumsum([len(x) for x in parts])
        which = np.split(which, ends[:-1])
        first = np.arange(len(parts)) == 0
        return pd.DataFrame({
            "pack": group["pack"].to_numpy(), "range": group["range"].to_numpy(), "counts": [squeeze(counts[w]) for w in which],
            # the words of a pack are in order, and so are their numbers
            "ids": [squeeze(ids[w], rising=True) for w in which],
            "tokens": np.where(first, counts.sum(), 0), "distinct": np.where(first, (counts > 0).sum(), 0),
        })

    return run


class Pack:
    """A pack with the answers about its words, and its distinct n-grams of one level at a time."""

    def __init__(self, row: dict):
        self.lengths = unsqueeze(row["lengths"]).astype(np.int64)
        self.tokens = by_count(unsqueeze(row["counts"]))[unsqueeze(row["tokens"]).astype(np.int64)]
        self.train = np.repeat(np.frombuffer(row["train"], dtype=bool), self.lengths)
        answers = sorted(row["answers"], key=lambda a: a["range"])
        self.counts = np.concatenate([unsqueeze(a["counts"]) for a in answers]).astype(np.int64)
        self.ids = np.concatenate([unsqueeze(a["ids"], rising=True) for a in answers])
        words = len(self.ids)
        self.starts = np.cumsum(self.lengths) - self.lengths
        # by the numbers of context and word, so that both come in order
        self.order = np.argsort(self.ids, kind="stable")
        self.rank = np.empty(words, dtype=np.int64)
        self.rank[self.order] = np.arange(words)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = row["end"]
        self._after(self.rank[before], self.ids[self.order], self.counts[self.order], np.zeros(words, dtype=bool))

    def _after(self, place: np.ndarray, ids: np.ndarray, counts: np.ndarray, alone: np.ndarray) -> None:
        """Distinct n-grams, given the place of each token's context (-1 for none) among contexts by number."""
        self.context_ids, self.context_counts, self.context_alone = ids, counts, alone
        at = np.flatnonzero(place >= 0)
        codes, which = np.unique(place[at] * len(self.order) + self.rank[self.tokens[at]], return_inverse=True)
        self.which = np.full(len(self.tokens), -1)
        self.which[at] = which
        self.context, self.word = codes // len(self.order), self.order[codes % len(self.order)]
        self.seen = np.bincount(which[self.train[at]], minlength=len(codes))

    def by_range(self, ranges: int, hot: int) -> Iterator[tuple[int, np.ndarray]]:
        """N-grams to ask each range about; only the successors of hot contexts are spread."""
        asked = np.flatnonzero(~self.context_alone[self.context])
        context = self.context[asked]
        place = mix(self.context_ids[context])
        spread = self.context_counts[context] > hot
        place = np.where(spread, mix(place + self.ids[self.word[asked]] * np.uint64(BASE)), place)
        for r, some in split((place % np.uint64(ranges)).astype(np.int64), ranges):
            yield r, asked[some]

    def learn(self, answers: Sequence[dict] | None, ranges: int, hot: int, weight: float, span: int) -> None:
        """Take what the ranges say about the n-grams."""
        own = self.context_alone[self.context]
        p = self.seen / (self.context_counts[self.context] + weight)
        self.level = np.where(own & (self.seen > 0), quantise(p, span), 0).astype(np.uint8)
        self.count, self.alone, self.number = self.seen.astype(np.int64), own, np.zeros(len(own), dtype=np.uint64)
        told = {a["range"]: a for a in answers or ()}
        for r, some in self.by_range(ranges, hot):
            a = told[r]
            self.level[some] = np.frombuffer(a["levels"], dtype=np.uint8)
            if a["alone"] is None:
                continue
            known = some[self.level[some] > 0]
            alone = np.unpackbits(np.frombuffer(a["alone"], dtype=np.uint8), count=len(known)).astype(bool)
            self.alone[known[alone]] = True
            self.count[known[~alone]] = unsqueeze(a["counts"])
            self.number[known[~alone]] = unsqueeze(a["numbers"], rising=True) * np.uint64(ranges) + np.uint64(r)

    def deepen(self) -> None:
        """Go on to n-grams one word longer, after those that training has."""
        order = np.argsort(self.number, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        before = np.empty_like(self.which)
        before[1:] = self.which[:-1]
        before[self.starts] = -1
        # the last entry stands for tokens without an n-gram
        place = np.append(np.where(self.level > 0, rank, -1), -1)[before]
        self._after(place, self.number[order], self.count[order], self.alone[order])

    def smooth(self, p: np.ndarray, weight: float, span: int) -> None:
        """Turn the probability of each token after the shorter context into that of this level."""
        at = np.flatnonzero(self.which >= 0)
        gram = self.which[at]
        back = weight / (self.context_counts + weight)
        p[at] = restore(self.level, span)[gram] + back[self.context[gram]] * p[at]


def packs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Pack]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names) if name != "rows"}
            yield row, Pack(row)


def announce_grams(n: int, ranges: int, hot: int, weight: float, span: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, pack in packs_of(batches):
            for shorter in range(2, n):
                pack.learn(row[f"grams_{shorter}"], ranges, hot, weight, span)
                pack.deepen()
            out: list[list] = [[] for _ in range(7)]
            for r, some in pack.by_range(ranges, hot):
                # n-grams are in order of their context
                context = pack.context[some]
                first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
                context = context[first]
                counts = pack.context_counts[context]
                for column, value in zip(out, (
                    r, row["pack"], squeeze(pack.context_ids[context], rising=True), squeeze(np.where(counts > hot, counts, 0)),
                    squeeze(np.diff(np.append(first, len(some)))), squeeze(pack.ids[pack.word[some]]), squeeze(pack.seen[some]),
                ), strict=True):
                    column.append(value)
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["range", "pack", "contexts", "seen", "runs", "words", "counts"])

    return run


def answer_grams(weight: float, span: int, last: bool) -> Callable:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Build the part of a level that lies in a range, and look up the n-grams of all packs.

        Unless the level is the last, those of the trie also get their place, from which their number
        follows, and their count; of those that only one pack mentions it has the count already.
        """
        runs = [unsqueeze(x).astype(np.int64) for x in group["runs"]]
        sizes = [int(x.sum()) for x in runs]
        context = np.concatenate([np.repeat(unsqueeze(x, rising=True), n) for x, n in zip(group["contexts"], runs, strict=True)])
        seen = np.concatenate([np.repeat(unsqueeze(x).astype(np.int64), n) for x, n in zip(group["seen"], runs, strict=True)])
        word = np.concatenate([unsqueeze(x) for x in group["words"]])
        count = np.concatenate([unsqueeze(x).astype(np.int64) for x in group["counts"]])
        order = np.lexsort((word, context))
        c, w = context[order], word[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        asked = c[first], w[first]
        sums = np.add.reduceat(count[order], first)
        alone = np.diff(np.append(first, len(order))) == 1
        trained = sums > 0
        first, sums, alone = first[trained], sums[trained], alone[trained]
        # a context is seen as often as all its successors; of a hot one only some are here, so it comes along
        contexts, place = np.unique(c[first], return_inverse=True)
        totals = np.bincount(place, weights=sums, minlength=len(contexts)).astype(np.int64)
        told = seen[order[first]]
        trie = Trie(c[first], w[first], sums, np.where(told > 0, told, totals[place] if len(contexts) else 0), weight, span)
        del order, c, w, new, seen, count, context, word
        found = pd.DataFrame({"pack": group["pack"].to_numpy(), "range": group["range"].to_numpy(), "levels": None, "alone": None, "numbers": None, "counts": None})
        # each distinct n-gram is looked up once
        answers = zip(*(np.split(x[which], np.cumsum(sizes)[:-1]) for x in trie.find(*asked)), strict=True)
        rows = []
        for level, at in answers:
            at = at[level > 0]
            single = alone[at]
            more = (np.packbits(single).tobytes(), squeeze(at[~single], rising=True), squeeze(sums[at[~single]]))
            rows.append((level.tobytes(), *((None,) * 3 if last else more)))
        found[["levels", "alone", "numbers", "counts"]] = pd.DataFrame(rows, dtype=object)
        return found

    return run


def score_packs(order: int, ranges: int, hot: int, tokens: int, distinct: int, weight: float, span: int, kept: Sequence[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_at = batch.schema.get_field_index("rows")
            for i, (row, pack) in enumerate(packs_of([batch])):
                single = ((pack.counts + 1) / (tokens + (distinct + 1)))[pack.tokens]
                p = single.copy()
                for n in range(2, order + 1):
                    if n > 2:
                        pack.deepen()
                    pack.learn(row[f"grams_{n}"], ranges, hot, weight, span)
                    pack.smooth(p, weight, span)
                known = np.add.reduceat((pack.counts > 0)[pack.tokens].astype(np.int64), pack.starts)
                base, score = (np.add.reduceat(np.log10(x), pack.starts) for x in (single, p))
                rows = batch.column(rows_at)[i].values
                columns = [rows.field(k) for k in range(len(kept))]
                made = [pack.lengths, known, np.full(len(known), tokens, dtype=np.int64), base, score]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, made)], names=[*kept, *ADDED])

    return run


ADDED = {"n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}


def score_texts(
    docs: DataFrame, text: str, train: Column, keep: Sequence[str] | None = None, weight: float = WEIGHT, order: int = 3,
) -> DataFrame:
    """Add log10 probabilities of each whole text, learned from the rows where ``train`` holds.

    ``order`` is the length of the longest n-grams, 2 or more. Tokens are the words that white space parts, A-Z in lower case, and one end per text; a missing
    or empty text is just its end. Added: ``n_tokens``, ``n_known`` (tokens seen in training),
    ``train_tokens`` (of the corpus), ``base_score`` (single words, add-one) and ``score`` (the trie).
    Columns of the same names are replaced. Rows are never merged, so repeated rows stay and each
    counts in training. Words are told apart by 64-bit hashes.
    """
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = docs.sparkSession
    kept = columns_besides(docs, ADDED, keep)
    names = [f"_{i}" for i in range(len(kept))]
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)), F.col(text).alias("_text_"), F.coalesce(train, F.lit(False)).alias("_train_"))
    volume = rows.agg(F.sum(F.octet_length("_text_"))).first()[0] or 0
    ranges = min(1 << 20, max(LEAST_RANGES, volume // TEXT_PER_RANGE))

    kinds = T.StructType([*T.DataType.fromDDL(PACK).fields, T.StructField("rows", T.ArrayType(rows.select(*names).schema))])
    with rows_per_batch(spark, PACKS_PER_BATCH * 1024):
        packs = materialize(rows.mapInArrow(pack_texts(names, ranges), kinds), "packs")
    # the files of an exchange go when the next table is written
    with rows_per_batch(spark, PACKS_PER_BATCH), shuffles_removed(spark):
        told = packs.select("pack", "words", "counts").mapInArrow(announce_words(ranges), "range int, pack bigint, words binary, counts binary")
        answers = told.groupBy("range").applyInPandas(count_words(ranges), "pack bigint, range int, counts binary, ids binary, tokens bigint, distinct bigint")
        answers = materialize(answers, "words")
        total = answers.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
        tokens, distinct = total["tokens"] or 0, total["distinct"] or 0
        hot, span = tokens // (HOT_SHARE * ranges) + 1, decades(tokens, weight)

        facts = ["pack", "end", "counts", "tokens", "lengths", "train"]
        known = [answers.groupBy("pack").agg(F.collect_list(F.struct("range", "counts", "ids")).alias("answers"))]

        def with_answers(some: DataFrame) -> DataFrame:
            # of longer n-grams, a pack may have none that others mention
            for x in known:
                some = some.join(x, "pack", "left")
            return some

        for n in range(2, order + 1):
            kinds = "range int, pack bigint, contexts binary, seen binary, runs binary, words binary, counts binary"
            told = with_answers(packs.select(*facts)).mapInArrow(announce_grams(n, ranges, hot, weight, span), kinds)
            kinds = "pack bigint, range int, levels binary, alone binary, numbers binary, counts binary"
            grams = told.groupBy("range").applyInPandas(answer_grams(weight, span, n == order), kinds)
            grams = grams.groupBy("pack").agg(F.collect_list(F.struct("range", "levels", "alone", "numbers", "counts")).alias(f"grams_{n}"))
            known.append(materialize(grams, f"grams_{n}"))
        kinds = T.StructType([*rows.select(*names).schema.fields, *(T.StructField(n, T.DataType.fromDDL(k)) for n, k in ADDED.items())])
        full = with_answers(packs.select(*facts, "rows"))
        scored = full.mapInArrow(score_packs(order, ranges, hot, tokens, distinct, weight, span, names), kinds)
        scored = materialize(scored, "scored")
    return scored.select(*(F.col(n).alias(c) for c, n in zip(kept, names, strict=True)), *ADDED)
