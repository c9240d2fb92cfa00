"""Exact removal of byte strings that occur more than once, by prefix-free parsing.

A rolling hash over half a string's length triggers wherever it is the lowest among the places at
which a string of the full length may have it. All strings with the same trigger make up one phrase,
so neighbouring phrases overlap by all but one byte of a string, and no phrase starts another one.

* The *parse* is the sequence of phrases of each document, the *dictionary* the distinct phrases.
  Phrases are sorted by trigger, then by phrase. A phrase that the parse has twice repeats in full:
  in repetitive text that settles nearly all, at one entry for some fifty bytes.
* Equal strings have equal triggers at equal places. So only where one trigger has several phrases
  the *suffixes* of these dictionary entries are put in order, to the depth of one string, and
  neighbours in that order that agree so far are repeats.

Order is by trigger and hash instead of letter by letter, as only equality to the full length counts:
all comparisons then meet in small ranges of the hash, whatever the size of a group. A task sends
each phrase once, and tells its other places itself, so a passage that a third of all documents share
costs one entry per task. Equality rests on two 64-bit hashes, of the trigger and of the string.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlane.llm.hashing import BASE, INVERSE, byte_numbers, mix, powers, running
from paperlane.llm.tasks import columns_besides, schema_with
from paperlane.session import materialize

LENGTH = 200
CHUNK = 1 << 20
PLACE = np.uint64(0xFFFFFF)
SLICE_BYTES = 1 << 23
TEXT_PER_RANGE, LEAST_RANGES = 48 << 20, 16


class Parser:
    """Phrases of documents."""

    def __init__(self, length: int):
        self.length = length
        self.gram = length // 2
        self.zone = length - self.gram + 1
        self.numbers = byte_numbers(7)
        self.up, self.down = powers(BASE, 2 * CHUNK), powers(INVERSE, 2 * CHUNK)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) > len(self.up):
            self.up, self.down = powers(BASE, len(data)), powers(INVERSE, len(data))
        return running(data, self.numbers, self.up)

    def hashes(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the byte strings between two arrays of places."""
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def triggers(self, sums: np.ndarray) -> np.ndarray:
        """Place of the trigger of the string that starts at each place: the last lowest hash."""
        n = len(sums) - 1 - self.gram + 1
        key = mix((sums[self.gram :] - sums[: n]) * self.down[:n])
        key = (key & ~PLACE) | (PLACE - np.arange(n, dtype=np.uint64))
        width = 1
        while 2 * width <= self.zone:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        rest = self.zone - width
        low = np.minimum(key[: len(key) - rest], key[rest:]) if rest else key
        return (PLACE - (low & PLACE)).astype(np.int64)

    def parts(self, texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
        """Texts end to end in chunks; a long one is cut into pieces that overlap by a string less a byte.

        Gives the bytes, the start of each piece in them, its text, and its place in that text.
        """
        buffer, starts, owners, places, size = [], [], [], [], 0
        for i, text in enumerate(texts):
            for at in range(0, max(1, len(text) - self.length + 1), CHUNK):
                piece = text[at : at + CHUNK + self.length - 1]
                buffer.append(piece)
                starts.append(size)
                owners.append(i)
                places.append(at)
                size += len(piece)
                if size >= CHUNK:
                    yield b"".join(buffer), np.array([*starts, size]), np.array(owners), np.array(places)
                    buffer, starts, owners, places, size = [], [], [], [], 0
        if buffer:
            yield b"".join(buffer), np.array([*starts, size]), np.array(owners), np.array(places)

    def __call__(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """Phrases: text, first and last string (as places in the text), place of the trigger in the
        phrase, hash of the trigger and of the phrase."""
        for data, starts, owners, places in self.parts(texts):
            if len(data) < self.length:
                continue
            data = np.frombuffer(data, dtype=np.uint8)
            sums = self.sums(data)
            trigger = self.triggers(sums)
            # strings that do not run into the next piece
            inside = np.zeros(len(trigger) + 1, dtype=np.int32)
            long = np.flatnonzero(np.diff(starts) >= self.length)
            np.add.at(inside, starts[long], 1)
            np.add.at(inside, starts[long + 1] - self.length + 1, -1)
            valid = np.flatnonzero(np.cumsum(inside[:-1]))
            if not len(valid):
                continue
            piece = np.searchsorted(starts, valid, "right") - 1
            new = np.ones(len(valid), dtype=bool)
            new[1:] = (trigger[valid[1:]] != trigger[valid[:-1]]) | (piece[1:] != piece[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(valid)) - 1
            low, high, own = valid[first], valid[last], piece[first]
            at = trigger[low]
            trigger_hash = self.hashes(sums, at, at + self.gram)
            phrase = self.hashes(sums, low, high + self.length) + mix((at - low).astype(np.uint64))
            shift = places[own] - starts[own]
            yield owners[own], low + shift, high + shift, at - low, trigger_hash, phrase


PHRASE = np.dtype([("first", "<u4"), ("count", "u1"), ("trigger", "u1")])


def text_slices(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Keys and texts of batches of (key, text), each key once per task, in groups of bounded size."""
    keys, texts, total, seen = [], [], 0, set()
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if key in seen:
                continue
            seen.add(key)
            raw = text.as_py().encode("utf-8", "surrogatepass")
            if len(raw) < least:
                continue
            keys.append(key)
            texts.append(raw)
            total += len(raw)
            if total >= SLICE_BYTES:
                yield keys, texts
                keys, texts, total = [], [], 0
    if keys:
        yield keys, texts


def by_owner(owner: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Indexes of the entries of each owner that has any."""
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(n + 1))
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        yield i, order[cuts[i] : cuts[i + 1]]


def announce_phrases(length: int, ranges: int):
    """Per group of texts and range of the trigger hash: the distinct phrases, with a place of each
    and whether the group has it more than once; and phrases known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(length)
        for keys, texts in text_slices(batches, length):
            found = list(parser(texts))
            if not found:
                continue
            owner, low, high, at, trigger, phrase = (np.concatenate(x) for x in zip(*found, strict=True))
            entry = np.zeros(len(low), dtype=PHRASE)
            entry["first"], entry["count"], entry["trigger"] = low, high - low, at
            order = np.lexsort((phrase, trigger))
            owner, trigger, phrase, entry = owner[order], trigger[order], phrase[order], entry[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (trigger[1:] != trigger[:-1]) | (phrase[1:] != phrase[:-1])
            starts = np.flatnonzero(new)
            counts = np.diff(np.append(starts, len(order)))
            again = ~new
            sure: dict[int, list[tuple[bytes, bytes]]] = {}
            for i, some in by_owner(owner[again], len(keys)):
                key = keys[i]
                sure.setdefault(int.from_bytes(key[:4], "little") % ranges, []).append((key, entry[again][some].tobytes()))
            owner, trigger, phrase, entry = owner[starts], trigger[starts], phrase[starts], entry[starts]
            place = (trigger & np.uint64(0xFFFFF)) % np.uint64(ranges)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(ranges + 1))
            rows: list[list] = [[] for _ in range(8)]
            for r in range(ranges):
                some = order[cuts[r] : cuts[r + 1]]
                told = sure.get(r, [])
                if not len(some) and not told:
                    continue
                here, local = np.unique(owner[some], return_inverse=True)
                for column, value in zip(rows, (
                    r, trigger[some].tobytes(), phrase[some].tobytes(), (counts[some] > 1).tobytes(),
                    local.astype(np.uint32).tobytes(), entry[some].tobytes(), [keys[i] for i in here.tolist()],
                    [{"key": k, "entries": e} for k, e in told],
                ), strict=True):
                    column.append(value)
            kinds = [pa.int32(), *[pa.binary()] * 5, pa.list_(pa.binary()), pa.list_(pa.struct({"key": pa.binary(), "entries": pa.binary()}))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["range", "trigger", "phrase", "more", "owner", "entry", "keys", "sure"])

    return run


def settle_phrases(group: pd.DataFrame) -> pd.DataFrame:
    """Phrases that repeat, and phrases whose suffixes must be compared, by document."""
    trigger = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in group["trigger"]])
    phrase = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in group["phrase"]])
    more = np.concatenate([np.frombuffer(x, dtype=bool) for x in group["more"]])
    order = np.lexsort((phrase, trigger))
    t, p = trigger[order], phrase[order]
    new_trigger, new_phrase = np.ones(len(t), dtype=bool), np.ones(len(t), dtype=bool)
    new_trigger[1:] = t[1:] != t[:-1]
    new_phrase[1:] = new_trigger[1:] | (p[1:] != p[:-1])
    phrases_of = np.bincount(np.cumsum(new_trigger) - 1, weights=new_phrase) if len(t) else np.zeros(0)
    rival = phrases_of[np.cumsum(new_trigger) - 1] > 1 if len(t) else np.zeros(0, bool)
    number = np.cumsum(new_phrase) - 1
    copies = np.bincount(number, weights=1 + more[order])[number] if len(t) else np.zeros(0)
    repeats, compare = np.zeros(len(t), dtype=bool), np.zeros(len(t), dtype=bool)
    repeats[order] = copies > 1
    # one place of each phrase is enough to compare it with others
    compare[order] = rival & new_phrase
    keys, some_repeat, some_compare, at = [], [], [], 0
    for owner, entry, texts, sure in zip(group["owner"], group["entry"], group["keys"], group["sure"], strict=True):
        owner, entry = np.frombuffer(owner, dtype=np.uint32), np.frombuffer(entry, dtype=PHRASE)
        r, c = repeats[at : at + len(owner)], compare[at : at + len(owner)]
        at += len(owner)
        told = np.flatnonzero(r | c)
        for i, some in by_owner(owner[told], len(texts)):
            some = told[some]
            keys.append(texts[i])
            some_repeat.append(entry[some[r[some]]].tobytes())
            some_compare.append(entry[some[c[some]]].tobytes())
        for row in sure:
            keys.append(row["key"])
            some_repeat.append(row["entries"])
            some_compare.append(b"")
    return pd.DataFrame({"key": pd.Series(keys, dtype=object), "repeats": pd.Series(some_repeat, dtype=object), "compare": pd.Series(some_compare, dtype=object)})


def announce_suffixes(length: int, ranges: int):
    """Per group of texts and range: hashes of trigger and string for each suffix to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, seen = Parser(length), set()

        def told(rows: list[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            owner = np.repeat(np.arange(len(rows)), [len(x[1]) for x in rows])
            trigger, string, start = (np.concatenate([x[i] for x in rows]) for i in (1, 2, 3))
            place = (trigger & np.uint64(0xFFFFF)) % np.uint64(ranges)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(ranges + 1))
            columns: list[list] = [[] for _ in range(6)]
            for r in np.flatnonzero(np.diff(cuts)).tolist():
                some = order[cuts[r] : cuts[r + 1]]
                here, local = np.unique(owner[some], return_inverse=True)
                for column, value in zip(columns, (
                    r, trigger[some].tobytes(), string[some].tobytes(), local.astype(np.uint32).tobytes(),
                    start[some].astype("<u4").tobytes(), [rows[i][0] for i in here.tolist()],
                ), strict=True):
                    column.append(value)
            kinds = [pa.int32(), *[pa.binary()] * 4, pa.list_(pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["range", "trigger", "string", "owner", "start", "keys"])

        rows, size = [], 0
        for batch in batches:
            for key, text, compare in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if key in seen:
                    continue
                seen.add(key)
                raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                entry = np.unique(np.frombuffer(b"".join(compare), dtype=PHRASE))
                for at in range(0, len(raw), CHUNK):
                    here = entry[(entry["first"] >= at) & (entry["first"] < at + CHUNK)]
                    if not len(here):
                        continue
                    sums = parser.sums(raw[at : at + CHUNK + 2 * length])
                    first, n = here["first"].astype(np.int64) - at, here["count"].astype(np.int64) + 1
                    begin = first + here["trigger"]
                    trigger = parser.hashes(sums, begin, begin + parser.gram)
                    start = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    rows.append((key, np.repeat(trigger, n), parser.hashes(sums, start, start + length), start + at))
                    size += len(start)
                if size >= 1 << 20:
                    yield told(rows)
                    rows, size = [], 0
        if rows:
            yield told(rows)

    return run


def settle_suffixes(group: pd.DataFrame) -> pd.DataFrame:
    """Places of strings that another dictionary phrase has too, by document."""
    trigger = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in group["trigger"]])
    string = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in group["string"]])
    order = np.lexsort((string, trigger))
    same = (trigger[order][1:] == trigger[order][:-1]) & (string[order][1:] == string[order][:-1])
    both = np.zeros(len(order), dtype=bool)
    both[1:] |= same
    both[:-1] |= same
    repeats = np.zeros(len(order), dtype=bool)
    repeats[order] = both
    keys, starts, at = [], [], 0
    for owner, start, texts in zip(group["owner"], group["start"], group["keys"], strict=True):
        owner, start = np.frombuffer(owner, dtype=np.uint32), np.frombuffer(start, dtype="<u4")
        told = np.flatnonzero(repeats[at : at + len(owner)])
        at += len(owner)
        for i, some in by_owner(owner[told], len(texts)):
            keys.append(texts[i])
            starts.append(start[told[some]].tobytes())
    return pd.DataFrame({"key": pd.Series(keys, dtype=object), "starts": pd.Series(starts, dtype=object)})


def cut_out(raw: bytes, length: int, whole: bool, repeats: list[bytes], starts: list[bytes]) -> tuple[bytes, list[dict]]:
    """What is left of a text, and the removed runs."""
    if whole and len(raw) >= length:
        return b"", [{"start": 0, "end": len(raw)}]
    entry = np.frombuffer(b"".join(repeats), dtype=PHRASE)
    single = np.frombuffer(b"".join(starts), dtype="<u4").astype(np.int64)
    low = np.concatenate([entry["first"].astype(np.int64), single])
    high = np.concatenate([entry["first"].astype(np.int64) + entry["count"], single]) + length
    if not len(low):
        return raw, []
    order = np.argsort(low, kind="stable")
    low, top = low[order], np.maximum.accumulate(high[order])
    new = np.ones(len(low), dtype=bool)
    new[1:] = low[1:] > top[:-1]
    begins = low[new]
    ends = top[np.append(np.flatnonzero(new)[1:], len(low)) - 1]
    kept = [raw[a:b] for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(raw)], strict=True)]
    return b"".join(kept), [{"start": a, "end": b} for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def remove_repeats(
    docs: DataFrame, text: str = "text", length: int = LENGTH, kept: str = "kept", removed: str = "removed",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the bytes of each text that no repeated string of ``length`` bytes covers, and the maximal
    runs of the others (``start``, ``end`` in bytes).

    Repeated means that the string starts at another place too, in any document or the same one, and
    overlapping; all are judged on the texts as they are. Of several rows with the same text none
    keeps a repeated string. A missing or empty text, or a short one, stays as it is (empty bytes for a
    missing one). Columns of the same names are replaced. ``length`` lies between 16 and 500.
    """
    if not 16 <= length <= 500:
        raise ValueError("strings of 16 to 500 bytes can be compared")
    stay = columns_besides(docs, (kept, removed), keep)
    carried = stay if text in stay else [*stay, text]
    at = carried.index(text)
    key = text_key(F.col(text))
    texts = docs.filter(F.octet_length(F.col(text)) >= length).select(key.alias("key"), F.col(text).alias("text"))
    volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(1 << 20, max(LEAST_RANGES, volume // TEXT_PER_RANGE))

    kinds = "range int, trigger binary, phrase binary, more binary, owner binary, entry binary, keys array<binary>, sure array<struct<key: binary, entries: binary>>"
    told = texts.mapInArrow(announce_phrases(length, ranges), kinds)
    settled = materialize(told.groupBy("range").applyInPandas(settle_phrases, "key binary, repeats binary, compare binary"), "phrases")

    compare = settled.filter("octet_length(compare) > 0").groupBy("key").agg(F.collect_list("compare").alias("compare"))
    again = texts.join(materialize(compare, "compare"), "key").select("key", "text", "compare")
    kinds = "range int, trigger binary, string binary, owner binary, start binary, keys array<binary>"
    told = again.mapInArrow(announce_suffixes(length, ranges), kinds)
    starts = told.groupBy("range").applyInPandas(settle_suffixes, "key binary, starts binary")

    none = F.lit(None).cast("binary")
    marks = settled.filter("octet_length(repeats) > 0").select("key", "repeats", none.alias("starts"), F.lit(0).alias("n"))
    marks = marks.unionByName(starts.select("key", none.alias("repeats"), "starts", F.lit(0).alias("n")))
    marks = marks.unionByName(texts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", none.alias("repeats"), none.alias("starts"), "n"))
    marks = marks.groupBy("key").agg(F.collect_list("repeats").alias("repeats"), F.collect_list("starts").alias("starts"), F.max("n").alias("n"))
    marks = materialize(marks, "marks").toDF("_key_", "_repeats_", "_starts_", "_n_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, n, repeats, single = (batch.column(i).to_pylist() for i in (at, *range(len(carried), len(carried) + 3)))
            out = [cut_out((t or "").encode("utf-8", "surrogatepass"), length, bool(c), r or [], s or []) for t, c, r, s in zip(raw, n, repeats, single, strict=True)]
            runs = pa.array([x for _, x in out], pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()})))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(stay)], pa.array([x for x, _ in out], pa.binary()), runs], names=[*stay, kept, removed])

    rows = docs.select(*carried, key.alias("_key_")).join(marks, "_key_", "left")
    schema = schema_with(docs.select(*stay), {kept: "binary", removed: "array<struct<start: int, end: int>>"})
    return rows.select(*carried, "_n_", "_repeats_", "_starts_").mapInArrow(run, schema)
