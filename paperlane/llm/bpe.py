"""Byte-level BPE by speculation and verification.

A word is first cut greedily into the longest tokens. That proposal is the exact encoding if every
token encodes to itself and every two neighbours are compatible, that is, encode to themselves when
joined; both are facts about the vocabulary, worked out once per token or pair and remembered.
The distinct pairs of many new words are tested together; only words with a pair that fails are
merged step by step.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame

from paperlane.llm.tasks import map_texts

# Fixed value: the word pattern of byte-level BPE files that name no other.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
REMEMBERED_WORDS, REMEMBERED_PAIRS, LONGEST_REMEMBERED = 300_000, 200_000, 64
SHORT, NEVER = 64, 1 << 62


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Encoder and decoder for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, letters = data["model"], byte_letters()
        before = data["pre_tokenizer"]
        plain = before["type"] == "ByteLevel" and not before["add_prefix_space"] and before["use_regex"]
        if model["type"] != "BPE" or data["normalizer"] or not plain or model.get("ignore_merges"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        added = {x["content"]: x["id"] for x in data["added_tokens"]}
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in data["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take in white space")

        as_bytes = {token: bytes(letters[c] for c in token) for token in model["vocab"] if token not in added}
        self.ids = {as_bytes[t]: i for t, i in model["vocab"].items() if t in as_bytes}
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # left and right id of each merge: its rank (from 1) and the id that results
        self.ranked = {
            self.ids[as_bytes[a]] << 32 | self.ids[as_bytes[b]]: rank << 32 | self.ids[as_bytes[a] + as_bytes[b]]
            for rank, (a, b) in enumerate(merges, 1)
        }
        self.bytes = [self.ids[bytes([b])] for b in range(256)]
        self.longest = max(map(len, self.ids))
        self.spelled = {i: t for t, i in self.ids.items()} | {i: c.encode() for c, i in added.items()}
        self.added = added
        self.split = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.words = regex.compile(WORDS)

        # spelling of all tokens end to end, for decoding by index
        size = max(self.spelled) + 1
        self.lengths = np.array([len(self.spelled.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(self.spelled.get(i, b"") for i in range(size)), dtype=np.uint8)

        self.known: dict[str, bytes] = {}
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}

    def forget(self) -> None:
        """Free the memory of what was learned about words and pairs."""
        self.known, self.fits = {}, {}

    def merge(self, word: bytes) -> list[int]:
        """Exact encoding of a word: again and again the pair of lowest rank, leftmost first."""
        if len(word) > SHORT:
            return self._merge_long(word)
        ids = [self.bytes[b] for b in word]
        ranked = self.ranked.get
        # rank and result of each pair of neighbours, as one number
        ranks = [ranked(a << 32 | b, NEVER) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            ids[i : i + 2] = [best & 0xFFFFFFFF]
            del ranks[i]
            if i:
                ranks[i - 1] = ranked(ids[i - 1] << 32 | ids[i], NEVER)
            if i < len(ranks):
                ranks[i] = ranked(ids[i] << 32 | ids[i + 1], NEVER)
        return ids

    def _merge_long(self, word: bytes) -> list[int]:
        """The same with a queue of pairs, for words of any length."""
        ids = [self.bytes[b] for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(ids) and (found := self.ranked.get(ids[i] << 32 | ids[after[i]])):
                heapq.heappush(queue, (found >> 32, i, ids[i], ids[after[i]], found & 0xFFFFFFFF))

        for i in range(len(ids) - 1):
            offer(i)
        while queue:
            _, i, left, right, joined = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = joined, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Longest tokens from left to right, of those that encode to themselves."""
        ids, whole, start, end = self.ids, self.whole, 0, len(word)
        found = []
        while start < end:
            stop = min(end, start + self.longest)
            while True:
                token = ids.get(word[start:stop])
                if token is not None:
                    good = whole.get(token)
                    if good is None:
                        good = whole[token] = self.merge(word[start:stop]) == [token]
                    if good:
                        break
                stop -= 1
            found.append(token)
            start = stop
        return found

    def _fit(self, pair: int) -> bool:
        left, right = pair >> 32, pair & 0xFFFFFFFF
        return self.merge(self.spelled[left] + self.spelled[right]) == [left, right]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Encodings of many distinct words, verified together."""
        spelled = [w.encode("utf-8", "surrogatepass") for w in words]
        proposed = [self.propose(w) for w in spelled]
        sizes = np.array([len(p) for p in proposed])
        ids = np.array([i for p in proposed for i in p], dtype=np.int64)
        ends = np.cumsum(sizes)
        pairs = ids[:-1] << 32 | ids[1:]
        inside = np.ones(max(len(ids) - 1, 0), dtype=bool)
        inside[ends[:-1] - 1] = False
        places = np.flatnonzero(inside)
        distinct, which = np.unique(pairs[places], return_inverse=True)
        if len(self.fits) > REMEMBERED_PAIRS:
            self.fits.clear()
        good = np.empty(len(distinct), dtype=bool)
        for k, pair in enumerate(distinct.tolist()):
            fit = self.fits.get(pair)
            if fit is None:
                fit = self.fits[pair] = self._fit(pair)
            good[k] = fit
        failing = np.unique(np.searchsorted(ends, places[~good[which]], "right"))
        out = np.split(ids.astype("<u4"), ends[:-1])
        for k in failing.tolist():
            out[k] = np.array(self.merge(spelled[k]), dtype="<u4")
        return out

    def _pieces(self, text: str) -> Iterator[tuple[str, bytes]]:
        """Text between added tokens, each with the added token that follows."""
        at = 0
        for found in self.split.finditer(text) if self.split else ():
            yield text[at : found.start()], np.uint32(self.added[found[0]]).astype("<u4").tobytes()
            at = found.end()
        yield text[at:], b""

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        cut = [[(self.words.findall(piece), end) for piece, end in self._pieces(text)] for text in texts]
        new = {w for pieces in cut for words, _ in pieces for w in words}.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED_WORDS:
            self.known.clear()
            new = {w for pieces in cut for words, _ in pieces for w in words}
        long = {}
        if new:
            new = sorted(new)
            for word, ids in zip(new, self.encode_words(new), strict=True):
                (self.known if len(word) <= LONGEST_REMEMBERED else long)[word] = ids.tobytes()
        known = self.known | long if long else self.known
        return [
            b"".join(x for words, end in pieces for x in (*map(known.__getitem__, words), end)) for pieces in cut
        ]

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters."""
        tokens = np.frombuffer(ids, dtype="<u4")
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[tokens] - (ends - lengths), lengths)
        return self.flat[places].tobytes().decode("utf-8", "replace")


def codec_of(vocabulary: str) -> ByteBpe:
    """The codec of a file, kept as long as the Python worker lives, without the words it knows."""
    kept = sys.__dict__.setdefault("_paperlane_codecs", {})
    if vocabulary not in kept:
        kept[vocabulary] = ByteBpe(vocabulary)
    return kept[vocabulary]


def round_trip(
    df: DataFrame, text: str, vocabulary: str, ids: str = "ids", decoded: str = "decoded",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the token ids of each text and the text decoded from them.

    A missing text counts as empty: no ids, an empty text. Columns of the same names are replaced;
    every row is handled on its own, so repeated rows stay. ``vocabulary`` is a path that exists on
    every executor.
    """

    def start():
        codec = codec_of(vocabulary)

        def work(texts: list[str]) -> list[list]:
            found = codec.encode(texts)
            return [[np.frombuffer(x, dtype="<u4").astype(np.int32) for x in found], [codec.decode(x) for x in found]]

        return work

    return map_texts(df, text, {ids: "array<int>", decoded: "string"}, start, keep, lambda: codec_of(vocabulary).forget())


def round_trip_digests(df: DataFrame, text: str, vocabulary: str, keep: Sequence[str] | None = None) -> DataFrame:
    """The same as three narrow columns, made where the ids are: ``n_tokens``, ``ids_sha256`` (of the
    ids as little-endian 32-bit numbers) and ``decoded_sha256``."""

    def start():
        codec = codec_of(vocabulary)

        def work(texts: list[str]) -> list[list]:
            found = codec.encode(texts)
            return [
                [len(x) // 4 for x in found],
                [hashlib.sha256(x).hexdigest() for x in found],
                [hashlib.sha256(codec.decode(x).encode()).hexdigest() for x in found],
            ]

        return work

    added = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return map_texts(df, text, added, start, keep, lambda: codec_of(vocabulary).forget())
