"""64-bit hashes of words, shingles and byte strings, many at a time with numpy.

A string hashes to the sum of a random number per byte times a power of an odd base, modulo 2^64;
running sums give the hash of every substring. ``mix`` spreads the result over all bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose results look random."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_numbers(seed: int = 1) -> np.ndarray:
    """One random 64-bit number for each byte."""
    return mix(np.arange(256, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed << 32))


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a base modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def running(data: np.ndarray, numbers: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Running sums of a byte array, one more than there are bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(numbers[data] * up[: len(data)], out=out[1:])
    return out


def pieces(text: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """A long text cut at white space, so that no word is cut."""
    start = 0
    while len(text) - start > size:
        ends = [x for x in (text.find(s, start + size) for s in (SPACES[i : i + 1] for i in range(6))) if x >= 0]
        if not ends:
            break
        yield text[start : min(ends)]
        start = min(ends)
    yield text[start:]


class WordHasher:
    """Hashes of the words of texts; words are what white space parts."""

    def __init__(self):
        self.numbers = byte_numbers()
        self.is_word = np.ones(256, dtype=np.int8)
        self.is_word[list(SPACES)] = 0
        self.up = powers(BASE, 2 * CHUNK)
        self.down = powers(INVERSE, 2 * CHUNK)

    def _one(self, parts: list[bytes], owners: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
        if len(data) > len(self.up):
            self.up, self.down = powers(BASE, len(data)), powers(INVERSE, len(data))
        edges = np.flatnonzero(np.diff(self.is_word[data], prepend=np.int8(0)))
        starts, ends = edges[::2], edges[1::2]
        total = running(data, self.numbers, self.up)
        hashes = (total[ends] - total[starts]) * self.down[starts]
        hashes = mix(hashes + (ends - starts).astype(np.uint64))
        at = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        owner = np.array(owners)[np.searchsorted(at, starts, "right") - 1]
        return hashes, np.bincount(owner, minlength=n)

    def __call__(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all texts in order, and the number of words of each text."""
        found, counts = [], np.zeros(len(texts), dtype=np.int64)
        parts, owners, size = [], [], 0
        for i, text in enumerate(texts):
            for piece in pieces(text):
                parts.append(piece)
                owners.append(i)
                size += len(piece) + 1
                if size >= CHUNK:
                    hashes, n = self._one(parts, owners, len(texts))
                    found.append(hashes)
                    counts += n
                    parts, owners, size = [], [], 0
        if parts:
            hashes, n = self._one(parts, owners, len(texts))
            found.append(hashes)
            counts += n
        return (np.concatenate(found) if found else np.zeros(0, np.uint64)), counts


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case; a missing text is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()
