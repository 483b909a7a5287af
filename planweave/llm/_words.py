"""Words of whole texts as arrays: spans, hashes and windows for a batch of documents at a time.

A word is a run of bytes other than space and 9..13, so that a text's words are
those of ``[^\\x20\\x09-\\x0D]+`` for any UTF-8 text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 5
INVERSE = pow(BASE, -1, 1 << 64)
MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += np.uint64(32)
    return mix(b + np.uint64(0x632BE59BD9B4E019))


class Hasher:
    """Word hashes of a byte buffer by prefix sums; holds the powers it needs."""

    def __init__(self, lower: bool):
        self.values = _byte_values(lower)
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 1 << 16)
            self.power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, BASE & MASK, np.uint64)]))
            self.inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, INVERSE, np.uint64)]))

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        self._grow(len(data) + 1)
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.values[data] * self.power[: len(data)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document and the total) of all words."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def pieces(texts: pa.Array, most: int = 2 << 20):
    """Slices of a string array of about `most` bytes each, one document at least."""
    texts = texts.fill_null("")
    _, offsets = buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, texts.slice(at, to - at)
        at = to


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of every run of n words that stays in one document; positions count the batch's words."""
    counts = np.diff(first)
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total = total * np.uint64(0xD1342543DE82EF95) + hashes[k : len(hashes) - n + 1 + k]
    last = np.repeat(first[1:], counts)
    at = np.arange(len(total))
    ok = at + n <= last[: len(total)]
    return mix(total[ok]), at[ok]


def text_key(text: bytes) -> int:
    """A signed 64-bit key of a whole text."""
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63)
