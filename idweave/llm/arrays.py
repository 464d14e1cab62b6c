"""Texts of an Arrow batch as one byte array, with hashes of any of its ranges.

The hash of bytes ``b[s:e]`` is ``sum(b[i] * B**(i - s))`` modulo 2**64 over an odd base. Prefix sums
give it for any range with two look-ups. All hashes are the same on every machine and in every task. Modulo a power of two,
such sums have known collisions between sequences of two symbols from about a thousand on, so long words get a hash of another kind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Texts are worked on in groups of about so many bytes; one longer text is a group of its own.
CHUNK = 1 << 19
#: Words of so many bytes and more are hashed one by one.
LONG_WORD = 256

#: Word separators: blank and the control characters 9 to 13.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII characters but letters and digits.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=4)
def _powers(base: int, log2: int) -> np.ndarray:
    out = np.full(1 << log2, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64."""
    log2 = max(20, int(n).bit_length())
    if log2 > 21:
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        return np.cumprod(out, out=out)
    return _powers(base, log2)[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scrambles 64-bit values so that all bits depend on all bits."""
    x = x ^ np.uint64((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Ranges:
    """Hashes of ranges of a sequence of integers."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * powers(BASE, n), out=self.prefix[1:])
        self.inverse = powers(INVERSE, n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def windows(self, length: int) -> np.ndarray:
        """The hash of every window of this length; empty if there is none."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[length:] - self.prefix[:n]) * self.inverse[:n] + np.uint64(length))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null rows are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str, size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``size`` bytes of text, with their bytes and row offsets."""
    raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield batch.slice(at, end - at), raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end
    # Workers live on between tasks and would keep what they no longer need.
    pa.default_memory_pool().release_unused()


class Words:
    """The words of a chunk: ``start`` and ``end`` in bytes, ``first[i] .. first[i + 1]`` those of row i."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False, separator: np.ndarray = SEPARATOR):
        self.raw = LOWER[raw] if lower else raw
        inside = ~separator[raw]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        breaks = offsets[:-1]
        breaks = breaks[breaks < len(raw)]
        before[breaks] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        ends = offsets[1:] - 1
        after[ends[ends >= 0]] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        out = Ranges(self.raw).hash(self.start, self.end)
        for i in np.flatnonzero(self.end - self.start >= LONG_WORD):
            word = self.raw[self.start[i] : self.end[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of ``n`` words, and ``first[i] .. first[i + 1]``, those of row i. A row with fewer words
    has its whole sequence as the only one; a row without words has none."""
    ranges = Ranges(words.hashes())
    count = np.diff(words.first)
    number = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(number)])
    start = np.arange(first[-1]) - np.repeat(first[:-1], number) + np.repeat(words.first[:-1], number)
    return ranges.hash(start, start + np.repeat(np.minimum(count, n), number)), first
