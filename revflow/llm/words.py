"""Words of whole texts as numpy arrays, one Arrow batch of documents at a time.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; UTF-8 keeps those
bytes out of longer characters, so byte positions suffice. Words and runs of
words get 64-bit polynomial hashes, whose prefix sums give the hash of any
window in constant time. NULL texts count as empty.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_Q = 0xD6E8FEB86659FD93
_STEP = 1 << 18
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least; grown as needed."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = -(-n // (1 << 16)) << 16
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        have = _powers[base] = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sums(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums from which ``span`` reads the hash of any run of values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def span(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    return (prefix[end] - prefix[start]) * powers(base, len(prefix))[1][start]


def windows(words: np.ndarray, k: int, base: int = _Q) -> np.ndarray:
    """Hash of each run of k words; runs cross documents, so callers mask those."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    g = sums(words, base)
    return mix((g[k:] - g[:-k]) * powers(base, len(g))[1][:n])


@dataclass
class Words:
    """Words of consecutive documents: byte spans, hashes, and each document's words."""

    data: np.ndarray  # bytes of the batch
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # behind its last byte
    hash: np.ndarray  # uint64
    first: np.ndarray  # words before each document, one more than documents

    @property
    def docs(self) -> int:
        return len(self.first) - 1

    def doc(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(self.docs), np.diff(self.first))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    low = offsets[0] if len(offsets) else 0
    return offsets - low, data[low : (offsets[-1] if len(offsets) else 0)]


def find_words(offsets: np.ndarray, data: np.ndarray, lower: bool) -> Words:
    inside = ~_SPACE[data]
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
        breaks = offsets[:-1]
        before[breaks[breaks < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    if len(data):
        after[:-1] = inside[1:]
        breaks = offsets[1:] - 1
        after[breaks[breaks >= 0]] = False
    end = np.flatnonzero(inside & ~after) + 1
    hashes = np.empty(len(start), np.uint64)
    table = _LOWER if lower else _BYTE
    cuts = np.unique(np.append(np.searchsorted(start, np.arange(0, len(data), _STEP)), len(start)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # a few bytes at a time bound the memory
        low = start[a]
        prefix = sums(table[data[low : end[b - 1]]], _P)
        hashes[a:b] = span(prefix, start[a:b] - low, end[a:b] - low, _P)
    hashes = mix(hashes + (end - start).astype(np.uint64))
    return Words(data, start, end, hashes, np.searchsorted(start, offsets))


def release() -> None:
    """Give freed memory back to the system, which a reused worker would keep for good."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def _libc():
    try:
        libc = ctypes.CDLL(ctypes.util.find_library("c"))
        return libc if hasattr(libc, "malloc_trim") else None
    except OSError:
        return None


_LIBC = _libc()


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = 1 << 19) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of a batch with about ``limit`` bytes of text (or one longer document), with its buffers."""
    if not batch.num_rows:
        return
    offsets, data = string_buffers(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        own = offsets[at : to + 1]
        yield batch.slice(at, to - at), own - own[0], data[own[0] : own[-1]]
        at = to
    release()
