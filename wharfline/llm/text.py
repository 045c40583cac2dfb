"""Helpers that run inside tasks: Arrow columns in blocks of bounded bytes, word bounds, word and window hashes.

Words are runs of ``[^\\x20\\x09-\\x0D]``.  All hashing is done with numpy over the UTF-8 bytes of a block of
documents, so that no Python object is made per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def binary(column: pa.Array) -> pa.Array:
    """The column as large_binary without nulls (a null text is an empty one)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    return column.fill_null(b"") if column.null_count else column


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return free memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def lean(run: Run) -> Run:
    """``run`` for ``mapInArrow``, after which the worker gives free memory back.

    Workers wait for their next task; what they keep would count against an executor for as long.
    """

    def then_tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return then_tidy


def offsets_and_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and the bytes of a ``binary`` column."""
    n = len(column)
    if not n:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``limit`` bytes of text, at least one row each, with offsets and bytes of the text."""
    if not batch.num_rows:
        return
    column = binary(batch.column(batch.schema.get_field_index(text)))
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, hi - lo), *offsets_and_bytes(column.slice(lo, hi - lo))
        lo = hi


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _UPPER[raw]


def word_bounds(offsets: np.ndarray, raw: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the bytes, and the number of words up to each document (as offsets)."""
    word = ~breaks[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)  # document starts
    edge[offsets] = True
    before = np.empty(len(raw) + 1, dtype=bool)
    before[0], before[1:] = False, word
    after = np.empty(len(raw) + 1, dtype=bool)
    after[:-1], after[-1] = word, False
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each word."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    total = np.concatenate(([0], np.cumsum(lengths)))
    inner = np.arange(total[-1]) - np.repeat(total[:-1], lengths)
    flat = raw[np.repeat(starts, lengths) + inner].astype(np.uint64) + np.uint64(1)
    flat *= powers(_BASE, int(lengths.max()))[inner]
    return mix(np.add.reduceat(flat, total[:-1]) + lengths.astype(np.uint64))


def ngrams(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``n`` consecutive entries (fewer entries: none)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    base = powers(np.uint64((0xD6E8FEB86659FD93 + 2 * seed) | 1), n)
    for k in range(n):
        out += words[k : len(words) - n + 1 + k] * base[k]
    return mix(out, seed + 1)


def windows(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Rolling (Rabin-Karp) hash of every window of ``n`` entries, in time that does not depend on ``n``."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    base = pow(0xC2B2AE3D27D4EB4F + 2 * seed, 1, 2**64) | 1
    inverse = np.uint64(pow(base, -1, 2**64))
    prefix = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers(np.uint64(base), len(words)), out=prefix[1:])
    return mix((prefix[n:] - prefix[:-n]) * powers(inverse, len(words) - n + 1), seed + 1)
