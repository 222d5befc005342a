"""Words of whole texts as numpy arrays, with 64-bit names that are the same everywhere.

A word is a run of bytes outside 0x20 and 0x09-0x0D.  Its name is a polynomial
hash of its bytes, mixed with its length: equal words have equal names in any
task, so names can be shuffled, joined and compared without a dictionary.
Texts are taken in chunks of about a megabyte; a longer text is a chunk alone,
hashed block by block.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a one-to-one scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    step = np.uint64(base)
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * step
        done += take
        step = step * step
    return out


class _Tables:
    """Powers of the base, made once in a worker."""

    powers: np.ndarray | None = None
    inverse: np.ndarray | None = None
    values = None
    trim = None

    @classmethod
    def get(cls):
        if cls.powers is None:
            with np.errstate(over="ignore"):
                cls.inverse = _powers(_BASE_INV, CHUNK + 1)
                cls.values = seeds(256, 11)
                cls.powers = _powers(_BASE, CHUNK + 1)
        return cls.powers, cls.inverse, cls.values


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """h with h[e] - h[s], times the inverse power of s, naming bytes s..e of a buffer of at most CHUNK bytes."""
    powers, _, values = _Tables.get()
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(values[buf] * powers[: len(buf)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse, _ = _Tables.get()
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


@dataclass
class Chunk:
    """Rows of a batch: ``buf`` holds their texts, row i at off[i]..off[i+1]."""

    lo: int
    hi: int
    buf: np.ndarray
    off: np.ndarray

    def text(self, i: int) -> bytes:
        return self.buf[self.off[i] : self.off[i + 1]].tobytes()


@dataclass
class Words:
    """Word w spans start[w]..end[w] of the chunk; row i has words first[i]..first[i+1]."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    name: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Chunk]:
    """Consecutive rows of about ``size`` bytes; a null text is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, side="right")) - 1)
        hi = min(hi, n)
        yield Chunk(lo, hi, buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi
    _release()


def _release() -> None:
    """Gives memory of finished chunks back: a worker is used again by later stages, which need it."""
    pa.default_memory_pool().release_unused()
    if _Tables.trim is None:
        try:
            _Tables.trim = ctypes.CDLL("libc.so.6").malloc_trim
        except (OSError, AttributeError):  # another C library
            _Tables.trim = lambda _: 0
    _Tables.trim(0)


def _bounds(buf: np.ndarray, off: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words; a word ends with its row."""
    inside = ~space[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = off[:-1]
    heads = heads[heads < len(buf)]
    begins[heads] |= inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = off[1:]
    tails = tails[tails > 0] - 1
    ends[tails] |= inside[tails]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _long_names(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of the words of one long text, some blocks of words at a time."""
    out = np.empty(len(start), np.uint64)
    powers, inverse, values = _Tables.get()
    i = 0
    while i < len(start):
        base = start[i]
        j = int(np.searchsorted(end, base + CHUNK, side="right"))
        if j > i:
            h = prefix_hash(buf[base : end[j - 1]])
            out[i:j] = span_hash(h, start[i:j] - base, end[i:j] - base)
            i = j
            continue
        # One word longer than a block: fold its blocks.
        total, at, scale = np.uint64(0), base, np.uint64(1)
        while at < end[i]:
            part = buf[at : min(at + CHUNK, end[i])]
            total = total + scale * np.sum(values[part] * powers[: len(part)], dtype=np.uint64)
            scale = scale * powers[CHUNK]
            at += CHUNK
        out[i] = mix(np.array([total + np.uint64(end[i] - base)], np.uint64))[0]
        i += 1
    return out


def words(chunk: Chunk, space: np.ndarray = SPACE) -> Words:
    with np.errstate(over="ignore"):
        start, end = _bounds(chunk.buf, chunk.off, space)
        if len(chunk.buf) <= CHUNK:
            name = span_hash(prefix_hash(chunk.buf), start, end)
        else:
            name = _long_names(chunk.buf, start, end)
    return Words(start, end, np.searchsorted(start, chunk.off), name)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)


def grams(name: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Rolling names of n words in a row, by word position (the last n - 1 positions have none)."""
    m = len(name) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        k = seeds(n, 101 + seed)
        out = name[:m] * (k[0] | np.uint64(1))
        for j in range(1, n):
            out = out + name[j : j + m] * (k[j] | np.uint64(1))
        return mix(out)


def batch(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        v = columns[field.name]
        arrays.append(v if isinstance(v, pa.Array) else pa.array(v, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def pieces(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    """Binary values: bytes at[i]..at[i+1] of ``flat``."""
    flat = np.ascontiguousarray(flat).view(np.uint8)
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.binary())
