"""Numpy kernels over Arrow string columns: word bounds and word hashes.

Everything works on UTF-8 bytes.  A-Z is folded to a-z through a byte table,
so no text is copied or decoded.  Texts are handled in chunks of a few MB
(one longer text is a chunk of its own), which bounds the scratch arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_SEED = 20240607
_MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_MULT_INV = pow(_MULT, -1, 1 << 64)


def fold_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 0x20
    return t


def space_words() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, dtype=bool)
    t[0x20] = False
    t[0x09:0x0E] = False
    return t


def letter_digit_words() -> np.ndarray:
    """Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after folding A-Z."""
    t = np.zeros(256, dtype=bool)
    t[0x30:0x3A] = True
    t[0x41:0x5B] = True
    t[0x61:0x7B] = True
    t[0x80:] = True
    return t


def byte_values(seed: int = _SEED) -> np.ndarray:
    """A random 64-bit value for each byte; upper and lower case agree."""
    v = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    return v[fold_table()]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


class Powers:
    """Powers of the hash multiplier and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                ones = np.full(n, _MULT, dtype=np.uint64)
                ones[0] = 1
                self.up = np.multiply.accumulate(ones)
                ones = np.full(n, _MULT_INV, dtype=np.uint64)
                ones[0] = 1
                self.down = np.multiply.accumulate(ones)
        return self.up, self.down


def utf8_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls have no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    n = len(col)
    bufs = col.buffers()
    if n == 0 or bufs[1] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    off = np.frombuffer(bufs[1], dtype=kind)[col.offset: col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, dtype=np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes, or one longer text."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each text) of all words; words end with their text.

    ``offsets`` are relative to ``data``; the last result has a closing entry."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(offsets), dtype=np.int64)
    m = table[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = m[:-1]
    edge = offsets[:-1][offsets[:-1] < n]
    before[edge] = False
    starts = np.flatnonzero(m & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = m[1:]
    edge = offsets[1:][(offsets[1:] > 0) & (offsets[1:] <= n)] - 1
    after[edge] = False
    ends = np.flatnonzero(m & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit polynomial hashes of byte spans, independent of their position."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers.get(len(data) + 1)
    with np.errstate(over="ignore"):
        acc = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=acc[1:])
        h = (acc[ends] - acc[starts]) * down[starts]
        return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
