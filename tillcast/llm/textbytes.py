"""Vectorised text primitives over the UTF-8 bytes of an Arrow string column.

All functions work on a *slice*: a bounded run of rows whose bytes lie in one contiguous
buffer (``slices``), so memory is bounded by the slice size or by the longest single text.
Null texts are empty texts here; callers that tell them apart look at the validity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
U64 = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, element by element."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def sequence64(seed: int, n: int) -> np.ndarray:
    """n reproducible 64-bit values (splitmix64 stream)."""
    return mix64(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


BYTE_VALUE = sequence64(11, 256)
BASE = 0x9E3779B97F4A7C17 & ~3 | 3  # odd, BASE - 1 is 2 mod 4
BASE_INV = pow(BASE, -1, 1 << 64)
GRAM_FACTOR = sequence64(23, 16) | U64(1)


class _Powers:
    """Powers of BASE and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.r_[U64(1), np.full(size - 1, BASE, dtype=U64)], dtype=U64)
            self.down = np.cumprod(np.r_[U64(1), np.full(size - 1, BASE_INV, dtype=U64)], dtype=U64)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def byte_class(members: bytes | range | list[int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


# Words of the contracts: every byte but space and \t \n \v \f \r ...
SPACE_WORD = ~byte_class([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
# ... or letters, digits and every non-ASCII character.
ALNUM_WORD = byte_class([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
CONTINUATION = byte_class(range(0x80, 0xC0))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets): rows in order, ``most`` bytes at a time (one row at least)."""
    if not len(texts):
        return
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if texts.null_count:
        texts = pc.fill_null(texts, "" if not pa.types.is_binary(texts.type) else b"")
    _, off, buf = texts.buffers()
    off = np.frombuffer(off, dtype=np.int64 if large else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, dtype=np.uint8)
    lo, n = 0, len(texts)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row, with the total last): maximal runs of ``cls`` bytes within rows."""
    inside = cls[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.r_[False, inside[:-1]]
    after = np.r_[inside[1:], False]
    cut = offsets[:-1]
    before[cut[cut < len(data)]] = False
    cut = offsets[1:]
    after[cut[cut > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] of every span, equal for equal bytes wherever they stand."""
    return run_hashes(BYTE_VALUE[data], starts, ends)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same over any 64-bit values of the places."""
    up, down = _POWERS.get(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words of one array of word hashes (runs may cross rows: callers cut)."""
    if len(words) < n:
        return np.zeros(0, dtype=U64)
    out = words[:len(words) - n + 1] * GRAM_FACTOR[0]
    for j in range(1, n):
        out = out + mix64(words[j:len(words) - n + 1 + j]) * GRAM_FACTOR[j % 16] * U64(2 * (j // 16) + 1)
    return mix64(out + U64(n))


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i + 1]] of every row (empty rows: 0)."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
