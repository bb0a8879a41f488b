"""Words and hashes of many texts at once, over the bytes of an Arrow column.

All functions work on a slice: the UTF-8 bytes of some texts one after another and the offsets that part them. The
hashes are polynomials in an odd base modulo 2**64, finished by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets from 0, bytes) of slices of about `limit` bytes, one row at least. Null counts as empty."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count and np.any(np.diff(at)[~column.is_valid().to_numpy(zero_copy_only=False)]):
        yield from slices(column.fill_null(b""), limit)
        return
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, at[first : last + 1] - at[first], data[at[first] : at[last]]
        first = last


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; n at least."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix(data: np.ndarray) -> np.ndarray:
    """Running sums of byte times power; differences of it give the hash of any range."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data))[: len(data)], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of bytes[start:end] for each pair; equal bytes give equal hashes in every slice."""
    h = (sums[ends] - sums[starts]) * powers(_INVERSE, len(sums))[starts]
    return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, at: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte ranges of all words, and per text the index of its first word (one entry more)."""
    inside = is_word[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    opens, closes = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    opens[at[:-1]] = True
    closes[at[1:]] = True  # the end of a text is the place after its last byte
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    starts = np.flatnonzero(inside & (~before | opens[:-1]))
    ends = np.flatnonzero(inside & (~after | closes[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def window_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of k consecutive word hashes, for each start at which k follow."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    acc = h[: len(h) - k + 1].copy()
    for j in range(1, k):
        acc *= np.uint64(0xD1342543DE82EF95)
        acc += h[j : len(h) - k + 1 + j]
    return mixed(acc + np.uint64(k))


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)
