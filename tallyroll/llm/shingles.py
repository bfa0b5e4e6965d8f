"""Sets of word shingles, whole Arrow batches at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (xor, shift, multiply)."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64))
_P = 0x9E3779B97F4A7C15 | 1


#: Powers are multiplied in blocks of so many, so that long texts need no table of their length.
_BLOCK = 1 << 14


@lru_cache(maxsize=16)
def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        some = min(done, n - done)
        out[done : done + some] = out[:some] * np.uint64(pow(base, done, 1 << 64))
        done += some
    return out


def _power_at(base: int, places: np.ndarray, n: int) -> np.ndarray:
    """base**place of places below n."""
    far = _powers(pow(base, _BLOCK, 1 << 64), max(_BLOCK, n // _BLOCK + 1))
    return far[places // _BLOCK] * _powers(base, _BLOCK)[places % _BLOCK]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: none) and where each text begins, with the end."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(raw: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of all words (no word crosses the places `begin`), and which are the first
    of the stretches from one such place to the next, with the end."""
    visible = ~_SPACE[raw]
    first, last = visible.copy(), visible.copy()
    first[1:] &= ~visible[:-1]
    last[:-1] &= ~visible[1:]
    inner = begin[(begin > 0) & (begin < len(raw))]
    first[inner] |= visible[inner]
    last[inner - 1] |= visible[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, begin)


def hashes_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _P) -> np.ndarray:
    """64-bit hashes of stretches of bytes: the sum of byte values times powers of an odd base,
    divided by the power of the stretch's place."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = _BYTE[raw]
    near = _powers(base, _BLOCK)
    for at in range(0, len(raw), _BLOCK):
        some = sums[at : at + _BLOCK]
        some *= near[: len(some)] * np.uint64(pow(base, at, 1 << 64))
    np.cumsum(sums, out=sums)
    out = sums[ends - 1]
    later = starts > 0
    out[later] -= sums[starts[later] - 1]
    del sums
    return mix(out * _power_at(pow(base, -1, 1 << 64), starts, len(raw)))


def word_hashes(column: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a column, and where each text's words begin, with the end."""
    raw, begin = text_bytes(column)
    if lower:
        raw = _LOWER[raw]
    starts, ends, first = word_bounds(raw, begin)
    return hashes_of(raw, starts, ends), first


def shingle_sets(column: pa.Array, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed k-word shingles of each text, ascending, one after another, and where
    each text's begin, with the end. Fewer than k words make one shingle; no words none."""
    words, begin = word_hashes(column, lower)
    n = np.diff(begin)
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), size)
    at = begin[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    length = np.minimum(n[owner], k)
    h = mix(length.astype(np.uint64), 1)
    for j in range(k):
        inside = j < length
        h[inside] = mix(h[inside] ^ words[at[inside] + j], 2)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.searchsorted(owner[new], np.arange(len(n) + 1))


def sums_by(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit integers by index, modulo 2**64."""
    low = np.bincount(index, values & np.uint64(0xFFFFFFFF), n).astype(np.uint64)
    high = np.bincount(index, values >> np.uint64(32), n).astype(np.uint64)
    return low + (high << np.uint64(32))
