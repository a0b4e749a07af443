"""Words of a block of texts as numbers, and Rabin-Karp hashes of their n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

from riskloom.llm.common import group_bounds

#: Odd multipliers of the two polynomials, modulo 2^64.
BASES = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


class _Numbered(dict):
    def __missing__(self, key):
        value = self[key] = len(self)
        return value


def word_values(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every word; each distinct word is hashed once."""
    index = _Numbered()
    codes = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    table = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, index)), "<u8").reshape(-1, 2)
    return table[codes, 0], table[codes, 1]


def rolling(values: np.ndarray, n: int, base: int) -> np.ndarray:
    """The hash of each ``n`` consecutive values: sum of value times base^(distance to the last), modulo 2^64. Prefix
    sums over negative powers make it one subtraction and one product a position."""
    size = len(values)
    if size < n:
        return np.zeros(0, np.uint64)
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    prefix = np.zeros(size + 1, np.uint64)
    np.cumsum(values * np.cumprod(down), out=prefix[1:])
    return mixed((prefix[n:] - prefix[:-n]) * np.cumprod(up)[n - 1 :])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits one to one; the low bits of a polynomial modulo 2^64 are weak."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def by_bucket(buckets: np.ndarray, count: int) -> Iterable[tuple[int, np.ndarray]]:
    """The positions of each bucket that occurs, in ascending order."""
    order = np.argsort(buckets.astype(np.uint16) if count <= 1 << 16 else buckets, kind="stable")
    found, starts = np.unique(buckets[order], return_index=True)
    for bucket, own in zip(found.tolist(), np.split(order, starts[1:])):
        yield bucket, own


def each(key: str, work: Callable[[pa.Table], Iterator[dict]]) -> Callable[[pa.Table], Iterator[dict]]:
    """For ``common.runs``, which passes several whole groups at a time: ``work`` gets one."""
    def run(groups: pa.Table):
        bounds = group_bounds(groups.column(key).to_numpy())
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield from work(groups.slice(a, b - a))
    return run


def arrays(group: pa.Table, name: str, kind: str) -> list[np.ndarray]:
    """The packed numbers of a binary column, one array a row."""
    return [np.frombuffer(b or b"", kind) for b in group.column(name).to_pylist()]


def planes(ascending: np.ndarray) -> bytes:
    """Ascending numbers below 2^32 as gaps, their low bytes first and then the higher ones, mostly zeros that the
    shuffle's compression removes."""
    return np.diff(ascending, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(held: bytes | None) -> np.ndarray:
    low = np.frombuffer(held or b"", np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(low).view("<u4").ravel(), dtype=np.int64)
