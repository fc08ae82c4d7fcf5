"""Counting quotient filters over n-grams of word ids, as sorted numpy arrays and as bytes.

An n-gram of up to three ids of ``bits`` bits each (0 stands for no word) is packed into one integer and
permuted by a Feistel network, which can be undone: nothing is lost, and any range of the permuted integers
holds its share of the different n-grams. The first bits tell the shard. In a filter the next bits are the
quotient, which is not stored but says in which of the 2^q runs an entry stands; the full remainder of every
entry is stored, run after run. Two bits an entry tell the runs apart: one for every quotient that occurs, one
for the last entry of every run. A counter takes a byte; larger ones are listed behind.

Filters are sorted by the permuted integer, so merging them is merging sorted sequences.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

# Odd multipliers of the rounds of the permutation.
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
# A counter of that much or more is listed behind the others.
LARGE = 255
HEAD = "<qqB"


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _mix(x: np.ndarray, i: int, half: int) -> np.ndarray:
    y = (x + np.uint64(i + 1)) * np.uint64(ROUNDS[i])
    return ((y ^ (y >> np.uint64(29))) * np.uint64(ROUNDS[i - 1])) >> np.uint64(64 - half)


@dataclass(frozen=True)
class Layout:
    """How n-grams of ids of ``bits`` bits (at most 32) are packed and permuted.

    ``top`` bits come first in the order; the other ``low`` ones are held apart only where 64 bits do not
    hold all.
    """
    bits: int

    @property
    def half(self) -> int:
        return (3 * self.bits + 1) // 2

    @property
    def top(self) -> int:
        return 2 * self.half if 2 * self.half <= 64 else self.half

    @property
    def low(self) -> int:
        return 2 * self.half - self.top

    def permuted(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        a, b, c = (x.astype(np.uint64) for x in (a, b, c))
        half, last = self.half, (b << np.uint64(self.bits)) | c
        left = (a << np.uint64(2 * self.bits - half)) | (last >> np.uint64(half))
        right = last & _mask(half)
        for i in range(len(ROUNDS)):
            left, right = right, left ^ _mix(right, i, half)
        return (left, right) if self.low else ((left << np.uint64(half)) | right, None)

    def ids(self, top: np.ndarray, low: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The n-grams of permuted integers."""
        half = self.half
        left, right = (top, low) if self.low else (top >> np.uint64(half), top & _mask(half))
        for i in reversed(range(len(ROUNDS))):
            left, right = right ^ _mix(left, i, half), left
        last = (left << np.uint64(half)) | right
        return (left >> np.uint64(2 * self.bits - half), (last >> np.uint64(self.bits)) & _mask(self.bits), last & _mask(self.bits))


@dataclass
class Filter:
    """Different permuted n-grams in order, with their counts."""
    top: np.ndarray
    low: np.ndarray | None
    counts: np.ndarray

    def __len__(self) -> int:
        return self.top.size

    def part(self, a: int, b: int) -> Filter:
        return Filter(self.top[a:b], None if self.low is None else self.low[a:b], self.counts[a:b])


def merged(filters: list[Filter]) -> Filter:
    """One filter with the sums of the counts; the parts may be unsorted and hold n-grams repeatedly."""
    top, counts = np.concatenate([f.top for f in filters]), np.concatenate([f.counts for f in filters])
    low = None if filters[0].low is None else np.concatenate([f.low for f in filters])
    order = np.argsort(top, kind="stable") if low is None else np.lexsort((low, top))
    top, counts, low = top[order], counts[order], None if low is None else low[order]
    change = np.ones(top.size, bool)
    change[1:] = top[1:] != top[:-1]
    if low is not None:
        change[1:] |= low[1:] != low[:-1]
    first = np.flatnonzero(change)
    return Filter(top[first], None if low is None else low[first], np.add.reduceat(counts, first) if first.size else counts)


def counted(ids: np.ndarray, layout: Layout) -> Filter:
    """All 2- and 3-grams of a sequence of ids without a 0 among them."""
    there = ids > 0
    two = np.flatnonzero(there[:-1] & there[1:])
    three = two[:-1][np.diff(two) == 1]
    a, b = np.concatenate([ids[two], ids[three]]), np.concatenate([ids[two + 1], ids[three + 1]])
    top, low = layout.permuted(a, b, np.concatenate([np.zeros(two.size, ids.dtype), ids[three + 2]]))
    if low is None:
        top.sort()
        first = np.flatnonzero(np.append(True, top[1:] != top[:-1])) if top.size else np.zeros(0, np.int64)
        return Filter(top[first], None, np.diff(np.append(first, top.size)).astype(np.int64))
    return merged([Filter(top, low, np.ones(top.size, np.int64))])


def _bytes(values: np.ndarray, bits: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :-(-bits // 8)].tobytes()


def _values(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :-(-bits // 8)] = data.reshape(n, -1)
    return out.view("<u8").ravel().astype(np.uint64)


def encoded(f: Filter, layout: Layout, shard_bits: int) -> bytes:
    """A filter whose n-grams agree in the first ``shard_bits`` bits (which are not stored) as bytes."""
    n = len(f)
    q = max(1, min(layout.top - shard_bits, (n - 1).bit_length()))
    r = layout.top - shard_bits - q
    quotient = ((f.top >> np.uint64(r)) & _mask(q)).astype(np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True)
    large = f.counts >= LARGE
    return b"".join([
        struct.pack(HEAD, n, int(large.sum()), q), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
        _bytes(f.top & _mask(r), r), b"" if f.low is None else _bytes(f.low, layout.low),
        np.minimum(f.counts, LARGE).astype(np.uint8).tobytes(), f.counts[large].astype("<i8").tobytes()])


def decoded(data: bytes, layout: Layout, shard_bits: int, shard: int) -> Filter:
    n, large, q = struct.unpack_from(HEAD, data)
    r = layout.top - shard_bits - q
    raw, at = np.frombuffer(data, np.uint8), struct.calcsize(HEAD)

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return raw[at - size:at]

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q))
    ends = np.unpackbits(take(-(-n // 8)), count=n)
    run = np.cumsum(ends) - ends
    top = _values(take(n * -(-r // 8)), n, r) if r else np.zeros(n, np.uint64)
    top |= (occupied[run].astype(np.uint64) << np.uint64(r))
    if shard_bits:
        top |= np.uint64(shard << (layout.top - shard_bits))
    low = _values(take(n * -(-layout.low // 8)), n, layout.low) if layout.low else None
    counts = take(n).astype(np.int64)
    counts[counts == LARGE] = take(8 * large).copy().view("<i8")
    return Filter(top, low, counts)


def split(f: Filter, layout: Layout, shard_bits: int) -> list[tuple[int, Filter]]:
    """``(shard, filter)`` of the non-empty shards."""
    if not len(f):
        return []
    if not shard_bits:
        return [(0, f)]
    shard = (f.top >> np.uint64(layout.top - shard_bits)).astype(np.int64)
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    return [(int(shard[a]), f.part(a, b)) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(f)])]
