"""A minimal perfect hash with fingerprints, built and probed by numpy.

Each level is a bit array: keys that alone hash to a bit own it, the others go
on to the next level. A key's number is the count of set bits before its own.
Keys that no level separates (equal 64-bit hashes) are kept in a sorted list.

On disk a level is cut into blocks of 512 bits, each with the count of set bits
before it, and the entries of the keys follow in the order of their numbers: a
look-up reads one block per level that it passes and one entry, from a file of
any size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash

_U = np.uint64
#: Bits per remaining key at each level, and levels at most.
SPREAD, LEVELS = 2.0, 40
#: Bits of a block.
BLOCK_BITS = 512
_BLOCK = np.dtype([("rank", "<i8"), ("bits", "<u8", BLOCK_BITS // 64)])
#: What is stored of a key: a fingerprint, and where its ids lie.
ENTRY = np.dtype([("fingerprint", "<u8"), ("start", "<i8"), ("length", "<i8")])
#: Bytes that hold any head: numbers of levels, of unseparated keys and of keys,
#: and per level its bits and the keys before it.
_HEAD = 8 * (3 + 2 * LEVELS)

Read = Callable[[int, int], bytes]


def _mix(x: np.ndarray, level: int) -> np.ndarray:
    x = x ^ _U((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def key_hashes(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each key: for places, and for fingerprints."""
    both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(k) for k in keys]), dtype=">u8").astype(_U).reshape(-1, 2)
    return both[:, 1], both[:, 0]


def _blocks_of(bits: np.ndarray) -> np.ndarray:
    """A level's bits as blocks."""
    n = -(-len(bits) // BLOCK_BITS)
    padded = np.zeros(n * BLOCK_BITS, dtype=np.uint8)
    padded[:len(bits)] = bits
    out = np.zeros(n, dtype=_BLOCK)
    out["bits"] = np.packbits(padded, bitorder="little").view("<u8").reshape(n, -1)
    count = padded.reshape(n, BLOCK_BITS).sum(axis=1, dtype=np.int64)
    out["rank"] = np.cumsum(count) - count
    return out


def build(first: np.ndarray, second: np.ndarray, start: np.ndarray, length: np.ndarray) -> bytes:
    """The index file of keys, by their hashes, and what is stored of each."""
    left, other, place = first, second, np.arange(len(first))
    sizes, before, blocks, order = [], [], [], []
    done = 0
    while len(left) and len(sizes) < LEVELS:
        bits = max(64, int(len(left) * SPREAD))
        at = (_mix(left, len(sizes)) % _U(bits)).astype(np.int64)
        alone = np.bincount(at, minlength=bits) == 1
        own = alone[at]
        sizes.append(bits)
        before.append(done)
        blocks.append(_blocks_of(alone))
        order.append(place[own][np.argsort(at[own])])
        done += int(own.sum())
        left, other, place = left[~own], other[~own], place[~own]
    order.append(place[np.argsort(other, kind="stable")])
    by_number = np.concatenate(order)
    entries = np.zeros(len(first), dtype=ENTRY)
    for name, column in (("fingerprint", second), ("start", start), ("length", length)):
        entries[name] = column[by_number]
    head = np.array([len(sizes), len(other), len(first), *sizes, *before], dtype="<i8").tobytes()
    return b"".join([head.ljust(_HEAD, b"\0"), *(b.tobytes() for b in blocks), np.sort(other).astype("<u8").tobytes(),
                     entries.tobytes()])


class Index:
    """An index file, read by ``read(place, bytes)``: all of it for many keys
    (``whole``), else only what a look-up touches."""

    def __init__(self, read: Read, size: int, whole: bool = False):
        data = read(0, size) if whole else None
        self.read: Read = read if data is None else lambda place, n: data[place:place + n]
        head = np.frombuffer(self.read(0, min(size, _HEAD)), dtype="<i8")
        levels, self.unseparated, self.n = (int(x) for x in head[:3])
        self.sizes = head[3:3 + levels].tolist()
        self.before = head[3 + levels:3 + 2 * levels].tolist()
        self.at, place = [], _HEAD
        for bits in self.sizes:
            self.at.append(place)
            place += -(-bits // BLOCK_BITS) * _BLOCK.itemsize
        self.rest_at, self.entries_at = place, place + 8 * self.unseparated
        self.whole = whole

    def _records(self, place: int, dtype: np.dtype, total: int, which: np.ndarray) -> np.ndarray:
        """Records of a table that begins at ``place``."""
        if not len(which):
            return np.zeros(0, dtype=dtype)
        if self.whole:
            return np.frombuffer(self.read(place, total * dtype.itemsize), dtype=dtype)[which]
        one, back = np.unique(which, return_inverse=True)
        raw = b"".join(self.read(place + int(i) * dtype.itemsize, dtype.itemsize) for i in one)
        return np.frombuffer(raw, dtype=dtype)[back]

    def number(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Number of each key; any number, or -1, for a key it was not built
        from (a fingerprint tells)."""
        out = np.full(len(first), -1, dtype=np.int64)
        todo = np.arange(len(first))
        for level, bits in enumerate(self.sizes):
            if not len(todo):
                break
            at = (_mix(first[todo], level) % _U(bits)).astype(np.int64)
            block = self._records(self.at[level], _BLOCK, -(-bits // BLOCK_BITS), at // BLOCK_BITS)
            word, bit = at % BLOCK_BITS // 64, (at % 64).astype(_U)
            own = block["bits"][np.arange(len(at)), word]
            hit = (own >> bit) & _U(1) == 1
            ahead = np.where(np.arange(BLOCK_BITS // 64) < word[:, None], np.bitwise_count(block["bits"]), 0).sum(axis=1)
            ahead = ahead + np.bitwise_count(own & ((_U(1) << bit) - _U(1)))
            out[todo[hit]] = (self.before[level] + block["rank"] + ahead)[hit]
            todo = todo[~hit]
        if len(todo) and self.unseparated:
            rest = np.frombuffer(self.read(self.rest_at, 8 * self.unseparated), dtype="<u8")
            out[todo] = self.n - self.unseparated + np.minimum(np.searchsorted(rest, second[todo]), len(rest) - 1)
        return out

    def find(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) stored of each key; length -1 if there is no such key."""
        first, second = key_hashes(keys)
        at = self.number(first, second)
        there = np.flatnonzero(at >= 0)
        start, length = np.zeros(len(keys), np.int64), np.full(len(keys), -1, dtype=np.int64)
        found = self._records(self.entries_at, ENTRY, self.n, at[there])
        same = found["fingerprint"] == second[there]
        start[there[same]], length[there[same]] = found["start"][same], found["length"][same]
        return start, length
