"""Word shingles of whole texts as 64-bit digests, by numpy over Arrow batches.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lowered. A
word's digest is a polynomial over its bytes, read off prefix sums of a whole
slice of texts at once; a shingle's digest mixes those of its words and their
number, so that different orders and lengths differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_SLICE = 1 << 20  # bytes of text handled at once (one longer text alone)
_MAX_WORDS = 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shifts and odd multiplications)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: One odd multiplier for each place in a shingle.
_PLACE = mix(np.arange(1, _MAX_WORDS + 2, dtype=_U)) | _U(1)


class _Powers:
    """Powers of the base and of its inverse, as long as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=_U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = _U(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (np.cumprod(np.concatenate([[_U(1)], np.full(n, b, dtype=_U)]), dtype=_U)
                                  for b in (_BASE, inverse))
        return self.up, self.down


_powers = _Powers()


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digest of each word of ``data`` and the place of its first byte. No
    word crosses a place in ``starts``, where a text begins."""
    n = len(data)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[starts] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers.upto(n + 1)
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum((_LOWER[data].astype(_U) + _U(1)) * up[:n], dtype=_U, out=total[1:])
    return mix((total[last] - total[first]) * down[first] + (last - first).astype(_U)), first


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _SLICE, side="right")) - 1)
        yield a, b
        a = b


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text in turn its distinct shingles of ``k`` words, ascending;
    fewer words are one shingle, none (or a null) give an empty array."""
    if not 0 < k <= _MAX_WORDS:
        raise ValueError(f"shingles have 1 to {_MAX_WORDS} words")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    body = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    empty = np.zeros(0, dtype=_U)
    for a, b in _slices(offsets):
        low = offsets[a]
        own = offsets[a: b + 1] - low
        word, at = _words(body[low: offsets[b]], own[:-1]) if own[-1] else (empty, np.zeros(0, dtype=np.int64))
        cut = np.searchsorted(at, own)
        for x, y in zip(cut[:-1], cut[1:], strict=True):
            w, m = word[x:y], min(k, y - x)
            if m == 0:
                yield empty
                continue
            g = np.full(len(w) - m + 1, _PLACE[-1] * _U(m), dtype=_U)
            for j in range(m):
                g += w[j: len(w) - m + 1 + j] * _PLACE[j]
            yield np.unique(mix(g))
