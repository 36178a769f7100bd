"""Vectorised word hashing for the tasks that work on whole texts.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r of the
UTF-8 text, so words are cut exactly at ASCII white space.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SEGMENT = 1 << 20  # bytes hashed at a time: bounds the work arrays
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _pow(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, _SEGMENT + 1), base, dtype=U64)
        table[0] = 1
        table = np.cumprod(table, dtype=U64)  # wraps modulo 2**64
        if n <= 4 * _SEGMENT:
            _powers[base] = table
    return table[:n]


def _segment_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SEPARATOR[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * _pow(_BASE, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _pow(_BASE_INVERSE, len(data) + 1)[starts]
    return starts, mix(hashes + (ends - starts).astype(U64))


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` in order; bounds[i]:bounds[i+1] are those of text i."""
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = at + _SEGMENT
        if end < len(data):  # cut at the last separator, or behind the word that is longer than a segment
            cut = np.flatnonzero(_SEPARATOR[data[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:
                while end < len(data) and not _SEPARATOR[data[end]]:
                    end += 1
        s, h = _segment_words(data[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = min(end, len(data))
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    if not hashes:
        return np.zeros(0, dtype=U64), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets).astype(np.int64)


def rolling(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``n`` words from each position on (shorter by n - 1 than ``hashes``)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U64)
    factor = U64((_BASE * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    acc = hashes[:m] + U64(seed)
    for j in range(1, n):
        acc = acc * factor + hashes[j : j + m]
    return mix(acc)


def planes(x: np.ndarray) -> bytes:
    """The bytes of an array, most significant last, one plane after another (they compress well)."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    n = len(data) // size
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, n).T).view(dtype).reshape(n)
