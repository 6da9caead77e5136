"""Sets of hashed word shingles of whole texts, vectorised over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; a longer text is taken alone.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)  # 2^64 over the golden ratio


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (the public splitmix64 constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix((np.arange(256, dtype=np.uint64) + _U(1)) * _STEP)


def _powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), _STEP, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def _chunk(data: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of the texts data[bounds[i]:bounds[i + 1]], ascending."""
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    opened = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[opened] |= word[opened]
    starts = np.flatnonzero(first)
    edges = np.searchsorted(starts, bounds)
    if len(starts):
        place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))) if starts[0] == 0 else None
        if place is None:
            place = np.arange(len(data))
            place[starts[0]:] -= np.repeat(starts, np.diff(np.append(starts, len(data))))
        terms = np.where(word, _BYTE[_LOWER[data]] * _powers(int(place.max()) + 1)[place], _U(0))
        words = mix(np.add.reduceat(terms, starts))
        full = mix(words)
        for j in range(1, k):
            full[:-j] = mix(full[:-j] * _STEP + words[j:]) if len(words) > j else full[:-j]
    for lo, hi in zip(edges[:-1], edges[1:]):
        if hi - lo >= k:
            yield np.unique(full[lo:hi - k + 1])
        elif hi > lo:
            short = mix(np.array([hi - lo], dtype=np.uint64))
            for w in words[lo:hi]:
                short = mix(short * _STEP + w)
            yield short
        else:
            yield np.empty(0, dtype=np.uint64)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Per text the ascending distinct hashes of its k-word shingles: A-Z lower-cased, words parted by
    ASCII white space; of fewer than k words the whole sequence; none without words."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, side="right")) - 1)
            bounds = offsets[lo:hi + 1]
            yield from _chunk(data[bounds[0]:bounds[-1]], bounds - bounds[0], k)
            lo = hi
