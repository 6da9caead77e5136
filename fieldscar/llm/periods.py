"""Periodic runs in the words of texts, found by block convolution.

At every dyadic scale B the words are cut into blocks of B. The squared differences of a block and the text
that follows it, sum of (x_i - y_(i+d))^2 = sum x^2 + sum y^2 - 2 sum x y, are computed for all distances
B <= d < 2 B at once by an exact number-theoretic transform; a zero is a copy of the block at distance d. A run
of period q in [B, 2 B) that is at least four periods long holds a whole block and its copy at distance q, so no
run is missed. Distances seed extensions word by word, which also confirm them: the transform works modulo a
prime, where a zero may rarely be false but is never lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_map, register, table

#: A run has at least this many periods, and this many words.
LEAST_PERIODS, LEAST_WORDS = 4, 6
#: Words of short texts that are searched together, and values transformed together.
CHUNK_WORDS, CHUNK_VALUES = 1 << 17, 1 << 18
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

#: 3 * 2^30 + 1 is prime and 5 generates its units, so transforms up to 2^30 values exist; products stay below 2^64.
PRIME, GENERATOR = 3 * (1 << 30) + 1, 5
_P = np.uint64(PRIME)


def _roots(n: int, inverse: bool) -> np.ndarray:
    """First n/2 powers of a primitive n-th root of one (or of its inverse)."""
    root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(max(n // 2, 1), dtype=np.uint64)
    have = 1
    while have < len(out):  # double what is there
        step = np.uint64(pow(root, have, PRIME))
        out[have:2 * have] = out[:have] * step % _P
        have *= 2
    return out


def _forward(a: np.ndarray) -> np.ndarray:
    """Transform of the columns of ``a`` (2^k rows), in bit-reversed order."""
    n, m = a.shape
    half = n // 2
    w = _roots(n, inverse=False)
    while half:
        v = a.reshape(-1, 2, half, m)
        low, high = v[:, 0], v[:, 1]
        v = np.stack([(low + high) % _P, (low + _P - high) % _P * w[:: n // (2 * half)][:half, None] % _P], axis=1)
        a, half = v.reshape(n, m), half // 2
    return a


def _backward(a: np.ndarray) -> np.ndarray:
    """Inverse of ``_forward``."""
    n, m = a.shape
    half = 1
    w = _roots(n, inverse=True)
    while half < n:
        v = a.reshape(-1, 2, half, m)
        low, high = v[:, 0], v[:, 1] * w[:: n // (2 * half)][:half, None] % _P
        v = np.stack([(low + high) % _P, (low + _P - high) % _P], axis=1)
        a, half = v.reshape(n, m), half * 2
    return a * np.uint64(pow(n, PRIME - 2, PRIME)) % _P


def copies(ids: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of the copies of the blocks ids[start:start + size] at distances size to 2 size - 1.

    ``ids`` are positive; 0 stands beyond their end.
    """
    found = []
    per = max(1, CHUNK_VALUES // (2 * size))
    for lo in range(0, len(starts), per):
        part = starts[lo:lo + per]
        at = part[None, :] + np.arange(3 * size)[:, None]
        values = np.where(at < len(ids), ids[np.minimum(at, len(ids) - 1)], 0).astype(np.uint64) % _P
        x, y = values[:size], values[size:]
        turned = np.zeros_like(y)
        turned[0], turned[size + 1:] = x[0], x[:0:-1]
        y = y.copy()
        y[2 * size - 1] = 0  # no distance reaches it
        product = _backward(_forward(turned) * _forward(y) % _P)[:size]
        squares = np.concatenate([np.zeros((1, len(part)), dtype=np.uint64), np.cumsum(y * y % _P, axis=0)])
        total = (x * x % _P).sum(axis=0) % _P + (squares[size:2 * size] - squares[:size]) % _P + np.uint64(2) * (_P - product)
        lag, block = np.nonzero(total % _P == 0)
        found.append((part[block], lag + size))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate([s for s, _ in found]), np.concatenate([d for _, d in found])


def _equal_right(ids: np.ndarray, at: int, d: int) -> int:
    """How many words from ``at`` on equal the word d places later."""
    n, step = 0, 64
    while at + n + d < len(ids):
        end = min(at + n + step, len(ids) - d)
        differ = ids[at + n:end] != ids[at + n + d:end + d]
        if differ.any():
            return n + int(differ.argmax())
        n, step = end - at, step * 2
    return n


def _equal_left(ids: np.ndarray, at: int, d: int) -> int:
    """How many words before ``at`` equal the word d places later."""
    n, step = 0, 64
    while n < at:
        low = max(0, at - n - step)
        differ = (ids[low:at - n] != ids[low + d:at - n + d])[::-1]
        if differ.any():
            return n + int(differ.argmax())
        n, step = at - low, step * 2
    return n


def find_runs(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``ids`` (positive), by start, then period.

    ``longest`` bounds the length of a run: with several texts in ``ids``, each with ids of its own, the
    longest text.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    again = np.full(n, n, dtype=np.int64)  # distance to the next place of the same word
    same = ids[order[1:]] == ids[order[:-1]]
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    reach = np.zeros(n + 1, dtype=np.int64)  # end of the furthest known run over a place
    runs, size, widest = [], 1, again
    while LEAST_PERIODS * size <= longest and len(widest):
        # a block can have a copy at a distance under 2 * size only if all of its words recur within it,
        # and tells nothing new if a known run covers all of its windows
        blocks = np.flatnonzero(widest < 2 * size) * size
        blocks = blocks[reach[blocks] < blocks + 3 * size - 1]
        start, distance = copies(ids, blocks, size)
        new = reach[start] < start + distance + size
        start, distance = start[new], distance[new]
        by = np.lexsort((start, distance))
        start, distance = start[by], distance[by]
        key, i = distance * (n + 1) + start, 0
        while i < len(start):
            s, d = int(start[i]), int(distance[i])
            right = _equal_right(ids, s, d)
            if right < size:  # zero modulo the prime only
                i += 1
                continue
            left, end = s - _equal_left(ids, s, d), s + right
            if end + d - left >= max(LEAST_WORDS, LEAST_PERIODS * d):
                runs.append((left, end + d - left, d))
                np.maximum(reach[left:end + d], end + d, out=reach[left:end + d])
            i = max(i + 1, int(np.searchsorted(key, d * (n + 1) + end - size, side="right")))
        even = len(widest) // 2 * 2
        widest, size = np.maximum(widest[0:even:2], widest[1:even:2]), size * 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of_texts(texts: list[list[bytes]]) -> Iterator[list[tuple[int, int, int]]]:
    """``find_runs`` of each list of words, short lists searched together."""
    lo = 0
    while lo < len(texts):
        hi, words = lo, 0
        while hi < len(texts) and (hi == lo or words + len(texts[hi]) <= CHUNK_WORDS):
            words += len(texts[hi])
            hi += 1
        flat, first, bounds = [], 1, [0]
        for text in texts[lo:hi]:
            numbers: dict[bytes, int] = {}
            flat += [numbers.setdefault(w, len(numbers) + first) for w in text]
            first += len(numbers)
            bounds.append(len(flat))
        found = find_runs(np.array(flat, dtype=np.int64), max(map(len, texts[lo:hi]))) if flat else []
        each, edges = [[] for _ in range(hi - lo)], np.array(bounds[1:])
        for start, length, period in found:
            i = int(np.searchsorted(edges, start, side="right"))
            each[i].append((start - bounds[i], length, period))
        yield from each
        lo = hi


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join(compress(words, keep.tolist()))


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``key``, ``runs`` (start, length, period; by start, then period) and ``collapsed`` for every row of ``docs``.

    Words are what ASCII white space parts; ``rewrite(key, words)`` may change them first. A run is a stretch of
    words with smallest period q, at least LEAST_PERIODS q and LEAST_WORDS words long, that cannot be extended.
    A null or empty text has no words, no runs and an empty collapsed text. Repeated rows each give a row; a null
    key is kept; other columns are ignored. A text is read whole, in the task that scans it, whatever its length.
    """
    def rows(batch):
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            keys = part.column(0).to_pylist()
            texts = [(t or "").encode().split() for t in part.column(1).to_pylist()]  # bytes part at ASCII white space only
            if rewrite is not None:
                texts = [rewrite(k, words) for k, words in zip(keys, texts)]
            runs = list(runs_of_texts(texts))
            yield {
                "key": part.column(0), "collapsed": [collapse(w, r).decode() for w, r in zip(texts, runs)],
                "runs": [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs],
            }

    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return arrow_map(source, f"key {kind}, runs {RUNS}, collapsed string", rows).withColumnRenamed("key", key)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties: smallest start, then period. Null without runs."""
    def stronger(a, b):
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (left > right) | ((left == right) & (F.struct(a["start"], a["period"]) < F.struct(b["start"], b["period"])))

    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(stronger(r, best), r).otherwise(best))


def tiled(key: object, words: list[bytes]) -> list[bytes]:
    """The words of the query: a tenth of the documents, chosen by crc32 of the key, repeat themselves from some place on."""
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


@register("op13_periodic_runs")
def op13_periodic_runs(spark, folder):
    """Digest columns of the runs; documents without a doc_id are searched as they are."""
    best = strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return (
        periodic_runs(table(spark, folder, "documents"), rewrite=tiled).withColumn("best", best)
        .select(
            "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
            F.expr("1000 * best.length div best.period").alias("exponent_milli"),
            F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    )
