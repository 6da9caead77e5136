"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

The instance is its histogram of piece lengths, at most ``capacity`` counts however many pieces
there are. The driver turns it into a plan of bin patterns with multiplicities: first the sets that
Martello and Toth's dominance criterion proves optimal are fixed, then the rest is filled best fit.
The pieces find their bins by their rank among the pieces of the same length.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..operators.ranking import ranked
from ..session import cut_lineage
from .common import arrow_map, register, table, worker_cache

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
CACHED_WORDS = 250_000
BATCH_WORDS = 20_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Stands between words that are encoded together. It is a token of its own, which no word without it can have.
MARK = "~"
#: Begins what may be a special token, which holds across words and cases.
SPECIAL = "<|"


#: Byte-level models show the bytes without a printable sign as the characters from U+0100 on.
_SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b))}


class WordCache:
    """Token ids (little-endian unsigned 32-bit bytes) of texts, word by word.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words; only special
    tokens reach further, so texts that may hold one are encoded whole. Each distinct word is encoded once while it
    stays in the cache: words that were not met since the last ``CACHED_WORDS`` new ones are dropped. ASCII letters
    are put in lower case beforehand where no mark follows that could be composed with one of them; all other folding
    is the tokenizer's. A full stop or comma after an ASCII letter or digit ends a word as a token of its own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.tails = {b"": b""} | {c.encode(): self._whole(c) for c in ".,"}
        mark = self._ids(MARK)
        self.mark = mark[0] if len(mark) == 1 else None
        # whether words of letters reach the model as they are, their bytes as characters
        self.model, self.direct = self.tokenizer.model, True
        self.direct = all(self._of_letters(w.encode()) == self._whole(w) for w in ("the", "\xfcbung", "na\xefvet\xe9", "\u0161\u0105zzqj"))

    @staticmethod
    def shared(path: str) -> WordCache:
        """The cache of this Python worker, which outlives its tasks."""
        return worker_cache(path, lambda: WordCache(path))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _whole(self, text: str) -> bytes:
        return np.asarray(self._ids(text), dtype="<u4").tobytes()

    def _of_letters(self, word: bytes) -> bytes | None:
        """Ids of a word of small Latin letters (to U+024F), which folding and splitting leave whole; None for others."""
        text = word.decode()
        if not (self.direct and text.isalpha() and max(text) < "\u0250" and text == text.lower()):
            return None
        shown = text if len(text) == len(word) else word.decode("latin-1").translate(_SHOWN)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; words of letters go to the tokenizer's model, those without MARK through all of the
        tokenizer as one text, parted by MARK."""
        out = {w: self._of_letters(w) for w in words}
        plain = [w for w in words if out[w] is None and b"~" not in w] if self.mark is not None else []
        for i in range(0, len(plain), BATCH_WORDS):
            part = plain[i:i + BATCH_WORDS]
            [e] = self.tokenizer.encode_batch_fast([f" {MARK} ".join(w.decode() for w in part)], add_special_tokens=False)
            ids = np.asarray(e.ids, dtype="<u4")
            ends = (4 * np.append(np.flatnonzero(ids == self.mark), len(ids))).tolist()
            data, at = ids.tobytes(), 0
            for word, end in zip(part, ends, strict=True):
                out[word], at = data[at:end], end + 4
        for word in words:
            if out[word] is None:
                out[word] = self._whole(word.decode())
        return list(out.values())

    def _learn(self, missing: set[bytes]) -> None:
        known, older, tails, new, tailed = self.known, self.older, self.tails, [], []
        for word in missing:
            if word in older:
                known[word] = older[word]
            elif word[-1:] in tails and word[-2:-1].isalnum():  # bytes: ASCII only
                tailed.append(word)
            else:
                new.append(word)
        forms = {w[:-1] for w in tailed}.difference(known, new)
        for form in [f for f in forms if f in older]:
            known[form] = older[form]
        new += [f for f in forms if f not in known]
        known.update(zip(new, self._encoded(new)))
        for word in tailed:
            known[word] = known[word[:-1]] + tails[word[-1:]]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        split = [[] if SPECIAL in t else _folded(t.encode()).split() for t in texts]  # bytes part at ASCII white space only
        met = set().union(*split)
        self._learn(met.difference(self.known))
        get = {w: self.known[w] for w in met}.__getitem__  # a small table that stays close
        return [self._whole(t) if SPECIAL in t else b"".join(map(get, words)) for t, words in zip(texts, split)]


def _folded(text: bytes) -> bytes:
    """ASCII letters in lower case, unless the text holds marks of U+0300 to U+037F, the only ones composed with them."""
    return text if b"\xcc" in text or b"\xcd" in text else text.lower()


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``key``, row (tells repeated keys apart), piece, start, length, ids_crc32.

    Ids of the whole text and then END_ID; a null or empty text is just END_ID. Only documents
    over ``capacity`` are cut, into full pieces and a last one.
    """
    def rows(batch):
        cache = WordCache.shared(path)
        names = ("key", "row", "piece", "start", "length", "ids_crc32")
        for lo in range(0, batch.num_rows, 256):
            part, out = batch.slice(lo, 256), {n: [] for n in names}
            texts = [t or "" for t in part.column(2).to_pylist()]
            for key_, row, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), cache.encode(texts)):
                ids += END_ID.to_bytes(4, "little")
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    for n, v in zip(names, (key_, row, p, at // 4, len(cut) // 4, zlib.crc32(cut))):
                        out[n].append(v)
            yield out

    source = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    schema = f"key {kind}, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return arrow_map(source, schema, rows).withColumnRenamed("key", key)


def _largest(counts: np.ndarray, most: int) -> int:
    """Largest length up to ``most`` that is left, 0 if none."""
    left = np.flatnonzero(counts[:max(most, 0) + 1])
    return int(left[-1]) if len(left) else 0


def _uses(lengths: list[int], counts: np.ndarray) -> int:
    """How many bins of this pattern the counts allow."""
    kinds, times = np.unique(lengths, return_counts=True)
    return int(min(counts[k] // t for k, t in zip(kinds, times)))


def _dominating(counts: np.ndarray, capacity: int) -> list[int] | None:
    """A set with the longest piece that dominates every other feasible set with it, if one of at
    most three pieces is proved to; ``counts`` are the lengths left."""
    j = _largest(counts, capacity)
    room, rest = capacity - j, counts.copy()
    rest[j] -= 1
    k = _largest(rest, room)
    if k == 0 or k == room:  # nothing fits, or one piece fills the bin
        return [j] + [k] * (k > 0)
    fit = np.flatnonzero(rest[:room + 1])
    small = np.repeat(fit[:3], np.minimum(rest[fit[:3]], 3))[:3]
    if len(small) < 2 or small[0] + small[1] > room:  # no two pieces fit: the largest single one
        return [j, k]
    if len(small) == 3 and small.sum() <= room:  # three more may fit: no proof by small sets
        return None
    rest[k] -= 1
    b = _largest(rest, room - k)
    rest[k] += 1
    # {j, k, b} dominates {j, x, y} (x >= y) if y fits the place of b, or x and y together that of k
    for y in fit[(fit > b) & (fit <= room // 2)]:
        x = _largest(rest, room - int(y))
        if (x > y or (x == y and rest[y] >= 2)) and x + y > k:
            return None
    return [j, k] + [b] * (b > 0)


def pack_plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins) for ``counts[length]`` pieces; at most a few per length.

    Dominance is tried first in every step. It stays proved while the chosen lengths last, because
    taking pieces away only removes alternatives, so the step is repeated as often as they allow.
    Where it proves nothing, the longest piece gets best fit: at each step the largest piece that fits,
    unless two pieces fill the rest better than that piece with its successor.
    """
    counts, plan = counts.astype(np.int64).copy(), []
    while counts.any():
        chosen = _dominating(counts, capacity) or _best_fit(counts, capacity)
        times = _uses(chosen, counts)
        for n in chosen:
            counts[n] -= times
        plan.append((chosen, times))
    return plan


def _best_fit(counts: np.ndarray, capacity: int) -> list[int]:
    left, chosen = counts.copy(), []
    room = capacity
    while nxt := _largest(left, room):
        if chosen:
            pair = _best_pair(left, room)
            if pair and sum(pair) > nxt + _after(left, nxt, room - nxt):
                nxt = pair[0]
        chosen.append(nxt)
        left[nxt] -= 1
        room -= nxt
    return chosen


def _after(left: np.ndarray, taken: int, room: int) -> int:
    left[taken] -= 1
    n = _largest(left, room)
    left[taken] += 1
    return n


def _best_pair(left: np.ndarray, room: int) -> list[int] | None:
    """The two lengths with the largest sum up to ``room``, the longer first."""
    have = np.flatnonzero(left[:room + 1])
    if not len(have):
        return None
    other = np.searchsorted(have, room - have, side="right") - 1
    same = (other >= 0) & (have[other] == have) & (left[have] < 2)
    other = np.where(same, other - 1, other)
    sums = np.where(other >= 0, have + have[other], -1)
    best = int(np.argmax(sums))
    return sorted((int(have[best]), int(have[other[best]])), reverse=True) if sums[best] > 0 else None


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (a length column, and unique columns row, piece) with ``sequence_id`` and ``offset``.

    Any number of pieces may share a length: ranks come from range slices, and the plan is joined
    by length to the ranges of ranks that each pattern takes.
    """
    spark = cut.sparkSession
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    if not counts.any():
        return cut.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    taken, first_bin, places = np.zeros_like(counts), 0, []
    for lengths, times in pack_plan(counts, capacity):
        at = 0
        kinds, per_bin = np.unique(lengths, return_counts=True)
        for kind, each in zip(kinds.tolist(), per_bin.tolist()):
            places.append((kind, int(taken[kind]), int(taken[kind]) + each * times, each, first_bin, at))
            taken[kind] += each * times
            at += kind * each
        first_bin += times
    plan = spark.createDataFrame(places, "length bigint, rank_from bigint, rank_to bigint, each bigint, first_bin bigint, at bigint")
    # a few patterns per length: as small as the histogram
    by_length = plan.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("rank_from", "rank_to", "each", "first_bin", "at"))).alias("plan"))
    found = ranked(cut, ["length"], ["row", "piece"]).join(F.broadcast(by_length), "length").withColumn(
        "p", F.filter("plan", lambda p: (F.col("rank") > p["rank_from"]) & (F.col("rank") <= p["rank_to"]))[0])
    place = F.col("rank") - 1 - F.col("p.rank_from")
    return found.select(
        *cut.columns, (F.col("p.first_bin") + F.floor(place / F.col("p.each"))).cast("long").alias("sequence_id"),
        (F.col("p.at") + (place % F.col("p.each")) * F.col("length")).cast("long").alias("offset"))


@register("op5_best_fit_packing")
def op5_best_fit_packing(spark, folder):
    return packed(table(spark, folder, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """The packing of ``docs`` (doc_id, text), one row per piece."""
    cut = cut_lineage(pieces(docs, tokenizer_path()))
    return pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
