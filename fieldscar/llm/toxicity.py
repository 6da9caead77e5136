"""Toxicity by two class-conditional Kneser-Ney models that share their backoff counts.

A word is a chain of characters to its end, which is one of them; each is conditioned on the word's whole
beginning. Both class models discount their counts and back off to one distribution made of both classes' counts,
which backs off to continuation counts of characters. A word's evidence is the difference of its two
log-likelihoods as far as it exceeds ``MARGIN`` either way; a document's score is the sum of toxic and ordinary
evidence over its words, normalised by their number.

The contexts of a word are its prefixes, so words in order form a trie whose counts are sums over stretches of
words: the distinct words of all documents are range-sorted once, every slice builds the trie of its own words,
and only prefixes of the first and last word of a slice can be shared with other slices.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .common import arrow_map, broadcast_if, register, table, worker_cache

DISCOUNT = 0.75
#: Counts that the shared distribution is worth in a class model.
SHARED_WEIGHT = 50.0
MARGIN = 1.5
#: Words without evidence that are added to every document, so that a few words decide nothing.
PRIOR_WORDS = 20.0
#: Longer stretches of letters count as several words.
LONGEST_WORD = 100
#: Words with evidence, and bytes of them, up to which they are sent to every task; beyond, documents' words are joined.
BROADCAST_WEIGHTS, BROADCAST_BYTES = 500_000, 16_000_000
#: Labels (of fixed width) up to which they are sent to every task.
BROADCAST_LABELS = 4_000_000
#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 400_000
BINS_PER_UNIT, MAX_BINS = 2000, 10_000
FOLDS, HELD_FOLD = 5, 0
END = "$"

_WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST_WORD}}}")


def fold(key: Column, folds: int) -> Column:
    return F.crc32(key.cast("string")) % folds


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``n_tox``, ``n_ord`` for all words of ``texts`` (text, toxic); rows without a label count nothing."""
    def run(batches):
        seen = defaultdict(lambda: [0, 0])

        def out():
            words = list(seen)
            yield pa.RecordBatch.from_pydict({
                "word": pa.array(words, type=pa.string()), "n_tox": pa.array([seen[w][1] for w in words], type=pa.int64()),
                "n_ord": pa.array([seen[w][0] for w in words], type=pa.int64())})
            seen.clear()

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(words_of(text or "")).items():
                    if toxic is None:
                        seen[word]  # known, without a count
                    else:
                        seen[word][toxic] += n
                if len(seen) > COUNTED_WORDS:
                    yield from out()
        yield from out()

    found = texts.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, "word string, n_tox bigint, n_ord bigint")
    return found.groupBy("word").agg(F.sum("n_tox").alias("n_tox"), F.sum("n_ord").alias("n_ord"))


class Trie:
    """Prefixes of words (in the order of their bytes) as arrays: a node comes after its parent, the empty prefix first.

    ``parent``, ``last`` (index in ``characters``), ``n`` (node, class) and, per word, its ``end`` node.
    """

    def __init__(self, words: list[str], counts: np.ndarray):
        numbers: dict[str, int] = {}
        parent, last, first, beyond, self.end = [-1], [-1], [0], [len(words)], []
        path, before = [0], ""
        for i, word in enumerate(words):
            word += END
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            for node in path[shared + 1:]:
                beyond[node] = i
            del path[shared + 1:]
            for c in word[shared:]:
                parent.append(path[-1])
                path.append(len(last))
                last.append(numbers.setdefault(c, len(numbers)))
                first.append(i)
                beyond.append(len(words))
            self.end.append(path[-1])
            before = word
        sums = np.concatenate([np.zeros((1, 2), dtype=np.int64), np.cumsum(counts, axis=0)])
        self.words, self.characters = words, list(numbers)
        self.parent, self.last = np.array(parent), np.array(last)
        self.n = sums[np.array(beyond)] - sums[np.array(first)]
        self.known = self.n.sum(axis=1) > 0

    def border(self) -> dict[str, int]:
        """Node of every prefix of the first and the last word, which other slices may hold too."""
        found = {"": 0}
        for i in {0, len(self.words) - 1} if self.words else ():
            node, word = self.end[i], self.words[i] + END
            for k in range(len(word), 0, -1):
                found[word[:k]] = int(node)
                node = self.parent[node]
        return found

    def kinds(self, of: np.ndarray) -> np.ndarray:
        """Per node its children among ``of`` that are met at all, in toxic and in ordinary text."""
        seen = np.stack([self.known, self.n[:, 1] > 0, self.n[:, 0] > 0], axis=1)[of]
        out = np.zeros((len(self.parent), 3), dtype=np.int64)
        for j in range(3):
            out[:, j] = np.bincount(self.parent[of][seen[:, j]], minlength=len(out))
        return out


def _tries(batches) -> Trie:
    """The trie of a slice: its batches together."""
    parts = list(batches)
    words = [w for b in parts for w in b.column(0).to_pylist()]
    counts = [np.stack([b.column(2).to_numpy(), b.column(1).to_numpy()], axis=1) for b in parts]  # ordinary, toxic
    return Trie(words, np.concatenate([np.zeros((0, 2), dtype=np.int64), *counts]))


def _slice_statistics(words: DataFrame) -> tuple[dict[str, np.ndarray], Counter, int]:
    """What slices must know of each other: per border prefix n_ord, n_tox and its three numbers of children; the
    numbers of prefixes by last character; their total. A slice gives 2 LONGEST_WORD + 3 prefixes and a row per character."""
    def run(batches):
        trie = _tries(batches)
        border = trie.border()
        inner = np.ones(len(trie.parent), dtype=bool)
        inner[list(border.values())] = False
        kinds = trie.kinds(np.flatnonzero(inner))
        ends = np.bincount(trie.last[inner & trie.known], minlength=len(trie.characters))
        rows = [(p, *trie.n[i].tolist(), *kinds[i].tolist()) for p, i in border.items()]
        rows += [(None, n, i, 0, 0, 0) for i, n in enumerate(ends.tolist()) if n]
        yield pa.RecordBatch.from_pydict({
            "prefix": pa.array([r[0] for r in rows], type=pa.string()),
            "last": pa.array([trie.characters[r[2]] if r[0] is None else None for r in rows], type=pa.string()),
            "v": pa.array([list(r[1:]) for r in rows], type=pa.list_(pa.int64()))})

    border: dict[str, np.ndarray] = {}
    ends: Counter = Counter()
    for prefix, last, v in words.mapInArrow(run, "prefix string, last string, v array<bigint>").collect():
        if prefix is None:
            ends[last] += v[0]
        else:
            border[prefix] = border.get(prefix, 0) + np.array(v)
    for prefix, v in border.items():  # border prefixes as children of their own parents
        if prefix and v[0] + v[1]:
            border[prefix[:-1]] = border[prefix[:-1]] + np.array([0, 0, 1, v[1] > 0, v[0] > 0])
            ends[prefix[-1]] += 1
    return border, ends, sum(ends.values())


def log_ratios(trie: Trie, border: dict[str, np.ndarray], ends: dict[str, int], total: int) -> np.ndarray:
    """Per prefix the log of the toxic over the ordinary probability of its last character after the rest; 0 for
    prefixes that no labelled word has."""
    inner = np.ones(len(trie.parent), dtype=bool)
    here = trie.border()
    inner[list(here.values())] = False
    n, kinds = trie.n.astype(float), trie.kinds(np.flatnonzero(inner)).astype(float)
    for prefix, node in here.items():
        n[node], kinds[node] = border[prefix][:2], border[prefix][2:]
    known = n.sum(axis=1) > 0
    up = trie.parent
    low = np.array([ends.get(c, 0) for c in trie.characters] + [0])[trie.last] / max(total, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        shared = (np.maximum(n.sum(axis=1) - DISCOUNT, 0) + DISCOUNT * kinds[up, 0] * low) / n[up].sum(axis=1)

        def of(cls: int, kind: int) -> np.ndarray:
            return (np.maximum(n[:, cls] - DISCOUNT, 0) + (DISCOUNT * kinds[up, kind] + SHARED_WEIGHT) * shared) / (n[up, cls] + SHARED_WEIGHT)

        ratio = np.log(of(1, 1) / of(0, 2))
    ratio[0] = 0
    return np.where(known, ratio, 0.0)


def word_weights(counts: DataFrame) -> DataFrame:
    """``word``, ``weight`` (evidence, toxic above and ordinary below zero) of the words of ``counts`` that have any."""
    words = cut_lineage(counts.repartitionByRange("word").sortWithinPartitions("word"))
    shared = words.sparkSession.sparkContext.broadcast(_slice_statistics(words))

    def run(batches):
        trie = _tries(batches)
        ratio = log_ratios(trie, *shared.value)
        total, up = ratio.tolist(), trie.parent.tolist()
        for i in range(1, len(total)):
            total[i] += total[up[i]]
        found = np.array(total)[trie.end] if trie.end else np.empty(0)
        weight = np.sign(found) * np.maximum(np.abs(found) - MARGIN, 0.0)
        some = np.flatnonzero(weight)
        yield pa.RecordBatch.from_pydict({
            "word": pa.array([trie.words[i] for i in some], type=pa.string()), "weight": pa.array(weight[some], type=pa.float64())})

    return cut_lineage(words.mapInArrow(run, "word string, weight double"))


def _raw_by_broadcast(docs: DataFrame, weights: DataFrame) -> DataFrame:
    sent, name = docs.sparkSession.sparkContext.broadcast(weights.toArrow()), uuid.uuid4().hex

    def rows(batch):
        known = worker_cache(name, lambda: dict(zip(*(c.to_pylist() for c in sent.value.columns))))
        get, raw = known.get, []
        for text in batch.column(1).to_pylist():
            words = words_of(text or "")
            raw.append(sum(get(w, 0.0) for w in words) / (len(words) + PRIOR_WORDS))
        yield {"doc_id": batch.column(0), "raw": raw}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, raw double", rows)


def _raw_by_words(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """Scores from any number of weights (``word``, ``weight``): each document's distinct words are joined with them."""
    def rows(batch):
        out = {c: [] for c in ("row", "doc_id", "n", "word", "times")}
        for row, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            found = words_of(text or "")
            for word, times in (Counter(found) or {"": 0}).items():
                for c, v in zip(out, (row, doc, len(found), word, times)):
                    out[c].append(v)
        yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    words = cut_lineage(arrow_map(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
        f"row bigint, doc_id {kind}, n bigint, word string, times bigint", rows))
    return (
        words.join(weights, "word", "left").groupBy("row", "doc_id", "n")
        .agg((F.coalesce(F.sum(F.col("weight") * F.col("times")), F.lit(0.0)) / (F.col("n") + PRIOR_WORDS)).alias("raw"))
        .select("doc_id", "raw"))


def _threshold(scored: DataFrame, labels: DataFrame) -> float | None:
    """The score that parts the labelled documents best (F1 of the toxic class), halfway between the
    bins it falls between. None without toxic ones."""
    bins = F.greatest(F.least(F.floor(F.col("raw") * BINS_PER_UNIT), F.lit(MAX_BINS)), F.lit(0))
    table_ = scored.join(labels, "doc_id").groupBy(bins.alias("bin")).agg(
        F.sum(F.col("toxic")).alias("tox"), F.count("*").alias("n")).orderBy("bin").collect()  # MAX_BINS rows at most
    total = sum(r["tox"] for r in table_)
    if not total:
        return None
    best, at, tox, n = -1.0, 0.0, 0, 0
    for i in range(len(table_) - 1, -1, -1):
        tox, n = tox + table_[i]["tox"], n + table_[i]["n"]
        f1 = 2 * tox / (n + total)
        if f1 > best:
            below = table_[i - 1]["bin"] + 1 if i else table_[i]["bin"]
            best, at = f1, (table_[i]["bin"] + below) / 2 / BINS_PER_UNIT
    return max(at, 0.5 / BINS_PER_UNIT)


def toxicity(docs: DataFrame, labels: DataFrame, score_docs: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``score_docs`` (default ``docs``).

    ``labels``: doc_id, toxic (0, 1; null is no label; of several the largest counts). Only those
    whose fold is not HELD_FOLD train the models, on ``docs``, and set the threshold that maps to
    a score of 0.5. A null text is empty and scores as one without evidence; without toxic
    training documents all score 0. A null doc_id is never held out. Repeated rows each give a row.
    """
    train = cut_lineage(
        labels.filter("toxic is not null and doc_id is not null").filter(fold(F.col("doc_id"), FOLDS) != HELD_FOLD)
        .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    sent = broadcast_if(train, BROADCAST_LABELS)
    texts = docs.select("doc_id", "text").join(sent, "doc_id", "left").select("text", "toxic")
    if score_docs is not None:
        texts = texts.unionByName(score_docs.select("text", F.lit(None).cast("int").alias("toxic")))
    weights = word_weights(word_counts(texts))
    n, size = weights.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    by = _raw_by_broadcast if n <= BROADCAST_WEIGHTS and size <= BROADCAST_BYTES else _raw_by_words
    scored = cut_lineage(by(docs if score_docs is None else score_docs, weights))
    cut = _threshold(scored, train)
    score = F.lit(0.0) if cut is None else 1 / (1 + F.exp(-(F.col("raw") - cut) * (4 / cut)))
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_FOLD, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


@register("op9_toxicity")
def op9_toxicity(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
