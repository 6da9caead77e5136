"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts become vectors of term weights over a fixed set of hashed terms: shapes (trigrams of byte classes and
measures of repetition), words and pairs of words. A truncated singular value decomposition of labelled texts gives
the latent space, and every document takes the votes of the labelled texts with the largest cosines, computed
exactly in blocks.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .common import arrow_map, register, table
from .toxicity import fold

#: Hashed terms per text: shapes of characters, shapes with words' repetition, all with words and pairs of words (half
#: each); the weight of words beside shapes; latent dimensions.
SHAPE_TERMS, WORDS_FROM, TERMS, WORD_WEIGHT, LATENT = 1024, 1088, 2112, 0.5, 64
#: Labelled texts per label that vote, the first by a hash of the doc_id: the bound of the broadcast.
VOTERS_PER_LABEL = 2048
NEIGHBOURS, SHARPNESS = 15, 8
FOLDS, HELD_FOLD = 3, 1
DOC_BLOCK = 512

_CLASS = np.full(256, 6, dtype=np.int64)  # bytes of letters outside ASCII
_CLASS[:128] = [
    1 if chr(b).isupper() else 2 if chr(b).islower() else 3 if chr(b).isdigit() else 5 if b in (10, 13) else 4 if b <= 32
    else 7 + sum(1 for c in range(33, b) if not chr(c).isalnum()) for b in range(128)]
_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2^64 over the golden ratio


def term_counts(text: str) -> np.ndarray:
    """Counts of TERMS hashed terms: trigrams of byte classes, where a run of letters of one case counts
    as at most two, flags of repetition between neighbouring words and lines, words and pairs of them."""
    kinds = _CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    if len(kinds) > 2:
        long_run = (kinds[2:] == kinds[1:-1]) & (kinds[1:-1] == kinds[:-2]) & (kinds[2:] <= 6)
        kinds = np.concatenate([kinds[:2], kinds[2:][~long_run]])
    padded = np.concatenate([[0, 0], kinds, [0]]).astype(np.uint64)
    grams = (padded[:-2] << np.uint64(12)) | (padded[1:-1] << np.uint64(6)) | padded[2:]
    counts = np.bincount(((grams * _MIX) >> np.uint64(54)).astype(np.int64), minlength=TERMS).astype(np.float32)
    words = text.split()
    if words:
        lines = text.split("\n")
        shares = (
            sum(a == b for a, b in zip(words, words[1:])) / len(words), 1 - len(set(words)) / len(words),
            1 - len(set(lines)) / len(lines), len(lines) / len(words), sum(map(len, words)) / len(words) / 20)
        for i, share in enumerate(shares):
            counts[SHAPE_TERMS + 12 * i + min(11, int(share * 12))] = max(1.0, 0.15 * len(words))
        small, bins = text.lower().encode("utf-8", "replace").split(), (TERMS - WORDS_FROM) // 2
        hashes = np.fromiter(map(zlib.crc32, small), dtype=np.uint64, count=len(small))
        for at, h in ((WORDS_FROM, hashes), (WORDS_FROM + bins, hashes[:-1] * np.uint64(31) + hashes[1:])):
            counts[at:at + bins] = np.bincount(((h * _MIX) >> np.uint64(32)).astype(np.int64) % bins, minlength=bins)
    return counts


def weighted(counts: np.ndarray) -> np.ndarray:
    """Root of the relative frequencies, of shapes and of words each by itself."""
    shares = [part / np.maximum(part.sum(axis=1, keepdims=True), 1) for part in (counts[:, :WORDS_FROM], counts[:, WORDS_FROM:])]
    return np.concatenate([np.sqrt(shares[0]), np.float32(WORD_WEIGHT) * np.sqrt(shares[1])], axis=1)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def fit_space(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(inverse document frequencies, projection to the LATENT leading right singular vectors)."""
    idf = np.log((1 + len(weights)) / (1 + (weights > 0).sum(axis=0))).astype(np.float32) + 1
    _, vectors = np.linalg.eigh((weights * idf).T @ (weights * idf))  # ascending eigenvalues
    return idf, np.ascontiguousarray(vectors[:, ::-1][:, :LATENT], dtype=np.float32)


def vote(latent: np.ndarray, voters: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Share of label 1 among the NEIGHBOURS nearest voters (of equally near ones the first), weighted by a power of
    the cosine; blocks of documents against all voters."""
    k, out = min(NEIGHBOURS, len(voters)), np.empty(len(latent))
    for lo in range(0, len(latent), DOC_BLOCK):
        cosines = latent[lo:lo + DOC_BLOCK] @ voters.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        last = np.take_along_axis(cosines, near, axis=1).min(axis=1, keepdims=True)
        for i in np.flatnonzero((cosines >= last).sum(axis=1) > k):  # a tie at the last place
            near[i] = np.argsort(-cosines[i], kind="stable")[:k]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1).astype(np.float64), 1e-3) ** SHARPNESS
        out[lo:lo + DOC_BLOCK] = np.clip((weight * labels[near]).sum(axis=1) / weight.sum(axis=1), 0, 1)
    return out


def _voters(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of the texts that vote."""
    per_label = [
        labels.filter(F.col("quality") == q).orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(VOTERS_PER_LABEL)
        for q in (0, 1)]
    chosen = cut_lineage(per_label[0].unionByName(per_label[1]))

    def rows(batch):
        yield {"quality": batch.column(1), "counts": [term_counts(t or "").tobytes() for t in batch.column(0).to_pylist()]}

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("quality").cast("int").alias("quality")).orderBy("doc_id")
    found = arrow_map(texts.select("text", "quality"), "quality int, counts binary", rows).collect()
    counts = np.array([np.frombuffer(r["counts"], np.float32) for r in found]).reshape(len(found), TERMS)
    return counts, np.array([r["quality"] for r in found], dtype=float)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    ``labels``: doc_id, quality (0, 1; null is no label). Up to VOTERS_PER_LABEL texts per label
    vote, none of fold HELD_FOLD; that bounds what is collected and sent. A null text is empty, and an
    empty text is voted on like any other. Without labelled texts all score 0.5. A null doc_id
    is never held out; repeated rows each give a row.
    """
    train = (
        labels.filter("quality is not null and doc_id is not null").filter(fold(F.col("doc_id"), FOLDS) != HELD_FOLD)
        .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    counts, marks = _voters(docs, cut_lineage(train))
    kind = docs.schema["doc_id"].dataType.simpleString()
    if not len(marks):
        scored = docs.select("doc_id", F.lit(0.5).alias("score"))
    else:
        idf, projection = fit_space(weighted(counts))
        voters = unit((weighted(counts) * idf) @ projection)
        sent = docs.sparkSession.sparkContext.broadcast((idf[:, None] * projection, voters, marks))

        def rows(batch):
            to_latent, known, known_marks = sent.value
            for lo in range(0, batch.num_rows, DOC_BLOCK):
                part = batch.slice(lo, DOC_BLOCK)
                block = np.array([term_counts(t or "") for t in part.column(1).to_pylist()])
                yield {"doc_id": part.column(0), "score": vote(unit(weighted(block) @ to_latent), known, known_marks)}

        scored = arrow_map(docs.select("doc_id", "text"), f"doc_id {kind}, score double", rows)
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_FOLD, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op6_neighbour_quality")
def op6_neighbour_quality(spark, folder):
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
