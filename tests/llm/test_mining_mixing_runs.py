"""Hard negatives, source mixing and periodic runs against plain Python."""

import hashlib
import math
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from fieldscar.llm import mixing, negatives, periods, queries

FOLDER = "/root/testdata/sf0.001"


# --- hard negatives -----------------------------------------------------------------------------

def plain_negatives(rows, is_anchor, positives=5, wanted=3, low=50, high=95):
    best = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        best[i] = min(best.get(i, (label, list(v))), (label, list(v)))
    whole = {i: (label, [math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v]) for i, (label, v) in best.items()}
    out = []
    for a, (label, v) in whole.items():
        if not is_anchor(a):
            continue
        score = {i: max(-(1 << 63) + 1, min((1 << 63) - 1, sum(x * y for x, y in zip(v, w)))) for i, (_, w) in whole.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if whole[i][0] == label][:positives]:
            near = [i for i in order if whole[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, r + 1, n, score[p], score[n]) for r, n in enumerate(near[:wanted])]
    return sorted(out)


VECTORS = "vec_id bigint, label int, embedding array<double>, heap string, anchor_id int, v string, less int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, label, v, "h", 1, "v", 2) for i, label, v in rows], VECTORS)


def mined(df):
    assert df.columns == negatives.OUT
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 70, 5), (33, 64, 129), (40, 0, 20), (256, 64, 512)])
def test_strassen_equals_product(shape):
    m, k, n = shape
    rng = np.random.default_rng(5)
    a, b = rng.integers(-(1 << 20), 1 << 20, (m, k)), rng.integers(-(1 << 20), 1 << 20, (k, n))
    assert (negatives.strassen(a, b, leaf=4) == a @ b).all()


def test_scores_beyond_64_bits_are_clipped():
    a = negatives.whole_vectors(__import__("pyarrow").array([[3e30, 1.0], [2.0 ** 23, 0.0]]))
    b = negatives.whole_vectors(__import__("pyarrow").array([[3e30, 0.0], [-3e30], [0.25, 9.0, 7.0]]))
    top = (1 << 63) - 1
    assert negatives.scores(a, b).tolist() == [[top, -top, top], [top, -top, 64 << 31]]


def test_hard_negatives_equal_plain_loop(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), [round(rng.gauss(0, 0.4), 1) for _ in range(6)]) for i in range(160)]
    rows += [(200 + i, 1, [0.5] * 6) for i in range(30)] + [(240 + i, 2, [0.4] * 6) for i in range(30)]  # ties
    rows += rows[:10] + [(5, 2, [9.0] * 6), (6, 0, [0.1])]  # repeated rows, and an id with several rows
    rows += [(None, 1, [1.0] * 6), (300, None, [1.0] * 6), (301, 1, None), (302, 1, [1.0, None]), (303, 1, [float("nan")]),
             (304, 1, [float("inf"), 1.0]), (305, 1, []), (306, 1, [0.5] * 9), (307, 2, [0.4, 0.4]), (308, 1, [1e200, 0.0])]
    anchor = lambda i: i % 5 == 0
    from pyspark.sql import functions as F
    expected = plain_negatives(rows, anchor)
    assert expected and {r[2] for r in expected} == {1, 2, 3}
    df = vectors_of(spark, rows).repartition(7)
    assert mined(negatives.hard_negatives(df, F.expr("vec_id % 5 = 0"))) == expected
    assert mined(negatives.hard_negatives(df, F.expr("vec_id % 5 = 0"), chunk_bytes=400)) == expected  # many chunks


def test_hard_negatives_of_nothing(spark):
    from pyspark.sql import functions as F
    assert mined(negatives.hard_negatives(vectors_of(spark, []), F.expr("vec_id % 5 = 0"))) == []
    assert mined(negatives.hard_negatives(vectors_of(spark, [(1, 1, [1.0]), (2, 2, [1.0])]), F.expr("vec_id % 5 = 0"))) == []


# --- mixing -------------------------------------------------------------------------------------

def plain_mix(rows, weights=(1, 2, 3), most=3):
    size = lambda t: len((t or "").encode().split())
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size(text)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        open_weight = sum(w for s, w in weight.items() if s not in full)
        level = Fraction(total - most * sum(sizes[s] for s in full), open_weight) if open_weight else Fraction(0)
        more = {s for s in order if s not in full and level * weight[s] > most * sizes[s]}
        if not more:
            break
        full |= more
    target = {s: Fraction(most * sizes[s]) if s in full else level * weight[s] for s in order}
    return sizes, target, {s: math.floor(t) for s, t in target.items()}


MIX = "doc_id bigint, text string, source string, slice int, key string, before int, weight int, size string, n int"


@pytest.mark.parametrize("seed", range(3))
def test_mix_meets_budgets(spark, seed):
    rng = random.Random(seed)
    sources = ["a", "b", "Ä", "z", "hot", None, ""]
    rows = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.choice([0, 1, 3, 40]))),
             "hot" if i % 3 == 0 else rng.choice(sources)) for i in range(300)]
    rows += [(7, "a\tb c 　", "b")] * 5 + [(None, "x y", "a"), (500, None, "a"), (501, "", "only-empty"), (502, "t " * 5000, "hot")]
    df = spark.createDataFrame([(*r, 1, "k", 2, 3, "s", 4) for r in rows], MIX)
    found = mixing.mix(df.repartition(5)).collect()
    sizes, target, budget = plain_mix(rows)
    assert len(found) == len(rows)
    taken = defaultdict(int)
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == float(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert dict(taken) == budget
    assert abs(sum(target.values()) - sum(sizes.values())) < 1e-9
    again = mixing.mix(df.repartition(3)).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(found, key=key) == sorted(again, key=key)


def test_mix_takes_documents_in_key_order(spark):
    """Within a source at most one document is cut, and none after it gives more than the whole epochs."""
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 2]) for i in range(60)]
    found = mixing.mix(spark.createDataFrame([(*r, 1, "k", 2, 3, "s", 4) for r in rows], MIX)).collect()
    for source in "ab":
        own = sorted((r for r in found if r["source"] == source), key=lambda r: hashlib.md5(f"{r['doc_id']}:0".encode()).hexdigest())
        share = [Fraction(r["taken"], r["size"]) for r in own]
        assert share == sorted(share, reverse=True) and sum(s.denominator > 1 for s in share) <= 1


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], MIX)).collect() == []
    empty = mixing.mix(spark.createDataFrame([(1, "", "a", 1, "k", 2, 3, "s", 4), (2, None, None, 1, "k", 2, 3, "s", 4)], MIX)).collect()
    assert sorted((r["doc_id"], r["target"], r["taken"]) for r in empty) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_mix_sends_nothing_to_python(spark):
    plan = mixing.op12_source_mix(spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# --- periodic runs ------------------------------------------------------------------------------

def plain_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            start, length = i, j + q - i
            if j > i and length >= max(6, 4 * q) and not any(
                    all(w[k] == w[k + p] for k in range(start, start + length - p)) for p in range(1, q)):
                out.append((start, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(rng):
    w = [str(rng.randrange(rng.choice([1, 2, 3, 60]))) for _ in range(rng.randrange(0, 110))]
    for _ in range(rng.randrange(0, 4)):
        if len(w) > 4:
            a = rng.randrange(len(w))
            p = rng.randrange(1, max(2, (len(w) - a) // 3))
            w = w[:a] + (w[a:a + p] * len(w))[:len(w) - a]
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = "x"
    return w


def test_find_runs_equals_plain_search():
    rng = random.Random(11)
    for _ in range(300):
        w = periodic_words(rng)
        numbers = {x: i + 1 for i, x in enumerate(dict.fromkeys(w))}
        assert periods.find_runs(np.array([numbers[x] for x in w], dtype=np.int64), len(w)) == plain_runs(w), w


def test_copies_are_those_of_plain_comparison():
    rng = np.random.default_rng(2)
    ids = rng.integers(1, 3, 600)
    for size in (1, 2, 8, 16):
        starts = np.arange(len(ids) // size) * size
        got = set(zip(*(x.tolist() for x in periods.copies(ids, starts, size))))
        assert got == {(s, d) for s in starts.tolist() for d in range(size, 2 * size)
                       if s + d + size <= len(ids) and (ids[s:s + size] == ids[s + d:s + d + size]).all()}


DOCS = "doc_id bigint, text string, runs string, collapsed int, key int, best string"


def test_periodic_runs_of_documents(spark):
    rng = random.Random(4)
    texts = [" ".join(periodic_words(rng)) for _ in range(150)]
    texts += ["", "   ", "a", "a a a a a", "a a a a a a", "a a " * 3, "\ta b\n" * 4, "very long text " * 30000,
              " ".join(f"w{i % 4999}" for i in range(23000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x y x y x y x y"), (900, None), (3, texts[3]), (3, texts[3])]
    df = spark.createDataFrame([(i, t, "r", 1, 2, "b") for i, t in rows], DOCS)
    found = periods.periodic_runs(df).collect()
    key = lambda r: (r[0] is None, r)
    got = sorted(((r["doc_id"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in found), key=key)
    expected = []
    for i, t in rows:
        w = (t or "").encode().split()
        runs = ((0, 90000, 3),) if len(w) == 90000 else ((0, 23000, 4999),) if len(w) == 23000 else tuple(plain_runs(w))
        drop = {k for s, n, q in runs for k in range(s + q, s + n)}
        expected.append((i, runs, b" ".join(x for k, x in enumerate(w) if k not in drop).decode()))
    assert got == sorted(expected, key=key)
    assert periods.periodic_runs(spark.createDataFrame([], DOCS)).collect() == []


def test_query_equals_plain_python(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = queries.QUERIES["op13_periodic_runs"](spark, FOLDER).collect()
    assert len(found) == len(docs)
    tiled = 0
    for r in found:
        w = (docs[r["doc_id"]] or "").encode().split()
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(w)
        if h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            w, tiled = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)], tiled + 1
        if n > 2500:
            continue  # the plain search is quadratic; long texts are in the test above
        runs = plain_runs(w)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        expected = [len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2]]
        assert [r[c] for c in ("n_runs", "start", "length", "period", "exponent_milli")] == expected
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        drop = {k for s, m, q in runs for k in range(s + q, s + m)}
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in drop)).hexdigest()
    assert tiled > 5
