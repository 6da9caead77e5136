"""Jaccard join, decontamination, fingerprints and licences against plain Python and SQL."""

import re
import sys
from pathlib import Path

import numpy as np
import pytest
import xxhash

from fieldscar.llm import decontamination, jaccard, licenses, queries, winnowing
from fieldscar.llm.shingles import shingle_sets

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
import compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, row string, c int, n string, k string, family string, pos int, place string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "n", "k", "f", 2, "p") for i, t in rows], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    result = compare.compare(spark, compare.connect(FOLDER), FOLDER, name)
    assert result.startswith("ok") and "TYPES" not in result, result


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def plain_components(rows, k=4, percent=85):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()})
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    ids = {}
    for (i, _), x in zip(rows, label):
        if i is not None:
            ids[x] = min(i, ids.get(x, i))
    return sorted((-1 if i is None else i, len(s), ids.get(x, -1)) for (i, _), s, x in zip(rows, sets, label))


def near_copies(rng, n, words, edits):
    base = rng.choice(words, 120)
    out = []
    for _ in range(n):
        w = base.copy()
        for at in rng.integers(0, len(w), rng.integers(0, edits + 1)):
            w[at] = rng.choice(words)
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(7)
    words = np.array([f"w{i}" for i in range(3000)])
    texts = near_copies(rng, 90, words, 6) + near_copies(rng, 30, words, 2) + near_copies(rng, 20, words, 12)
    line = " ".join(rng.choice(words, 12))
    texts += [f"{line} {' '.join(rng.choice(words, rng.integers(4, 60)))}" for _ in range(60)]
    texts += ["", None, " \t\n", "one", "One", "two words", "a b c d", "a b c", texts[0].upper(), "É e", "é e", " ".join(words) * 20]
    ids = rng.permutation(len(texts)).tolist()
    return [*zip(ids, texts), (None, texts[0]), (None, "nobody else"), (ids[5], texts[5]), (ids[6], texts[7])]


@pytest.mark.parametrize("block", [256, 8])
def test_components_equal_plain_loops(spark, corpus, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = jaccard.similar_documents(docs_of(spark, corpus)).collect()
    mine = sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in got)
    want = plain_components(corpus)
    # a doc_id on two texts names both components; plain loops keep rows apart as well
    assert mine == want


def test_components_of_nothing_and_of_strangers(spark):
    assert jaccard.similar_documents(docs_of(spark, [])).count() == 0
    got = jaccard.similar_documents(docs_of(spark, [(4, "a b c d e"), (2, "f g h i j"), (9, None)])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(4, 4), (2, 2), (9, 9)}


def test_linked_at_the_exact_threshold():
    a = np.arange(100, dtype=np.uint64)
    assert jaccard.linked([a[:85], a], 85) == [(1, 0)] and jaccard.linked([a[:84], a], 85) == []
    assert jaccard.linked([a[:17], a[:20]], 85) == [(1, 0)]


def test_shingles_do_not_depend_on_neighbours(monkeypatch):
    import pyarrow as pa
    from fieldscar.llm import shingles

    texts = ["a b c d e", "", None, "  a b c d e ", "A\tB\nC d E", "x", "é ü", "a b c d f", "d e a b c d"]
    alone = [next(iter(shingle_sets(pa.array([t], pa.string()), 4))).tolist() for t in texts]
    for size in (1, 8, 1 << 22):
        monkeypatch.setattr(shingles, "CHUNK_BYTES", size)
        assert [s.tolist() for s in shingle_sets(pa.array(["zz", *texts]).slice(1), 4)] == alone
    assert alone[0] == alone[3] == alone[4] and alone[0] != alone[7] and not alone[1] and not alone[2]


def plain_hits(docs, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    wins = set()
    for i, t in items:
        w = words(t)
        m = min(window, len(w))
        wins |= {(tuple(w[p:p + m]), i) for p in range(len(w) - m + 1)} if w else set()
    out = []
    for i, t in docs:
        w, hit, of = words(t), set(), set()
        for text, item in wins:
            for p in range(len(w) - len(text) + 1):
                if tuple(w[p:p + len(text)]) == text:
                    hit |= set(range(p, p + len(text)))
                    of.add(str(item))
        out.append((-1 if i is None else i, len(w), len(hit), ",".join(sorted(of))))
    return sorted(out)


def test_decontamination_equals_plain_search(spark):
    import hashlib

    rng = np.random.default_rng(2)
    items = [(i, " ".join(rng.choice(list("abcdefgh"), rng.integers(8, 16)))) for i in range(12)]
    items += [(12, None), (13, ""), (14, "Z"), (15, "z q!z"), (2, items[3][1]), (16, items[3][1]), (17, "x y z w")]
    docs = [(i, " ".join(rng.choice(list("abcdefgh"), 30)) + " " + items[i % 12][1].upper() + ", z-q z " * (i % 3)) for i in range(25)]
    docs += [(30, None), (31, ""), (32, "z"), (33, "é é"), (None, items[0][1]), (1, docs[1][1]), (34, (items[4][1] + " ") * 300)]
    got = decontamination.decontaminate(docs_of(spark, docs), spark.createDataFrame(items, "item_id int, text string")).collect()
    mine = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r.items_sha256, r.n_items, r.contaminated) for r in got)
    want = sorted((i, n, h, hashlib.sha256(ids.encode()).hexdigest(), len(ids.split(",")) if ids else 0, h > 0) for i, n, h, ids in plain_hits(docs, items))
    assert mine == want


def test_decontamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    got = decontamination.decontaminate(docs_of(spark, [(1, "a b")]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False)]
    assert decontamination.decontaminate(docs_of(spark, []), spark.createDataFrame([(1, "a b")], "item_id int, text string")).count() == 0


def plain_picks(text):
    k, w = winnowing.GRAM, winnowing.WINDOW
    if not text:
        return []
    runs = [text[i:i + k].encode("utf-32-be") for i in range(max(1, len(text) - k + 1))]
    h = [0xFFFFFFFF - (xxhash.xxh64_intdigest(r, seed=42) >> 31 & 0xFFFFFFFF) for r in runs]
    picks = []
    for i in range(max(1, len(h) - w + 1)):
        part = h[i:i + w]
        at = i + max(j for j, v in enumerate(part) if v == min(part))
        if at not in picks:
            picks.append(at)
    return [(h[p], p) for p in picks]


def plain_likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("per_cell", [512, 3])
def test_fingerprints_equal_plain_winnowing(spark, monkeypatch, per_cell):
    monkeypatch.setattr(winnowing.in_cells, "__defaults__", (per_cell,))
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("ab é𝄞"), rng.integers(0, 120))) for _ in range(25)] + ["aaaaaaaa" * 20, None, "", "ab", "ab"]
    ids = sorted(rng.choice(5000, len(texts), replace=False).tolist())
    rows = [*zip(ids, texts), (ids[3], texts[3]), (None, "first of all")]
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))
    want = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, e, b = plain_picks(t), plain_picks(edited), plain_picks(nxt)
        text = lambda p: ",".join(f"{h:x}@{at}" for h, at in p)
        want.append((-1 if i is None else i, len(t), edited, text(a), text(e), plain_likeness(a, e), plain_likeness(a, b)))
    from pyspark.sql import functions as F
    got = winnowing.fingerprints(docs_of(spark, rows)).select(
        F.coalesce("doc_id", F.lit(-1)), "n_chars", "edited_text", winnowing.as_text(F.col("picks")),
        winnowing.as_text(F.col("edited_picks")), "near_edited", "near_next").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_fingerprint_of_one_and_of_no_document(spark):
    assert winnowing.fingerprints(docs_of(spark, [])).count() == 0
    (r,) = winnowing.fingerprints(docs_of(spark, [(7, "abcd" * 30)])).collect()
    assert r.near_next == 1.0 and r.edited_text == "abcd" * 30


def test_licence_rules(spark):
    s = licenses.SENTENCES
    mit = "\n".join(s[k] for k in ("mit-title", "mit-grant", "mit-notice", "mit-warranty", "mit-liability"))
    rows = [
        (1, mit), (2, s["mit-grant"] + "\nnoise here\n" + s["mit-notice"]), (3, f"{s['apache-line']} Text. {s['gpl3-line']} {s['apache-line']}"),
        (4, None), (5, ""), (6, "no licence at all. " * 5000), (None, s["reserved"]), (1, mit),
        (7, "\n".join(s[k] for k in ("apache-notice", "apache-copy", "apache-warranty", "apache-see"))),
        (8, s["gpl-hope"] + s["gpl-details"]), (9, "LICENSED  under the apache license, version 2.0!!"),
    ]
    got = [(r.doc_id, r.licenses, r.matches) for r in licenses.license_matches(docs_of(spark, rows)).collect()]
    by_id = {i: (lic, m) for i, lic, m in got}
    assert len(got) == len(rows)
    assert by_id[1][0] == "MIT" and by_id[1][1].startswith("mit-titled-text:0:") and "," not in by_id[1][1]
    assert by_id[2][1].split(":")[0] == "mit-part" and by_id[3] == ("Apache-2.0,GPL-3.0", "apache-short:0:0,gpl3-short:2:2,apache-short:3:3")
    assert by_id[4] == by_id[5] == by_id[6] == by_id[8] == ("", "") and by_id[None][0] == "all-rights-reserved"
    assert by_id[7][0] == "Apache-2.0" and by_id[7][1].startswith("apache-header:0:") and by_id[9][0] == "Apache-2.0"
    assert licenses.license_matches(docs_of(spark, [])).count() == 0


def test_every_licence_rule_finds_its_text(spark):
    def text(name):
        sid, _, k = name.partition("/")
        return licenses.parts_of(licenses.ALL_SENTENCES[sid])[int(k)] if k else licenses.ALL_SENTENCES[sid]

    rules = licenses.ALL_RULES
    rows = [(i, "intro\n" + "\n".join(map(text, ids))) for i, (_, _, ids) in enumerate(rules)]
    rows += [(900, "This program is free software."), (901, "Foo is free software; " + text("gpl2-free/1") + "; version 7 of the License")]
    got = {r.doc_id: r for r in licenses.license_matches(docs_of(spark, rows)).collect()}
    for i, (name, licence, ids) in enumerate(rules):
        last = len(licenses.rule_parts(ids, licenses.ALL_SENTENCES))
        assert (got[i].licenses, got[i].matches, got[i].n_known) == (licence, f"{name}:1:{last}", last), name
    assert got[900].licenses == got[901].licenses == ""


def test_wrapped_licence_texts(spark):
    import textwrap

    def wrapped(ids, width, mark="", head=""):
        texts = [textwrap.fill(licenses.ALL_SENTENCES[i], width, break_on_hyphens=False, break_long_words=False).replace("\n", "\n" + mark) for i in ids]
        return head + mark + f"\n{mark}\n{mark}".join(texts)

    named = {name: (licence, ids) for name, licence, ids in licenses.ALL_RULES}
    whole = ["mit-titled-text", "apache-header", "gpl3-header", "gpl2-header", "gpl2-only-header", "agpl3-header", "bsd2-text", "bsd3-text", "isc-text", "mpl2-header"]
    cases = [(name, width, mark) for name in whole for width, mark in ((72, ""), (40, " * "), (1, "# "))]
    rows = [(i, wrapped(named[name][1], width, mark, "Copyright (c) 2020 N. N.\n")) for i, (name, width, mark) in enumerate(cases)]
    grant = licenses.SENTENCES["mit-grant"]
    rows += [
        (900, "MIT License\n" + textwrap.fill(grant, 60)), (901, textwrap.fill(grant, 60).replace("\n", "\n\n", 1)),
        (902, textwrap.fill(grant, 60).replace("\n", ".\n", 1)), (903, textwrap.fill(grant, 60).replace("\n", "\nother\n", 1)),
        (904, textwrap.fill(grant, 60).rsplit("\n", 1)[0]),
        (905, "1. " + licenses.SENTENCES["bsd-redistribution"].replace("forms, ", "forms,\n") + "\n1. " + licenses.SENTENCES["bsd-source"].replace("this list", "this\n   list")
         + "\r\n2. " + licenses.SENTENCES["bsd-binary"].replace("this list", "this\r\n   list")),
    ]
    got = {r.doc_id: r for r in licenses.license_matches(docs_of(spark, rows)).collect()}
    for i, (name, width, mark) in enumerate(cases):
        assert got[i].licenses == named[name][0] and got[i].matches.startswith(name + ":") and "," not in got[i].matches, (cases[i], got[i])
        assert got[i].n_known == len(licenses.rule_parts(named[name][1], licenses.ALL_SENTENCES))
    assert got[900].matches == f"mit-titled:0:0,mit-part:1:{got[900].n_sentences - 1}"
    assert [got[i].licenses for i in (901, 902, 903, 904)] == [""] * 4 and got[905].licenses == "BSD-2-Clause"
