"""Main text extraction, the two classifiers and the pipeline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldscar.llm import html_blocks, neighbours, toxicity
from fieldscar.llm.common import table
from fieldscar.llm.decontamination import decontaminate
from fieldscar.llm.jaccard import similar_documents
from fieldscar.llm.pii import mask

SMALL, FOLDER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
BODY = "A sentence of the article that is long enough to be told from a menu, and then some more of it."

PAGES = {
    "article": ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><article><h1>Head</h1>"
                f"<p><b>{BODY}<br><p>Short.</p><div class='ad'>buy</div><p>It &amp; that&nbsp;\n x</p></article>"
                "<section id=comments><p>" + "first! " * 40 + "</p></section><footer>&copy; me</footer>",
                f"Head\n{BODY}\nShort.\nIt & that x"),
    "no article": (f"<body><div id='top-menu'><a href=x>One</a><a href=y>Two</a></div><div><p>{BODY}</p><p>End.</p></div>"
                   "<div class='sidebar'><p>" + "Other things. " * 20 + "</p></div><div class=cookie-notice>We use cookies</div>",
                   f"{BODY}\nEnd."),
    "own header": (f"<main><header><div>by me</div><h1>Title</h1></header><p>{BODY}</p><form><p>Search here</p></form></main>", f"Title\n{BODY}"),
    "scripts": (f"<article><script>if (a < b) '</p>';</script><p>{BODY} 1 < 2 &lt;i&gt;</p><noscript>no</noscript><!-- <p>x</p> --></article>",
                f"{BODY} 1 < 2 <i>"),
    "hidden": (f"<article><p hidden>no</p><p style='display: none'>no</p><p>{BODY}</p><ul><li>a<li>b</ul></article>", f"{BODY}\na\nb"),
    "unclosed": (f"<article><div class=share><p>tweet</article><article><p>{BODY}<p>Tail <a href='x", f"{BODY}\nTail"),
    "body beside a teaser": (f"<div><p>{BODY}</p><p>{BODY} More.</p></div><article><p>teaser one</p></article>", f"{BODY}\n{BODY} More.\nteaser one"),
    "body in an article, notes outside": (f"<article><p>{BODY * 4}</p></article><div><p>" + "A short note beside it, ninety signs long or so, which nobody has marked as what it is." + "</p></div>", BODY * 4),
    "link line": (f"<div><p>{BODY}</p><p><a href=x>A source</a></p><p>{BODY}</p></div>", f"{BODY}\nA source\n{BODY}"),
    "names of the text": (f"<article><h2 id='related-work'>Related work</h2><p class='ad-hoc'>{BODY}</p><div class='social-science'>Science.</div>"
                          "<p>x <math><mi>y</mi></math> <svg><text>z</text></svg></p><div class='ad-banner'>buy</div><div id='shareButtons2'>tell</div></article>",
                          f"Related work\n{BODY}\nScience.\nx y z"),
    "empty": ("", ""), "null": (None, ""), "plain": ("just text", "just text"), "markup only": ("<div><p></p></div>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    html, want = PAGES[name]
    assert html_blocks.main_text(html or "") == want


def test_surges_and_dives_equal_plain_search(monkeypatch):
    """The kept lines, from every window of three lines looked at on its own."""
    rng = np.random.default_rng(9)
    for _ in range(400):
        lines = [(f"t{i}", int(rng.choice([0, 3, 40, 120])), bool(rng.random() < 0.2)) if rng.random() < 0.7 else ("", 0, False)
                 for i in range(rng.integers(0, 25))]
        monkeypatch.setattr(html_blocks, "lines_of", lambda _, lines=lines: lines)
        n = len(lines)
        sums = [sum(w for _, w, _ in lines[i:i + 3]) for i in range(n)]
        inner = [sum(w for _, w, within in lines[i:i + 3] if within) for i in range(n)]
        need = max(min(86, max(sums, default=0) / 2), max(inner, default=0) / 2)
        want = []
        for i, (text, _, _) in enumerate(lines):
            low, high = i, i
            while low > 0 and sums[low - 1]:
                low -= 1
            while high < n and sums[high]:
                high += 1
            stretch = range(low, high) if sums[i] else ()
            own = [k for k in stretch if lines[k][1]]
            if text and own and own[0] <= i <= own[-1] and (any(lines[k][2] for k in own) or max(sums[k] for k in stretch) >= need):
                want.append(text)
        assert html_blocks.main_text("") == "\n".join(want)


def test_long_and_hostile_pages_end():
    for html in ("<" * 50_000, "<a b='" * 20_000, "<div>" * 30_000 + "x", "<!--" * 20_000, "<p>" + "y" * 2_000_000, "</p>" * 50_000):
        html_blocks.main_text(html)


def test_extract_keeps_rows_and_ignores_other_columns(spark):
    rows = [(i, "u", h, "mine", "k") for i, (h, _) in enumerate(PAGES.values())] + [(None, None, None, None, None), (0, "u", PAGES["article"][0], "", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, k0 string")
    got = html_blocks.extract(pages).collect()
    assert len(got) == len(rows) and sorted(r.text for r in got if r.page_id == 0) == [PAGES["article"][1]] * 2
    assert html_blocks.extract(pages.filter("false")).count() == 0


def odd_docs(spark):
    rows = [(1, "plain words here"), (2, None), (3, ""), (None, "no id"), (4, "idiot " * 50_000), (1, "plain words here"), (5, "𝄞 é 123 !!!")]
    return spark.createDataFrame([(i, t, 1.0, 1, 1, "w", 3) for i, t in rows],
                                 "doc_id bigint, text string, raw double, toxic int, quality int, word string, n int")


def held(frame, labels, column):
    rows = frame.join(labels, "doc_id").filter("held_out").select("predicted", column, "score").collect()
    return np.array([(r[0], r[1]) for r in rows])


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    found = toxicity.toxicity(docs, labels)
    got = held(found, labels, "toxic")
    assert (got[got[:, 1] == 1, 0] == 1).mean() > 0.9 and (got[got[:, 1] == 0, 0] == 1).mean() < 0.02
    some = found.limit(200).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in some)


def plain_ratios(counts):
    """Log-ratios of all prefixes of (word, n_tox, n_ord), by the formulas of the model."""
    d, mu, tox, ordinary = toxicity.DISCOUNT, toxicity.SHARED_WEIGHT, defaultdict(int), defaultdict(int)
    for word, t, o in counts:
        if t + o:
            for k in range(len(word) + 2):
                tox[(word + "$")[:k]] += t
                ordinary[(word + "$")[:k]] += o
    nodes = [p for p in tox if p]
    kinds, ends = defaultdict(lambda: [0, 0, 0]), Counter(p[-1] for p in nodes)
    for p in nodes:
        for j, met in enumerate((True, tox[p] > 0, ordinary[p] > 0)):
            kinds[p[:-1]][j] += met
    ratio = {}
    for p in nodes:
        q = p[:-1]
        shared = (max(tox[p] + ordinary[p] - d, 0) + d * kinds[q][0] * ends[p[-1]] / len(nodes)) / (tox[q] + ordinary[q])
        of = lambda n, j: (max(n[p] - d, 0) + (d * kinds[q][j] + mu) * shared) / (n[q] + mu)  # noqa: E731, B023
        ratio[p] = np.log(of(tox, 1) / of(ordinary, 2))
    return ratio


def plain_evidence(ratio, word):
    total = sum(ratio.get((word + "$")[:k], 0.0) for k in range(1, len(word) + 2))
    return np.sign(total) * max(abs(total) - toxicity.MARGIN, 0)


@pytest.mark.parametrize("slices", [1, 7, 60])
def test_word_weights_equal_plain_model(spark, slices):
    rng = np.random.default_rng(slices)
    stems = ["ab", "abc", "é", "idiot", "zz", "b" * 99]
    words = {rng.choice(stems)[:rng.integers(1, 100)] + "".join(rng.choice(list("abcé"), rng.integers(0, 5))) for _ in range(300)}
    counts = [(w, int(rng.integers(0, 30) * (w[0] == "i" or rng.random() < 0.2)), int(rng.integers(0, 3) * rng.integers(0, 40))) for w in sorted(words)]
    frame = spark.createDataFrame(counts, "word string, n_tox bigint, n_ord bigint")
    conf = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    try:
        got = {r.word: r.weight for r in toxicity.word_weights(frame.repartition(3)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", conf)
    ratio = plain_ratios(counts)
    expected = {w: e for w, *_ in counts if (e := plain_evidence(ratio, w))}
    assert set(got) == set(expected) and min(expected.values()) < 0 < max(expected.values())
    assert all(got[w] == pytest.approx(e) for w, e in expected.items())


def test_toxicity_equals_plain_model(spark, monkeypatch):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    train = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 5}
    both = docs.select("doc_id", "text").unionByName(odd_docs(spark).select("doc_id", "text"))
    rows, counts = both.collect(), defaultdict(lambda: [0, 0])
    words = lambda t: toxicity.words_of(t or "")
    for r in docs.collect():
        for w in words(r.text):
            if r.doc_id in train:
                counts[w][train[r.doc_id]] += 1
    ratio = plain_ratios([(w, t, o) for w, (o, t) in counts.items()])
    expected = sorted((r.doc_id or -1, round(sum(plain_evidence(ratio, w) for w in words(r.text)) / (len(words(r.text)) + toxicity.PRIOR_WORDS), 9)) for r in rows)
    labelled = docs.join(spark.createDataFrame(list(train.items()), "doc_id bigint, toxic int"), "doc_id").select("text", "toxic")
    weights = toxicity.word_weights(toxicity.word_counts(labelled.unionByName(both.select("text", F.lit(None).cast("int").alias("toxic")))))
    for by in (toxicity._raw_by_broadcast, toxicity._raw_by_words):
        assert sorted((r.doc_id or -1, round(r.raw, 9)) for r in by(both, weights).collect()) == expected
    assert any(x > 0 for _, x in expected)
    found = sorted((r.doc_id or -1, round(r.score, 9), r.predicted) for r in toxicity.toxicity(docs, labels, both).collect())
    monkeypatch.setattr(toxicity, "BROADCAST_WEIGHTS", 0)
    assert found == sorted((r.doc_id or -1, round(r.score, 9), r.predicted) for r in toxicity.toxicity(docs, labels, both).collect())


def test_model_probabilities_are_kneser_ney():
    got = plain_ratios([("ab", 6, 1), ("ac", 1, 8), ("b", 2, 3)])
    d, mu = toxicity.DISCOUNT, toxicity.SHARED_WEIGHT
    shared = (7 - d + d * 2 * 2 / 7) / 16  # b after a: 7 of 16; prefixes: a ab ab$ ac ac$ b b$, two of which end in b
    tox, ordinary = (6 - d + (d * 2 + mu) * shared) / (7 + mu), (1 - d + (d * 2 + mu) * shared) / (9 + mu)
    assert got["ab"] == pytest.approx(np.log(tox / ordinary)) and got["ab"] > 0 > got["ac"]


def test_long_stretches_of_letters_are_several_words():
    assert [len(w) for w in toxicity.words_of("a" * 250 + " b")] == [100, 100, 50, 1]


def test_classifiers_on_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 0, 1), (4, 1, 0), (4, 0, 0), (9, 1, 1), (None, 1, 1), (5, None, None)], "doc_id bigint, toxic int, quality int")
    none = labels.filter("false")
    for operator in (toxicity.toxicity, neighbours.quality):
        got = operator(docs, labels).collect()
        assert len(got) == 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
        assert [r.held_out for r in got if r.doc_id is None] == [False]
        assert operator(docs, none).count() == 7 and operator(docs.filter("false"), labels).count() == 0
    assert {r.score for r in neighbours.quality(docs, none).collect()} == {0.5}


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    got = held(neighbours.quality(docs, labels), labels, "quality")
    assert (got[got[:, 1] == 0, 0] == 0).mean() > 0.8 and (got[:, 0] == got[:, 1]).mean() > 0.95


def test_equally_near_voters_vote_in_their_order():
    voters = neighbours.unit(np.repeat(np.eye(4), 20, axis=0))
    labels = np.arange(80) % 20 < 10  # of 20 equal voters the first 10 say yes
    got = neighbours.vote(neighbours.unit(np.eye(4)), voters, labels.astype(float))
    assert got == pytest.approx([10 / neighbours.NEIGHBOURS] * 4)


def test_quality_equals_plain_voting(spark):
    """The whole score: terms, space and votes once more, without Spark, from the same voters."""
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    marks = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    ids = sorted(marks)
    raw = np.array([neighbours.term_counts(texts[i]) for i in ids])
    w = neighbours.weighted(raw)
    idf = np.log((1 + len(ids)) / (1 + (w > 0).sum(axis=0))) + 1
    _, _, right = np.linalg.svd((w * idf).astype(np.float64), full_matrices=False)
    space = right[:neighbours.LATENT].T
    voters = neighbours.unit((w * idf) @ space)
    got = {r.doc_id: r.score for r in neighbours.quality(docs, labels).collect()}
    close = 0
    for i, text in texts.items():
        v = neighbours.unit((neighbours.weighted(neighbours.term_counts(text)[None]) * idf) @ space)[0]
        near = sorted(((float(v @ u), -k) for k, u in enumerate(voters)), reverse=True)[:neighbours.NEIGHBOURS]
        weights = [max(c, 1e-3) ** neighbours.SHARPNESS for c, _ in near]
        want = sum(x * marks[ids[-k]] for x, (_, k) in zip(weights, near)) / sum(weights)
        close += abs(got[i] - want) < 1e-3
    assert close >= 0.97 * len(texts)  # single precision may order all but equal neighbours otherwise


def test_words_change_the_vector_of_a_text():
    a, b = (neighbours.weighted(neighbours.term_counts(t)[None])[0] for t in ("some plain words in a line", "sema ploin wards on e lane"))
    assert (a[:neighbours.SHAPE_TERMS] == b[:neighbours.SHAPE_TERMS]).all() and (a[neighbours.WORDS_FROM:] != b[neighbours.WORDS_FROM:]).any()


def test_votes_are_exact_nearest_neighbours():
    rng = np.random.default_rng(8)
    voters, docs, labels = neighbours.unit(rng.normal(size=(300, 8))), neighbours.unit(rng.normal(size=(700, 8))), rng.integers(0, 2, 300)
    got = neighbours.vote(docs, voters, labels)
    for i in range(0, 700, 50):
        cosines = sorted(((float(docs[i] @ v), int(y)) for v, y in zip(voters, labels)), reverse=True)[:neighbours.NEIGHBOURS]
        weights = [max(c, 1e-3) ** neighbours.SHARPNESS for c, _ in cosines]
        assert got[i] == pytest.approx(sum(w * y for w, (_, y) in zip(weights, cosines)) / sum(weights))


def test_pipeline_equals_its_operators(spark):
    """Every stage's decisions, taken from the operators and applied in plain Python."""
    docs = {r.doc_id: r for r in table(spark, SMALL, "documents").collect()}
    labels, benchmark = table(spark, SMALL, "labels"), table(spark, SMALL, "benchmark")
    frame = lambda: spark.createDataFrame(list(docs.values()), table(spark, SMALL, "documents").schema)
    for r in toxicity.toxicity(frame(), labels).filter("predicted = 1").collect():
        docs.pop(r.doc_id)
    for r in similar_documents(frame()).filter("doc_id <> component_id").collect():
        docs.pop(r.doc_id)
    for r in decontaminate(frame(), benchmark).filter("contaminated").collect():
        docs.pop(r.doc_id)
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in got} == set(docs)
    from tokenizers import Tokenizer

    from fieldscar.llm.packing import tokenizer_path
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {i: tokenizer.encode(mask(r.text or ""), add_special_tokens=False).ids + [0] for i, r in docs.items()}
    for r in got:
        cut = np.asarray(ids[r.doc_id][r.start:r.start + r.length], dtype="<u4")
        assert zlib.crc32(cut.tobytes()) == r.ids_crc32
    assert sum(r.length for r in got) == sum(map(len, ids.values()))


def test_stages_keep_the_columns_and_odd_rows(spark):
    schema = table(spark, SMALL, "documents").schema
    rows = [(1, "a b c d e f", "en", "s", 11), (2, "a b c d e f", "en", "s", 11), (2, "a b c d e f", "en", "s", 11), (3, None, "en", "s", 0),
            (4, "", None, None, None), (None, "mail a@b.cd now", "en", "s", 15)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in schema], name
        kept = out.collect()
        assert len(kept) == (4 if name == "near_copies" else 6), name
    assert corpus_pipeline.drop_near_copies(spark, docs.filter("doc_id = 2"), SMALL).count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs.filter("false"), SMALL).count() == 0
