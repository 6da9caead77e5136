"""Packing, personal data and WARC archives against plain Python."""

import hashlib
import re
import zlib
from itertools import combinations

import numpy as np
import pytest

from fieldscar.llm import packing, pii, warc

DOCS = "doc_id bigint, text string, row string, key int, piece string, length string, spans string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", "z", "s") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(3)
    words = ["the", "Über", "thandre,", "it's", "x.y", "42", "naïve.", "一二", "!?", "end."]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 900)))) for i in range(60)]
    return rows + [(60, None), (61, ""), (62, "long word " * 20_000), (None, "no id"), (3, rows[3][1])]


def fewest(lengths, capacity):
    """Optimal bin count by trying all partitions of few items."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for j, room in enumerate(bins):
            if room >= lengths[i] and room not in bins[:j]:
                place(i + 1, bins[:j] + [room - lengths[i]] + bins[j + 1:])
        place(i + 1, bins + [capacity - lengths[i]])
    place(0, [])
    return best[0]


def test_plan_is_near_the_optimum():
    rng, extra = np.random.default_rng(5), 0
    for _ in range(60):
        lengths = rng.integers(1, 21, rng.integers(1, 11))
        plan = packing.pack_plan(np.bincount(lengths, minlength=21), 20)
        assert sorted(n for b, times in plan for n in b * times) == sorted(lengths.tolist())
        assert all(sum(b) <= 20 for b, _ in plan)
        extra += sum(times for _, times in plan) - fewest(lengths.tolist(), 20)
    assert extra <= 2


def test_dominating_sets_keep_the_optimum():
    rng = np.random.default_rng(6)
    for _ in range(80):
        lengths = rng.integers(3, 21, rng.integers(2, 10)).tolist()
        chosen = packing._dominating(np.bincount(lengths, minlength=21), 20)
        if chosen:
            rest = list(lengths)
            for n in chosen:
                rest.remove(n)
            assert 1 + (fewest(rest, 20) if rest else 0) == fewest(lengths, 20)


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.packed(docs_of(spark, texts)).collect()
    want = []
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for p, at in enumerate(range(0, len(ids), 2048)):
            cut = np.asarray(ids[at:at + 2048], dtype="<u4")
            want.append((i, p, at, len(cut), zlib.crc32(cut.tobytes())))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 2048) * 1.05 + 1


def test_packing_of_nothing_and_of_one_hot_length(spark):
    assert packing.packed(docs_of(spark, [])).count() == 0
    got = packing.packed(docs_of(spark, [(i, "same text here") for i in range(3000)])).collect()
    assert {r.length for r in got} == {4} and len({r.sequence_id for r in got}) == -(-3000 // 512)


def test_word_cache_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    cache = packing.WordCache(packing.tokenizer_path())
    for text in ["Áb. C", "İstanbul ΑΣ. ß", "x. y,\tz", "a\x1cb", "don't, 12.5, 3", "<|endoftext|> hi", "é. ..., a!, b?.", " ", "a b."]:
        assert list(np.frombuffer(cache.encode([text])[0], "<u4")) == tokenizer.encode(text, add_special_tokens=False).ids


def test_word_cache_equals_the_tokenizer_on_random_texts():
    """Words in any order, one cache for all texts, and one that drops words again and again."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rng = np.random.default_rng(12)
    signs = list("aAbZé9.,!~'<|> \t\u0301\u030cßİΣ一𝄞") + ["<|endoftext|>", "'s", "ing ", ". "]
    texts = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(3000)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    cache, packing.CACHED_WORDS, kept = packing.WordCache(packing.tokenizer_path()), 500, packing.CACHED_WORDS
    try:
        got = [ids for i in range(0, len(texts), 100) for ids in cache.encode(texts[i:i + 100])]
    finally:
        packing.CACHED_WORDS = kept
    assert [list(np.frombuffer(g, "<u4")) for g in got] == want


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                  "card": 12 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0,
                  "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


ODD = ["", "a@b.c", "@@a@b..c@d.e", "x@y x.y+z%q@é.com ü@b.co", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255",
       "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111", "+1 (555) 555-1234. +12345678 +1234567890123456", "é+49 30 1234567-" * 3,
       "a" * 3000 + "@b.cd and " + "1" * 4000, "DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 DE89370400440532013001"]


def test_base_spans_equal_plain_patterns():
    rng = np.random.default_rng(1)
    alphabet = list("ab@@..19+- ()") + ["é"]
    for text in ODD + ["".join(rng.choice(alphabet, 60)) for _ in range(400)]:
        assert [s for s in pii.find_spans(text) if s[1] < 4] == plain_base(text), text


def test_pii_query_edges(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (3, ODD[3])]
    got = {(r.doc_id, i): r.spans for i, r in enumerate(pii.pii_spans(docs_of(spark, rows)).collect())}
    assert len(got) == len(rows)
    iban = [s for spans in got.values() for s in spans if s.kind == "iban"]
    assert len(iban) == 2  # the third fails mod 97
    assert pii.scored("call +1 (555) 555-1234")[0]["score"] > pii.scored("xyz +1 (555) 555-1234")[0]["score"]
    masked = {r.doc_id: r for r in pii.mask_texts(docs_of(spark, rows)).collect()}
    assert masked[1].text == "[EMAIL]" and masked[None].text is None and masked[0].key == 1
    assert pii.pii_spans(docs_of(spark, [])).count() == 0


TOKEN = "04dbebab91ab85687d33eeaaf9"


@pytest.mark.parametrize("text, kinds, masked", [
    ("my ssn is 123-45-6789 ok", "ssn", "my ssn is [SSN] ok"),  # a context word decides
    ("part no 123-45-6789 ok", "", "part no 123-45-6789 ok"),
    ("ssn 000-45-6789, 123-00-6789", "", "ssn 000-45-6789, 123-00-6789"),
    (f'x token = "{TOKEN}" y', "secret", 'x token = "[SECRET]" y'),
    (f"x thing = {TOKEN} y", "", f"x thing = {TOKEN} y"),
    (f"token {'ab' * 15} = {'a1' * 12}", "", f"token {'ab' * 15} = {'a1' * 12}"),  # not varied
    ("id ghp_x4111111111111111 y", "card", "id ghp_x4111111111111111 y"),  # digits inside an identifier
    ("visa card x4111111111111111 y", "card", "visa card x[CARD] y"),
    ("pay 4111111111111111 y", "card", "pay [CARD] y"),
])
def test_context_decides(text, kinds, masked):
    assert " ".join(s["kind"] for s in pii.scored(text)) == kinds and pii.mask(text) == masked


def plain_own_spans(text):
    """Spans of the kinds beside the base, by trying every stretch of the text."""
    found, word = [], lambda a, b, kind: sum(
        w in pii.CONTEXT[kind] for w in {x.lower() for x in re.findall(r"[^\W\d_]+", text[max(0, a - 40):a] + " " + text[b:b + 40])})
    for a in range(len(text)):
        for b in range(a + 11, len(text) + 1):
            part, before, after = text[a:b], text[a - 1:a], text[b:b + 1]
            if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", part) and not re.match(r"[0-9-]", before + " ") and not re.match(r"[0-9-]", after + " "):
                if part[:3] not in ("000", "666") and part[0] != "9" and part[4:6] != "00" and part[7:] != "0000" and word(a, b, "ssn"):
                    found.append(("ssn", a, b))
            if re.fullmatch(r"[A-Za-z0-9+/_-]{20,}={0,2}", part) and not re.match(r"[A-Za-z0-9+/_=-]", before + " ") and not re.match(
                    r"[A-Za-z0-9+/_=-]", after + " "):
                share = [part.count(c) / len(part) for c in set(part)]
                gain = 0.15 * word(a, b, "secret") + 0.2 * bool(re.search("[=:]\\s{0,3}[\"']?$", text[max(0, a - 8):a]))
                if re.search("[0-9]", part) and re.search("[A-Za-z]", part) and -sum(x * np.log2(x) for x in share) >= 3 and 0.4 + gain >= 0.7 - 1e-9:
                    found.append(("secret", a, b))
    return sorted(found)


def test_own_spans_equal_plain_search():
    rng = np.random.default_rng(17)
    bits = ["ssn ", "social ", "123-45-6789", "666-12-1234", "-", "1", " ", "token", " = ", ": ", '"', TOKEN, "Zx9" * 3, "key ", "word ", "abcdefgh12345678ijkl"]
    for _ in range(150):
        text = "".join(rng.choice(bits, 7))
        assert sorted((s["kind"], s["start"], s["end"]) for s in pii.scored(text) if s["kind"] in ("ssn", "secret")) == plain_own_spans(text), text


def test_warc_round_trip(spark, tmp_path):
    hot = "<p>" + "copy " * 40
    rows = [(i, f"http://x/{i}", f"<html>{i}\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n" + "é" * i) for i in range(40)]
    rows += [(100 + i, None if i % 2 else "http://a b\n/c", hot) for i in range(30)] + [(200, "u", None), (201, "u", ""), (202, "u", "s"), (203, "u", "s")]
    rows += [(0, "http://x/0", rows[0][2]), (None, "v", hot)]
    pages = spark.createDataFrame([(*r, "n") for r in rows], "page_id bigint, url string, html string, digest string")
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    records = warc.read_archives(spark, path)
    assert records.count() == 3 * len(rows)
    got = warc.captures(records).collect()
    assert len(got) == len(rows) and all(r.request and r.metadata for r in got)
    mine = sorted((r.metadata.fields.get("page-id") or "", r.response.type, r.original_page or "", r.response.digest) for r in got)
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    seen, want = set(), []
    for i, _, h in rows:
        again = h in first and (i != first[h] or i in seen)
        seen.add(i)
        want.append(("" if i is None else str(i), "revisit" if again else "response", str(first[h]) if again else "",
                     hashlib.sha256((h or "").encode()).hexdigest()))
    assert mine == sorted(want)


def test_warc_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    warc.write_archives(empty, str(tmp_path / "none"))
    assert warc.captures(warc.read_archives(spark, str(tmp_path / "none"))).count() == 0


def test_all_pairs_of_spans_do_not_overlap_per_kind():
    spans = pii.find_spans(" ".join(ODD))
    assert all(a[2] <= b[0] or b[2] <= a[0] or a[1] != b[1] for a, b in combinations(spans, 2))


CARD_OVER_IBAN = next(f"NO93 8601 1117 947-{d}" for d in range(10) if pii.luhn(f"9386011117947{d}"))
CARD_IN_PHONE = next(f"+37 8282 2463 100{d}" for d in range(10) if pii.luhn(f"3782822463100{d}"))


@pytest.mark.parametrize("text, kinds, want", [
    ("call +49 30 1234567.max@mail.de now", "phone email", "call [PHONE] now"),
    ("x 1.2.3.4 111 1111 1111 1111 y", "ip card", "x [IP] y"),
    ("x 1.2.3.4.n@mail.de y", "email ip", "x [EMAIL] y"),
    ("x n@mail.4111 1111 1111 1111 y", "email card", "x [EMAIL] y"),
    ("x me+49301234567@mail.de y", "email phone", "x [EMAIL] y"),
    ("x +49 30 1.2.3.4.5.6.7 y", "phone ip", "x [PHONE] y"),
    (f"x {CARD_IN_PHONE} y", "phone card", "x [PHONE] y"),
    ("x DE89 3704 0044 0532 0130 00@mail.de y", "iban email", "x [IBAN] y"),
    ("x DE89 3704 0044 0532 0130 00.1.2.3 y", "iban ip", "x [IBAN] y"),
    (f"x {CARD_OVER_IBAN} y", "iban card", "x [IBAN] y"),
    ("x n@mail.de n@mail.de,1.2.3.4 y", "email email ip", "x [EMAIL] [EMAIL],[IP] y"),
])
def test_overlapping_spans_are_masked_to_their_last_end(text, kinds, want):
    found = [pii.KINDS[k] for _, k, _ in pii.find_spans(text)]
    assert sorted(set(found)) == sorted(set(kinds.split())) and pii.mask(text) == want
