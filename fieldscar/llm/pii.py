"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score.

Spans of the base kinds are always reported, with their score; those of the other kinds only if the score, which nearby
words raise, reaches ACCEPTED. Masking asks all spans for MASKED, so that a run of digits inside an identifier, which
may pass for a card number by chance, is left alone unless a word speaks for it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_map, register, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
_ASSIGNED = re.compile(r"[=:]\s{0,3}[\"']?\Z")
_WORD = re.compile(r"[^\W\d_]+")

#: Words that make a span of the kind likelier when they stand close to it.
CONTEXT = {
    "email": {"mail", "email", "contact", "write", "correo", "adresse"},
    "ip": {"ip", "host", "server", "address", "login", "adresse"},
    "card": {"card", "visa", "credit", "payment", "karte", "carte", "tarjeta"},
    "phone": {"phone", "call", "tel", "mobile", "telefon", "fax"},
    "iban": {"iban", "bank", "account", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security", "insurance", "taxpayer"},
    "secret": {"token", "secret", "key", "api", "apikey", "password", "passwort", "clave", "bearer", "credential", "credentials"},
}
START_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.6, "secret": 0.4}
CONTEXT_CHARS, CONTEXT_GAIN = 40, 0.15
#: What a value gains right after = or :, and what digits lose inside an identifier.
ASSIGNED_GAIN, INSIDE_LOSS = 0.2, 0.4
ACCEPTED, MASKED = 0.7, 0.5
#: Bits per character that a secret has at least.
SECRET_ENTROPY = 3.0


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def varied(value: str) -> bool:
    """Whether a string looks drawn at random: letters and digits, many different ones."""
    if value.isalpha() or not any(c.isalpha() for c in value) or not any(c.isdigit() for c in value):
        return False
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values()) >= SECRET_ENTROPY


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part and domain, found from each @ outwards: the local part is
    the whole run of its characters before the @, so no start further left can match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done:  # widen the look-back window until the run ends inside it
            low = max(done, start - 256)
            run = _LOCAL_END.search(text[low:start])
            start = low + run.start() if run else start
            if not run or start > low:
                break
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _digits(text: str, start: int, end: int) -> str:
    return "".join(c for c in text[start:end] if "0" <= c <= "9")


def confirmed(text: str) -> list[tuple[int, int, int]]:
    """(start, index in KINDS, end) of all spans that their checks confirm, whatever their score."""
    found = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        parts = m.group().split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(text, m.start(), m.end())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(text, m.start(), m.end())) <= 15:
                found.append((m.start(), 3, m.end()))
    for m in _IBAN.finditer(text):
        if mod97(m.group().replace(" ", "")):
            found.append((m.start(), 4, m.end()))
    for m in _SSN.finditer(text):
        found.append((m.start(), 5, m.end()))
    for m in _SECRET.finditer(text):
        if varied(m.group()):
            found.append((m.start(), 6, m.end()))
    return sorted(found)


def score(text: str, start: int, kind: str, end: int) -> float:
    """How likely a confirmed span is what its kind says: its start score, the words around it and its neighbours."""
    around = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
    near = {w.lower() for w in _WORD.findall(around)} & CONTEXT[kind]
    total = START_SCORE[kind] + CONTEXT_GAIN * len(near)
    if kind == "secret" and _ASSIGNED.search(text[max(0, start - 8):start]):
        total += ASSIGNED_GAIN
    if kind == "card" and any(c.isalnum() or c == "_" for c in text[max(0, start - 1):start] + text[end:end + 1]):
        total -= INSIDE_LOSS
    return min(1.0, round(total, 6))


def scored(text: str) -> list[dict]:
    """All spans of base kinds, and those of the others whose score is ACCEPTED, by start, then kind."""
    out = [{"kind": KINDS[k], "start": start, "end": end, "score": score(text, start, KINDS[k], end)} for start, k, end in confirmed(text)]
    return [s for s in out if s["kind"] in BASE_KINDS or s["score"] >= ACCEPTED]


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index in KINDS, end) of ``scored``."""
    return [(s["start"], KINDS.index(s["kind"]), s["end"]) for s in scored(text)]


def pii_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans`` (kind, start, end in code points, score) for every row of ``docs``.

    A null text is an empty one and has no spans; a null key is kept; repeated rows each give a
    row; other columns are ignored. Each text is read whole, in the task that scans it.
    """
    def rows(batch):
        yield {"key": batch.column(0), "spans": [scored(t or "") for t in batch.column(1).to_pylist()]}

    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return arrow_map(source, f"key {kind}, spans {SPANS}", rows).withColumnRenamed("key", key)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def mask(text: str) -> str:
    """``text`` with every span that scores MASKED, or overlaps one, replaced by [KIND]; overlapping spans are masked as one,
    of the kind of the first."""
    out, at = [], 0
    for span in scored(text):
        if span["score"] < MASKED and span["start"] >= at:
            continue
        if span["start"] >= at:
            out += [text[at:span["start"]], f"[{span['kind'].upper()}]"]
        at = max(at, span["end"])
    return "".join([*out, text[at:]])


def mask_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the spans of ``text`` masked; null texts stay null, all other columns as they are."""
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            masked = pa.array([None if t is None else mask(t) for t in batch.column(at).to_pylist()], type=batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(
                [masked if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


@register("op10_pii")
def op10_pii(spark, folder):
    found = pii_spans(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [
        F.size(F.filter("spans", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")  # noqa: B023
        for kind in BASE_KINDS
    ]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))
