"""WARC archives: write request, response and metadata records, read them back, join captures."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from .common import arrow_map, broadcast_if, register, remove, shared_folder, table

MIN_REVISIT_BYTES = 100
#: A record ends with two line breaks, so this separator between rows makes a text file an archive.
RECORD_END = "\r\n\r\n"
PAGES_PER_ARCHIVE = 2000
DIGESTS_TO_BROADCAST = 500_000

RECORDS = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
    "digest string, payload_bytes bigint, fields map<string,string>"
)


def _urn(*parts) -> Column:
    h = F.sha2(F.concat_ws("|", *parts), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _record(kind: str, headers: list, body) -> Column:
    lines = [F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines += [F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), body)  # concat_ws leaves out null headers


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write one request, one response or revisit, and one metadata record per row of ``pages``.

    Payload: the html in UTF-8 (null: empty). Among equal payloads of at least MIN_REVISIT_BYTES
    the smallest key is the response and the others are revisits without a payload; a null key
    sorts last and is never referred to unless all are null. Repeated rows are captures of their
    own. A null url gives no target header; control characters in a url are percent-encoded.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(key).cast("string").alias("k"), F.col(key).alias("key_value"), F.col(url).alias("url"), body.alias("payload"),
        F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("n"),
        F.monotonically_increasing_id().alias("seq"),
    )
    first = (
        rows.filter(F.col("n") >= MIN_REVISIT_BYTES).groupBy("digest")
        .agg(F.min(F.struct(F.col("key_value").isNull(), "key_value", "seq")).alias("head"), F.count("*").alias("copies"))
        .filter("copies > 1").select(F.col("digest").alias("d"), F.col("head.key_value").cast("string").alias("head_key"),
                                     F.col("head.seq").alias("head_seq"))
    )
    repeated = broadcast_if(cut_lineage(first), DIGESTS_TO_BROADCAST)
    named = rows.join(repeated, F.col("digest") == F.col("d"), "left").withColumn(
        "revisit", F.coalesce(F.col("seq") != F.col("head_seq"), F.lit(False)))
    urn = lambda kind, seq="seq": _urn(F.lit(kind), F.col(seq).cast("string"))
    target = ("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"))
    date = ("WARC-Date", F.lit("1970-01-01T00:00:00Z"))
    request = _record("request", [
        ("WARC-Record-ID", urn("request")), date, target, ("WARC-Concurrent-To", urn("response")),
        ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(target[1], F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")))
    response = _record(F.when(F.col("revisit"), "revisit").otherwise("response"), [
        ("WARC-Record-ID", urn("response")), date, target,
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(F.col("revisit"), urn("response", "head_seq"))),
        ("Content-Type", F.lit("text/html; charset=utf-8"))],
        F.when(F.col("revisit"), "").otherwise(F.col("payload")))
    metadata = _record("metadata", [
        ("WARC-Record-ID", urn("metadata")), date, target, ("WARC-Concurrent-To", urn("response")),
        ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.when(F.col("k").isNotNull(), F.concat(F.lit("page-id: "), F.col("k"), F.lit("\r\n"))).otherwise(""),
                 F.lit("payload-bytes: "), F.col("n").cast("string"), F.lit("\r\n")))
    named.select(F.concat_ws(RECORD_END, request, response, metadata).alias("value")).write.option(
        "lineSep", RECORD_END).option("maxRecordsPerFile", PAGES_PER_ARCHIVE).text(path)


def _parse(data: bytes):
    """Records of one archive; lengths in headers rule, so a payload may hold anything."""
    at, view = 0, memoryview(data)
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(head["Content-Length"])
        yield head, view[start:stop]
        at = stop + len(RECORD_END)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``, one row each (columns RECORDS).

    ``digest`` and ``payload_bytes`` are taken from the stored payload; a response whose payload
    does not fit its digest header fails the job. Revisits carry the digest of their header.
    """
    def rows(batch):
        for content in batch.column(0):
            out = {c.split()[0]: [] for c in RECORDS.replace("map<string,string>", "map").split(", ")}
            for head, payload in _parse(content.as_py()):
                kind = head["WARC-Type"]
                stated = head.get("WARC-Payload-Digest", "").removeprefix("sha256:") or None
                if kind == "response" and hashlib.sha256(payload).hexdigest() != stated:
                    raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
                fields = None
                if kind == "metadata":
                    fields = [tuple(x.split(": ", 1)) for x in bytes(payload).decode().split("\r\n") if x]
                out["type"].append(kind)
                out["record_id"].append(head["WARC-Record-ID"])
                out["concurrent_to"].append(head.get("WARC-Concurrent-To"))
                out["refers_to"].append(head.get("WARC-Refers-To"))
                out["target_uri"].append(head.get("WARC-Target-URI"))
                out["digest"].append(stated)
                out["payload_bytes"].append(len(payload))
                out["fields"].append(fields)
            yield out

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return arrow_map(files, RECORDS, rows)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``request``, ``response`` (or revisit) and ``metadata`` records
    joined by their concurrent-to identifiers, and ``original_page``, the page a revisit refers to.

    A capture without a request or metadata record keeps null there. Identifiers are unique; only
    the last join has a key on many rows (a response with many revisits), on its left side, where
    AQE splits it.
    """
    part = lambda kind, *types: records.filter(F.col("type").isin(*types)).select(
        F.struct("type", "record_id", "refers_to", "target_uri", "digest", "payload_bytes", "fields").alias(kind),
        F.col("record_id" if kind == "response" else "concurrent_to").alias(f"{kind}_of"))
    joined = (
        part("response", "response", "revisit")
        .join(part("request", "request"), F.col("response_of") == F.col("request_of"), "left")
        .join(part("metadata", "metadata"), F.col("response_of") == F.col("metadata_of"), "left")
        .select("request", "response", "metadata")
    )
    original = records.filter("type = 'metadata'").select(
        F.col("concurrent_to").alias("of"), F.col("fields")["page-id"].alias("original_page"))
    revisits = joined.filter("response.type = 'revisit'").join(original, F.col("response.refers_to") == F.col("of"), "left").drop("of")
    responses = joined.filter("response.type = 'response'").withColumn("original_page", F.lit(None).cast("string"))
    return responses.unionByName(revisits)


@register("op8_warc", sql=f"""
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND head <> page_id THEN head END AS refers_to
FROM g
""")
def op8_warc(spark, folder):
    path = shared_folder(spark, "warc")
    write_archives(table(spark, folder, "pages"), path)
    records = cut_lineage(read_archives(spark, path))
    remove(spark, path)
    fields = F.col("metadata.fields")
    return captures(records).select(
        fields["page-id"].cast("long").alias("page_id"), fields["payload-bytes"].cast("long").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        F.col("original_page").cast("long").alias("refers_to"))
