"""WARC archives: pages written as segmented records with chunked transfer coding, and read back whole.

Writing: a payload that another page already carries becomes a revisit record. A response's block is its HTTP head and the
payload in chunked transfer coding; a block over the segment size is split into a first record and continuation records,
which may lie in other archives. Spark's text sink writes the files; its line separator ends each record.

Reading: archives are split into records; segments are grouped by the identifier of their first record and put in order of
their segment numbers, the total length is verified, and chunk framing is taken off. A record whose segments are not all
there, or whose length, framing or digest does not agree, comes back with `problem` set and without payload.

Archives are closed after so many records, so that one fits a task; records are written where their page was read.

A null or empty html is an empty payload. Pages without an id are always responses. A page that is there several times is
written and comes back as often. Columns beyond page_id, url and html are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidekeep.session import scratch_path

from .common import small_batches, stored

LEAST_SHARED = 1000
SEGMENT = 16 << 10
CHUNK = 4 << 10
# Records of an archive, which bounds its bytes: a record is a segment and its head.
ARCHIVE_RECORDS = 1500
# Revisits sent to every executor at most; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 18
_END = b"\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, html and refers_to: the page whose record carries the same payload, null for responses."""
    own = pages.select(
        F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    own = own.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    slim = own.select("page_id", "digest", F.octet_length("html").alias("size")).where(F.col("size") >= least)
    last = slim.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    revisits = slim.join(last, ["digest", "size"]).where("page_id < refers_to")
    revisits = stored(revisits.select("page_id", "digest", "refers_to").distinct(), "revisits")
    if revisits.count() <= BROADCAST_ROWS:
        revisits = F.broadcast(revisits)
    return own.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(head: dict[str, object], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in head.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def _clean(url: str) -> str:
    return "".join(c for c in url if c.isprintable()).strip() or "about:blank"


def records(page_id, url: str, html: str, refers_to, segment: int = SEGMENT) -> list[tuple[str, int, bytes]]:
    """The records of one page: identifier of the first, segment number, bytes."""
    payload = html.encode()
    name = "none" if page_id is None else page_id
    own = f"<urn:page:{name}:{hashlib.sha1(url.encode() + b' ' + payload).hexdigest()}>"
    common = {"WARC-Date": _DATE, "WARC-Target-URI": _clean(url), "WARC-Payload-Digest": _digest(payload)}
    kind = {"Content-Type": "application/http;msgtype=response"}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        more = {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
        return [(own, 1, _record({"WARC-Type": "revisit", "WARC-Record-ID": own} | common | more | kind, head))]
    block = head + chunked(payload)
    first = {"WARC-Type": "response", "WARC-Record-ID": own} | common
    if len(block) <= segment:
        return [(own, 1, _record(first | kind, block))]
    out = [(own, 1, _record(first | {"WARC-Segment-Number": 1} | kind, block[:segment]))]
    for k, at in enumerate(range(segment, len(block), segment), 2):
        more = {"WARC-Type": "continuation", "WARC-Record-ID": f"{own[:-1]}:{k}>", "WARC-Date": _DATE}
        more |= {"WARC-Segment-Origin-ID": own, "WARC-Segment-Number": k}
        if at + segment >= len(block):
            more["WARC-Segment-Total-Length"] = len(block)
        out.append((own, k, _record(more, block[at : at + segment])))
    return out


def write(pages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Archives of the pages under the path."""
    small_batches(pages.sparkSession)

    def run(batches):
        for batch in batches:
            blocks = []
            for r in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                blocks += [record for _, _, record in records(*r, segment)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["record"])

    made = plan_records(pages).mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    made.write.option("lineSep", _END.decode()).option("maxRecordsPerFile", ARCHIVE_RECORDS).option(
        "compression", "gzip"
    ).text(path)


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Head fields, in lower case, and block of each record of an archive."""
    out, at = [], 0
    while at < len(data):
        if data.startswith(b"\r\n", at):
            at += 2
            continue
        stop = data.find(_END, at)
        if stop < 0:
            break
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = head.get("content-length", "")
        size = int(size) if size.isdigit() else 0
        out.append((head, data[stop + 4 : stop + 4 + size]))
        at = stop + 4 + size
    return out


def unchunked(data: bytes) -> bytes | None:
    """The payload of chunk framing; None if the framing is broken."""
    out, at = [], 0
    while True:
        stop = data.find(b"\r\n", at)
        try:
            size = int(data[at:stop].split(b";")[0], 16) if stop >= 0 else -1
        except ValueError:
            return None
        if size < 0 or len(data) < stop + 4 + size or data[stop + 2 + size : stop + 4 + size] != b"\r\n":
            return None
        if not size:
            return b"".join(out)
        out.append(data[stop + 2 : stop + 2 + size])
        at = stop + 4 + size


def _payload(block: bytes) -> bytes | None:
    head, gap, body = block.partition(_END)
    if not gap:
        return None
    coded = any(
        k.strip().lower() == b"transfer-encoding" and b"chunked" in v.lower()
        for k, _, v in (x.partition(b":") for x in head.split(b"\r\n"))
    )
    return unchunked(body) if coded else body


_RECORD = "origin string, kind string, url string, digest string, refers_to string, segment int, total long, block binary"


def _records(spark: SparkSession, path: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows = []
                for head, block in parse(gzip.decompress(content) if name.endswith(".gz") else content):
                    number, total = head.get("warc-segment-number"), head.get("warc-segment-total-length")
                    origin = head.get("warc-segment-origin-id") or head.get("warc-record-id")
                    rows.append(
                        {
                            "origin": origin, "kind": head.get("warc-type"), "url": head.get("warc-target-uri"),
                            "digest": head.get("warc-payload-digest"), "refers_to": head.get("warc-refers-to"),
                            "segment": int(number) if number else None, "total": int(total) if total else None,
                            "block": block,
                        }
                    )
                for k in range(0, len(rows), 200):
                    yield pa.RecordBatch.from_pylist(rows[k : k + 200], _ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, _RECORD)


_ARROW = pa.schema(
    [
        ("origin", pa.string()), ("kind", pa.string()), ("url", pa.string()), ("digest", pa.string()),
        ("refers_to", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()),
    ]
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """record_id, kind, url, refers_to, digest (hex), payload and problem of the response and revisit records of archives."""
    small_batches(spark)
    found = _records(spark, path)
    whole = found.where("segment is null and kind in ('response', 'revisit')")
    whole = whole.select("origin", "kind", "url", "digest", "refers_to", F.array(F.struct("segment", "total", "block")).alias("s"))
    parts = found.where("segment is not null").groupBy("origin")
    parts = parts.agg(
        F.max(F.when(F.col("segment") == 1, F.col("kind"))).alias("kind"),
        F.max("url").alias("url"),
        F.max("digest").alias("digest"),
        F.max("refers_to").alias("refers_to"),
        F.collect_list(F.struct("segment", "total", "block")).alias("s"),
    )

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                numbered, copies, problem, payload = {}, 0, None, None
                for s in r["s"]:
                    numbered[s["segment"] or 1] = s
                    copies += (s["segment"] or 1) == 1
                blocks = [numbered[k] for k in sorted(numbered)]
                block = b"".join(s["block"] for s in blocks)
                total = next((s["total"] for s in blocks if s["total"] is not None), None)
                if sorted(numbered) != list(range(1, len(numbered) + 1)):
                    problem = "a segment is missing"
                elif total != (len(block) if blocks[0]["segment"] else None):
                    problem = "the total length differs"
                elif r["kind"] == "response":
                    payload = _payload(block)
                    if payload is None:
                        problem = "the framing is broken"
                    elif r["digest"] and r["digest"] != _digest(payload):
                        problem, payload = "the digest differs", None
                digest = base64.b32decode(r["digest"].partition(":")[2]).hex() if r["digest"] else None
                row = {"record_id": r["origin"], "kind": r["kind"], "url": r["url"], "refers_to": r["refers_to"]}
                rows += [row | {"digest": digest, "payload": payload, "problem": problem}] * max(1, copies)
            yield pa.RecordBatch.from_pylist(rows, _OUT)

    schema = "record_id string, kind string, url string, refers_to string, digest string, payload binary, problem string"
    return whole.unionByName(parts).mapInArrow(run, schema)


_OUT = pa.schema(
    [
        ("record_id", pa.string()), ("kind", pa.string()), ("url", pa.string()), ("refers_to", pa.string()),
        ("digest", pa.string()), ("payload", pa.binary()), ("problem", pa.string()),
    ]
)


def round_trip(pages: DataFrame) -> DataFrame:
    """The pages written as archives in the shared folder and read back, a row per page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path)
    page = F.expr("try_cast(split(record_id, ':')[2] AS long)")
    target = F.expr("try_cast(trim(TRAILING '>' FROM split(refers_to, ':')[2]) AS long)")
    back = stored(read(spark, path).select(
        page.alias("page_id"), F.octet_length("payload").cast("long").alias("size"), "digest", "kind", "problem",
        target.alias("refers_to"),
    ), "pages-read")
    sizes = back.where("kind = 'response'").groupBy(F.col("page_id").alias("refers_to"), "digest")
    sizes = sizes.agg(F.max("size").alias("shared"))
    return back.join(sizes, ["refers_to", "digest"], "left").select(
        "page_id",
        F.coalesce("size", "shared").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
        "problem",
    )
