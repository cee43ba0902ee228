"""WARC archives: writing, reading, and assembly of whole transactions.

Writing: every page becomes three records of one transaction: a response (or a revisit of an
earlier identical payload), the request and a metadata record, the latter two naming the
first in ``WARC-Concurrent-To``. Spark's text writer lays them down with the WARC record
separator, gzip-compressed.

Reading: Spark's text reader cuts the files at the version line, so that no file is ever
held whole. The version line can't occur inside a block that this module writes: a payload
that contains it is sent with ``Transfer-Encoding: chunked``, cut inside the word. Nor in a
header: a target URI that ends in the version word has a space behind it, which belongs to the
line's layout, not to its value, so that readers drop it. A piece whose ``Content-Length`` doesn't fit its block is marked ``complete = false``.

Assembly: request and metadata records are joined to their response through the
concurrent-to identifier, revisits to the response they refer to; one nested row a capture.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from distillery.llm.common import stored

VERSION = "WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("warc_type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
           "date string, header_digest string, complete boolean, payload_bytes long, payload_digest string, "
           "fields map<string,string>, payload binary")


def _urn(kind: str, page_id: str = "page_id") -> Column:
    """A record id made from a page's id and payload, so that a recomputed task repeats it."""
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(F.col(page_id).cast("string"), F.lit("-")), "sha"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def _record(kind: Column | str, record_id: Column, fields: dict[str, Column], content_type: str, block: Column) -> Column:
    """One record without the separator behind it; a field that is null is left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")) for k, v in (
        {"WARC-Type": kind, "WARC-Record-ID": record_id} | fields | {
            "Content-Type": F.lit(content_type), "Content-Length": F.octet_length(block).cast("string")}).items()]
    return F.concat(F.lit(VERSION), *[F.coalesce(x, F.lit("")) for x in lines], F.lit("\r\n"), block)


def write_warc(pages: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z", revisit_bytes: int = 1000) -> None:
    """Write the transactions of ``pages`` (``page_id, url, html``) as WARC files under ``path``.

    Of pages with equal payloads of at least ``revisit_bytes`` that with the largest page_id
    is the response (all rows that tie for it), the others revisit it; a null page_id ranks
    lowest. A null html is an empty payload, a null url leaves the target out. An empty table
    gives an empty archive. Other columns aren't read.
    """
    rows = pages.select("page_id", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("uri"),
                        F.coalesce("html", F.lit("")).alias("body")).withColumn("sha", F.sha2("body", 256))
    # partial aggregation first; stored, so that the join below has a plain exchange on both
    # sides and adaptive execution can split a payload that a third of the pages share
    last = stored(rows.filter(F.octet_length("body") >= revisit_bytes).groupBy("sha").agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    rows = rows.join(last, "sha", "left")
    revisit = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    chunked = F.col("body").contains(VERSION.strip())
    framed = F.concat(F.concat_ws("", F.transform(
        F.split("body", r"(?<=WARC/)(?=1\.1)"),
        lambda x: F.concat(F.hex(F.octet_length(x).cast("long")), F.lit("\r\n"), x, F.lit("\r\n")))), F.lit("0\r\n\r\n"))
    length = F.when(chunked, F.lit("Transfer-Encoding: chunked")).otherwise(
        F.concat(F.lit("Content-Length: "), F.octet_length("body").cast("string")))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"), length, F.lit("\r\n\r\n"))
    block = F.concat(head, F.when(revisit, F.lit("")).when(chunked, framed).otherwise(F.col("body")))
    apart = F.when(F.col("uri").endswith(VERSION.strip()), F.lit(" ")).otherwise(F.lit(""))
    own, uri, when = _urn("capture"), {"WARC-Target-URI": F.concat("uri", apart)}, {"WARC-Date": F.lit(date)}
    target = F.when(revisit, _urn("capture", "last"))
    records = [
        _record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), own, when | uri | {
            "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.sha1("body")),
            "WARC-Profile": F.when(revisit, F.lit(REVISIT_PROFILE)), "WARC-Refers-To": target},
            "application/http; msgtype=response", block),
        _record("request", _urn("request"), when | uri | {"WARC-Concurrent-To": own},
                "application/http; msgtype=request",
                F.concat(F.lit("GET "), F.coalesce("uri", F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n"))),
        _record("metadata", _urn("metadata"), when | uri | {"WARC-Concurrent-To": own}, "application/warc-fields",
                F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))),
    ]
    (rows.select(F.explode(F.array(*records)).alias("value")).write.option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").text(path))


def _unchunked(data: bytes) -> bytes | None:
    """The body of a chunked message; None if its framing is broken."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        try:
            size = int(data[at:end].split(b";")[0], 16) if end > 0 else -1
        except ValueError:
            return None
        if size < 0 or end + 2 + size > len(data):
            return None
        if not size:
            return b"".join(out)
        out.append(data[end + 2:end + 2 + size])
        at = end + 4 + size


def parse_record(piece: bytes) -> dict | None:
    """What stands between two version lines, as a row of ``RECORDS``; None before the first."""
    head, found, rest = piece.partition(b"\r\n\r\n")
    if not found:
        return None
    named = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        k, _, v = line.partition(":")
        named[k.strip().lower()] = v.strip()
    size = named.get("content-length", "")
    size = int(size) if re.fullmatch(r"\d+", size) else -1
    block, behind = rest[:max(size, 0)], rest[max(size, 0):]
    complete = 0 <= size <= len(rest) and not behind.strip(b"\r\n")
    kind, payload, fields = named.get("warc-type"), None, {}
    if kind == "response":
        http, _, payload = block.partition(b"\r\n\r\n")
        if re.search(rb"(?im)^transfer-encoding:\s*chunked", http):
            body = _unchunked(payload)
            complete, payload = complete and body is not None, body
    elif kind == "metadata":
        for line in block.decode("utf-8", "replace").split("\r\n"):
            k, mark, v = line.partition(":")
            if mark:
                fields[k.strip()] = v.strip()
    return {"warc_type": kind, "record_id": named.get("warc-record-id"), "concurrent_to": named.get("warc-concurrent-to"),
            "refers_to": named.get("warc-refers-to"), "target_uri": named.get("warc-target-uri"),
            "date": named.get("warc-date"), "header_digest": named.get("warc-payload-digest"), "complete": complete,
            "payload_bytes": None if payload is None else len(payload),
            "payload_digest": None if payload is None else hashlib.sha1(payload).hexdigest(),
            "fields": list(fields.items()), "payload": payload}


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives under ``path``, a row each (columns ``RECORDS``); without
    ``payload`` that column is null, its size and digest are there all the same."""
    schema = pa.schema([
        *[(x, pa.string()) for x in ("warc_type", "record_id", "concurrent_to", "refers_to", "target_uri", "date",
                                     "header_digest")], ("complete", pa.bool_()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                rows = [x for v in batch.column(0).slice(start, 512).to_pylist() if (x := parse_record(v))]
                for x in rows if not payload else []:
                    x["payload"] = None
                yield pa.RecordBatch.from_pylist(rows, schema)

    pieces = spark.read.option("lineSep", VERSION).text(path).select(F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(parse, RECORDS)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row a capture (response or revisit record): ``record_id, record_type,
    page_id, payload_bytes, payload_digest, refers_to_id, refers_to, response, request,
    metadata``. ``records`` should be stored, as it is read by several branches.

    A revisit's payload facts are those of the response it refers to, null if that is not in
    the archives. Captures without a request or metadata have null there; of several, that
    with the smallest record id is taken. Request and metadata records without a capture are
    left out. Repeated capture records give a row each.
    """
    def beside(kind: str, *columns: str) -> DataFrame:
        best = F.min_by(F.struct("record_id", "date", *columns), F.col("record_id"))
        return records.filter(F.col("warc_type") == kind).groupBy(F.col("concurrent_to").alias("own")).agg(
            best.alias(kind))

    captures = records.filter(F.col("warc_type").isin("response", "revisit"))
    rows = captures.withColumnRenamed("record_id", "own").join(beside("request", "target_uri"), "own", "left").join(
        beside("metadata", "fields"), "own", "left").withColumn(
        "page_id", F.element_at("metadata.fields", "page-id").cast("long"))
    rows = stored(rows)
    # a third of the captures may revisit one response: both sides are plain scans, so that
    # adaptive execution can split that key; a response looks itself up
    first = stored(rows.filter(F.col("warc_type") == "response").groupBy(F.col("own").alias("target")).agg(
        F.min("page_id").alias("t_page"), F.min("payload_bytes").alias("t_bytes"),
        F.min("payload_digest").alias("t_digest")))
    revisit = F.col("warc_type") == "revisit"
    return rows.withColumn("target", F.when(revisit, F.col("refers_to")).otherwise(F.col("own"))).join(
        first, "target", "left").select(
        F.col("own").alias("record_id"), F.col("warc_type").alias("record_type"), "page_id",
        F.when(revisit, F.col("t_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("t_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.when(revisit, F.col("refers_to")).alias("refers_to_id"), F.when(revisit, F.col("t_page")).alias("refers_to"),
        F.struct("target_uri", "date", "header_digest", "complete", "payload").alias("response"), "request", "metadata")
