"""WARC archives of pages, and captures assembled from their records.

Writing.  Every page is a transaction of three records: the request, the response (or a revisit of the record that
holds the same payload) and metadata with the page's id and exact address as JSON.  Response and metadata name the
request in WARC-Concurrent-To.  Of the pages with equal payloads (SHA-256) of `LEAST` bytes or more, the one with the
largest id is written as response; the others are revisits that refer to it.  Of pages that repeat id and payload,
one is.  Records are rows, and two line ends part them, so Spark's text writer writes the archives, in files of about
`file_bytes` before compression; it can write to any store.

Reading.  Files (plain, or gzip with any number of members) are cut at Content-Length, so payloads may hold anything,
record headers included.  Length and SHA-1 of a payload are taken from its bytes and must agree with its header.

Assembly.  WARC-Concurrent-To links records in either direction.  A record belongs to the response or revisit that it is
linked with, directly or through one other record; a record without one is a capture of its own.  Each capture is one
nested row.  Only rows of identifiers are joined; no group is larger than the records of one capture.

A null payload is empty, a null address gives no target, a null id none; an address's blanks and control characters are
%20 in headers (the metadata keep it as it is).  Tables without rows give archives without records.  Columns beyond id,
address and payload are not written.
"""

from __future__ import annotations

import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm.common import cut, shuffles_end

LEAST = 1000
FILE_BYTES = 32 << 20
#: Bytes of records in a batch on the way from Python, about.
BATCH = 8 << 20
# Fixed values of the format.
VERSION, LINE, END = "WARC/1.1", "\r\n", "\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ANCHORS = ("response", "revisit")


def _record(kind: str | Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """Text of one record without the two line ends behind it; headers that are null are left out."""
    lines = [F.lit(VERSION), F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines += [F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(LINE, *lines), F.lit(END), block)


def _urn(hex32: Column) -> Column:
    parts = [F.substring(hex32, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html", date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES
) -> None:
    """Write the pages' records to a folder; date: the time of capture."""
    rows = pages.select(F.col(id).alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumns({"same": F.unhex(F.sha2("payload", 256)), "key": F.coalesce(F.col("id").cast("string"), F.lit("none"))})
    size = F.octet_length("payload")
    keys = cut(rows.groupBy("key", "id", "same").agg(F.count("*").alias("n"), F.max(size).alias("bytes")))  # a narrow row a page
    total = keys.agg(F.sum(F.col("n") * F.col("bytes"))).first()[0] or 0  # one row
    groups = keys.where(F.col("bytes") >= LEAST).groupBy("same").agg(F.max("id").alias("first_id"), F.sum("n").alias("n")).where("n > 1").drop("n")
    # adaptive execution splits the keys of a payload with very many copies
    shared = cut(keys.select("key", "same").join(groups, "same").withColumn("shared", F.lit(True)))
    # the pages move once, by id and payload, to files of even size
    dealt = rows.repartition(max(1, -(-total // file_bytes)), "key", "same").join(shared, ["key", "same"], "left")
    repeat = F.row_number().over(Window.partitionBy("key", "same").orderBy("key"))
    first = F.coalesce("shared", F.lit(False)) & F.col("id").eqNullSafe(F.col("first_id"))
    dealt = dealt.withColumn("response", F.col("shared").isNull() | (first & (repeat == 1)))

    named = lambda id: _urn(F.md5(F.concat_ws(" ", F.lit("response"), F.hex("same"), id.cast("string"))))
    part = lambda kind: _urn(F.md5(F.concat_ws(" ", F.lit(kind), "_capture")))
    dealt = dealt.withColumn("_capture", F.uuid()).withColumn("_request", part("request"))
    own = F.when(F.col("response") & F.col("shared"), named(F.col("id"))).otherwise(part("response"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    host, rest = F.regexp_extract(target, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.regexp_extract(target, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    request = F.concat(F.lit("GET "), F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)), F.lit(f" HTTP/1.1{LINE}Host: "), host, F.lit(END))
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=UTF-8{LINE}Content-Length: "), size.cast("string"), F.lit(END))
    common = lambda record_id: [("WARC-Record-ID", record_id), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", target)]
    linked = [("WARC-Concurrent-To", F.col("_request"))]
    revisited = lambda value: F.when(~F.col("response"), value)
    records = [
        _record("request", [*common(F.col("_request")), ("Content-Type", F.lit("application/http;msgtype=request"))], F.coalesce(request, F.lit(END))),
        _record(
            F.when(F.col("response"), F.lit("response")).otherwise(F.lit("revisit")),
            [
                *common(own),
                *linked,
                ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
                ("WARC-Profile", revisited(F.lit(SAME_PAYLOAD))),
                ("WARC-Refers-To", revisited(named(F.col("first_id")))),
                ("Content-Type", F.lit("application/http;msgtype=response")),
            ],
            F.concat(answer, F.when(F.col("response"), F.col("payload")).otherwise(F.lit(""))),
        ),
        _record("metadata", [*common(part("metadata")), *linked, ("Content-Type", F.lit("application/json"))], F.to_json(F.struct(F.col("id").alias(id), F.col("url").alias(url)))),
    ]
    with shuffles_end(pages.sparkSession):
        dealt.select(F.explode(F.array(*records)).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


RECORD = (
    "record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, content_type string, "
    "http_headers string, block string, payload_bytes long, payload_digest string, payload binary"
)


def parsed(data: bytes, where: str, payloads: bool = True):
    """The records of one archive, as tuples of the columns of `RECORD`."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        if head < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError(f"{where}: no WARC record at byte {at}")
        # a line that begins with a blank goes on with the one before
        lines = re.sub(r"\r\n[ \t]+", " ", data[at:head].decode("utf-8", "replace")).split(LINE)[1:]
        headers: dict[str, list[str]] = {}
        for name, _, value in (line.partition(":") for line in lines):
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        one = lambda name: headers.get(name, [None])[0]  # noqa: B023, E731
        begin = head + 4
        end = begin + int(one("content-length") or -1)
        if end < begin or data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"{where}: the record at byte {at} does not end where its Content-Length says")
        at = end + 4
        kind, http, block, size, digest, payload = one("warc-type"), None, None, None, None, None
        if kind in ANCHORS:
            split = data.find(b"\r\n\r\n", begin, end) if (one("content-type") or "").startswith("application/http") else begin - 4
            split = end if split < 0 else split
            http = data[begin : max(split, begin)].decode("utf-8", "replace")
            digest = (one("warc-payload-digest") or "").removeprefix("sha1:") or None
            if kind == "response":
                body = data[min(split + 4, end) : end]
                size, found = len(body), hashlib.sha1(body).hexdigest()
                if digest and len(digest) == 40 and digest.lower() != found:
                    raise ValueError(f"{where}: the payload of {one('warc-record-id')} does not have its digest")
                digest, payload = found, body if payloads else None
        else:
            block = data[begin:end].decode("utf-8", "replace")
        yield (
            one("warc-record-id"), kind, headers.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-target-uri"), one("warc-date"),
            one("content-type"), http, block, size, digest, payload,
        )


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of a folder's archives (`RECORD`); without payloads, their lengths and digests only."""
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 6, pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def records(parts):
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in parts:
            for where, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, held = [], 0
                for row in parsed(content.as_py(), where.as_py(), payloads):
                    rows.append(row)
                    held += 500 + len(row[8] or "") + len(row[11] or b"")
                    if held > BATCH:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(records, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture (id of its response or revisit), response, request, metadata (a list).

    response and request hold the columns of `records`; of several requests of one capture the first by id stands in
    `request`, and all records that are neither are in metadata.
    """
    edges = records.select("record_id", F.explode("concurrent_to").alias("other"))
    edges = edges.unionByName(edges.select(F.col("other").alias("record_id"), F.col("record_id").alias("other"))).distinct()
    anchor = F.col("type").isin(*ANCHORS)
    anchors = records.where(anchor).select(F.col("record_id").alias("capture"))
    others = records.where(~anchor).select("record_id")
    edges = cut(edges.join(others, "record_id"))
    direct = cut(edges.join(anchors, F.col("other") == F.col("capture")).groupBy("record_id").agg(F.min("capture").alias("capture")))
    through = edges.join(direct.withColumnRenamed("record_id", "other"), "other").groupBy("record_id").agg(F.min("capture").alias("capture"))
    member = direct.unionByName(through.join(direct, "record_id", "left_anti"))
    row = F.struct(*records.columns)
    placed = records.join(member, "record_id", "left").select(F.coalesce("capture", "record_id").alias("capture"), row.alias("_row"))
    of = lambda kind: F.col("_row.type").isin(*kind)
    asked = F.min_by(F.when(of(["request"]), F.col("_row")), F.when(of(["request"]), F.col("_row.record_id")))
    rest = F.sort_array(F.collect_list(F.when(~of([*ANCHORS, "request"]), F.col("_row"))))
    return placed.groupBy("capture").agg(F.first(F.when(of(ANCHORS), F.col("_row")), ignorenulls=True).alias("response"), asked.alias("request"), rest.alias("metadata"))


def resolved(rows: DataFrame, id: str = "page_id", id_type: str = "long") -> DataFrame:
    """Narrow rows of captures that `write` has written: id, url, record_type, payload_bytes, payload_digest, refers_to.

    A revisit has length and digest of the response it refers to, and that response's id in refers_to.
    """
    known = F.from_json(F.col("metadata")[0]["block"], f"`{id}` {id_type}, url string")
    own = cut(rows.where("response IS NOT NULL").select("capture", "response.type", "response.refers_to", "response.payload_bytes", "response.payload_digest", known.alias("_known")))
    target = own.where("type = 'response'").select(
        F.col("capture").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"), F.col(f"_known.`{id}`").alias("_id")
    )
    # adaptive execution splits the revisits of one response
    return own.join(target, "refers_to", "left").select(
        F.col(f"_known.`{id}`").alias(id),
        "_known.url",
        F.col("type").alias("record_type"),
        F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("_digest", "payload_digest").alias("payload_digest"),
        F.col("_id").alias("refers_to"),
    )
