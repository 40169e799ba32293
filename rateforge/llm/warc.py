"""WARC archives: writing captures, reading records, assembling transactions.

A capture is three records: a request, a response (or a revisit, when another
capture holds the same payload) and a metadata record. The request and the
metadata name the response in ``WARC-Concurrent-To``. ``assemble`` joins the
three through these identifiers into one nested row per capture.

Archives are gzip files written by Spark's text writer with the record
separator as line separator, so any file system and the usual commit protocol
serve. They are read as a stream, one task a file: ``Content-Length`` says how
many of the pieces between separators make up a block, so a payload may hold
the separator itself, and memory is bounded by the largest record. Plain
(splittable) files are refused when a split begins inside one.

Equal payloads of ``MIN_REVISIT`` bytes or more are stored once, with the
largest ``page_id``; the others become revisit records without a block. The
payload's digest and length stand in the headers of both.

Defined cases: a null html is an empty payload; a null url gives no target
header, line breaks in a url are percent-encoded; a page with a null
``page_id`` is a response unless an equal payload has an id; repeated rows
write equal records, and each response or revisit record is a capture; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import materialize

MIN_REVISIT = 1000
SEPARATOR = "\r\n\r\n"
#: A fixed capture date: the tables hold none.
DATE = "2000-01-01T00:00:00Z"


def _record_id(kind: str, page: Column, digest: Column) -> Column:
    """A name-based urn of a record, equal for equal pages."""
    h = F.md5(F.concat_ws(" ", F.lit(kind), F.coalesce(page.cast("string"), F.lit("-")), digest))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str, headers: dict[str, Column | None], block: Column) -> Column:
    """One record's text; a null header is left out."""
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers.items()]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(SEPARATOR), block)


def capture_records(pages: DataFrame) -> DataFrame:
    """(value): the WARC records of ``pages`` (page_id, url, html), three a page."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    bare = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.col("url").cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
        html.alias("html"),
    )
    page = bare.withColumn("digest", F.sha1(F.col("html")))
    # The ids that stand for payloads of two pages or more: one narrow row a digest.
    shared = (
        page.where(F.octet_length("html") >= MIN_REVISIT)
        .groupBy(F.col("digest").alias("shared_digest"))
        .agg(F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    page = page.join(materialize(shared, "shared-payloads"), F.col("digest") == F.col("shared_digest"), "left")
    revisits = F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id"))
    main_id = F.when(revisits, _record_id("revisit", F.col("page_id"), F.col("digest"))).otherwise(
        _record_id("response", F.col("page_id"), F.col("digest"))
    )
    host = F.coalesce(F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1), F.lit(""))
    path = F.regexp_replace("url", r"^[a-z]+://[^/?#]*", "")
    path = F.when(F.length(path) > 0, path).otherwise(F.lit("/"))
    payload = {
        "WARC-Record-ID": main_id,
        "WARC-Target-URI": F.col("url"),
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")),
        "X-Payload-Length": F.octet_length("html").cast("string"),
    }
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + SEPARATOR)
    response = _record("response", payload, F.concat(head, F.col("html")))
    revisit = _record(
        "revisit",
        payload
        | {
            "WARC-Refers-To": _record_id("response", F.col("kept_id"), F.col("digest")),
            "WARC-Profile": F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        },
        head,
    )
    request = _record(
        "request",
        {"WARC-Record-ID": _record_id("request", F.col("page_id"), F.col("digest")), "WARC-Concurrent-To": main_id, "WARC-Target-URI": F.col("url")},
        F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(SEPARATOR)),
    )
    metadata = _record(
        "metadata",
        {"WARC-Record-ID": _record_id("metadata", F.col("page_id"), F.col("digest")), "WARC-Concurrent-To": main_id, "Content-Type": F.lit("application/warc-fields")},
        F.when(F.col("page_id").isNull(), F.lit("")).otherwise(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n"))),
    )
    return page.select(F.explode(F.array(request, F.when(revisits, revisit).otherwise(response), metadata)).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the captures of ``pages`` as gzip WARC files under ``path``."""
    capture_records(pages).write.option("lineSep", SEPARATOR).option("compression", "gzip").text(path)


_RECORDS = pa.schema(
    [("file", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("http", pa.string()), ("payload", pa.binary())]
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the pieces between separators, put together again per file.

    A record's header ends at the first separator; its Content-Length says how
    many bytes of the stream are its block, whatever separators they hold.
    """
    separator = SEPARATOR.encode()
    file, headers, wanted, kept = None, None, 0, bytearray()
    rows: list[tuple] = []
    size = 0

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _RECORDS)], schema=_RECORDS)

    def ended() -> None:
        if headers is not None or kept.strip():
            raise ValueError(f"a record is cut short: {file}")

    for batch in batches:
        for path, start, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if path != file:
                ended()
                kept.clear()
                if start:
                    raise ValueError(f"a plain archive was split, gzip it: {path}")
                file = path
            kept += piece
            kept += separator
            if headers is None:
                del kept[: len(kept) - len(kept.lstrip(b"\r\n"))]  # line breaks between records
                if not kept:
                    continue
                end = kept.index(separator)
                first, *lines = kept[:end].decode("utf-8", "replace").split("\r\n")
                if not first.startswith("WARC/"):
                    raise ValueError(f"not a record: {first[:40]!r} in {path}")
                del kept[: end + len(separator)]
                pairs = [line.partition(":") for line in lines]
                headers = {name.strip().lower(): value.strip() for name, _, value in pairs}
                wanted = int(headers["content-length"])
            # A block that ends in line breaks runs into the separator.
            if len(kept) >= wanted + len(separator) or (wanted == 0 and not kept):
                block = bytes(kept[:wanted])
                http, payload = None, block
                if headers.get("warc-type") in ("request", "response", "revisit") and separator in block:
                    head, _, payload = block.partition(separator)  # the message's head; its body is the payload
                    http = head.decode("utf-8", "replace")
                rows.append((file, list(headers.items()), http, payload))
                size += wanted + 500
                headers = None
                del kept[:wanted]
                if size > 4 << 20:
                    yield batch_of()
                    rows, size = [], 0
    ended()
    if rows:
        yield batch_of()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, headers, http, payload): the records of the archives under ``path``.

    Header names are lower case; http is the head of a request or response and
    payload what follows it, or the whole block of other records.
    """
    pieces = spark.read.option("lineSep", SEPARATOR).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("piece"),
    )
    return pieces.mapInArrow(_parse, "file string, headers map<string,string>, http string, payload binary")


def assemble(records: DataFrame) -> DataFrame:
    """One row per response or revisit record: capture_id, type, response, request, metadata (structs).

    A record belongs to the capture that its concurrent-to header names, or to
    its own: archives in which the response names the request work as well. Of
    several requests (or metadata records) of a capture the first by id stays.
    """
    header = F.col("headers")
    r = records.select(
        header["warc-type"].alias("type"),
        F.coalesce(header["warc-concurrent-to"], header["warc-record-id"]).alias("capture_id"),
        F.struct(header["warc-record-id"].alias("id"), header.alias("headers"), "http", "payload").alias("record"),
    )

    def side(kind: str) -> DataFrame:
        own = r.where(F.col("type") == kind)
        return own.groupBy(F.col("capture_id").alias(f"_{kind}")).agg(F.min_by("record", "record.id").alias(kind))

    main = r.where(F.col("type").isin("response", "revisit")).withColumnRenamed("record", "response")
    return (
        main.join(side("request"), F.col("capture_id") == F.col("_request"), "left")
        .join(side("metadata"), F.col("capture_id") == F.col("_metadata"), "left")
        .select("capture_id", "type", "response", "request", "metadata")
    )


def page_digests(captures: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of assembled captures."""
    headers = F.col("response.headers")
    fields = F.col("metadata.payload").cast("string")
    own = F.col("type") == "response"  # a revisit has its payload's figures in its headers
    rows = captures.select(
        F.when(fields.contains("page-id:"), F.regexp_extract(fields, r"page-id: (-?\d+)", 1).cast("long")).alias("page_id"),
        F.when(own, F.octet_length("response.payload")).otherwise(headers["x-payload-length"].cast("long")).cast("long").alias("payload_bytes"),
        F.when(own, F.sha1("response.payload")).otherwise(F.substring(headers["warc-payload-digest"], 6, 40)).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("response.id").alias("id"),
        headers["warc-refers-to"].alias("refers_id"),
    )
    rows = materialize(rows, "captures")
    kept = rows.where("record_type = 'response'").groupBy(F.col("id").alias("kept")).agg(F.max("page_id").alias("refers_to"))
    wanted = rows.where("refers_id is not null").select("refers_id").distinct()
    kept = materialize(kept.join(wanted, F.col("kept") == F.col("refers_id"), "left_semi"), "referred-captures")
    return rows.join(kept, F.col("refers_id") == F.col("kept"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
