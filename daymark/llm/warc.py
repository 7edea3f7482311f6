"""WARC archives by way of a table of record chunks.

Writing: each page becomes rows (record, chunk number, chunk), a payload of more than
`CHUNK` bytes in several rows. A chunk is one WARC record of its own: the first is
the response, those after it are `continuation` records, numbered by the segment
fields of the format, and the last states the total length. The digest of the payload
is carried along from chunk to chunk and stated with the last one. A row is the text of
its record; Spark's text writer ends it with the blank lines that end a WARC record,
so gzipped archives come out of any file system Spark writes to.

Reading: the archives come back as pieces between blank lines, in file order, and a
parser puts the stream together again by Content-Length. It keeps a header and a
running digest, never a whole payload.
"""

from __future__ import annotations

import hashlib
import re
from base64 import b16encode, b32decode, b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 2**20
LEAST_REVISITED = 1000
_END = b"\r\n\r\n"
_DATE = "1970-01-01T00:00:00Z"
_ID = "urn:page:"


def _pieces(payload: bytes, size: int) -> Iterator[bytes]:
    """The payload cut at character boundaries into pieces of at most `size` bytes."""
    at = 0
    while True:
        end = min(at + size, len(payload))
        while end < len(payload) and payload[end] & 0xC0 == 0x80:
            end -= 1
        yield payload[at:end]
        at = end
        if at >= len(payload):
            return


def _digest(sha1) -> str:
    return "sha1:" + b32encode(sha1.digest()).decode()


def _record(kind: str, name: str, block: bytes, fields: list[tuple[str, object]]) -> bytes:
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", _DATE),
        *fields,
        ("WARC-Block-Digest", _digest(hashlib.sha1(block))),
        ("Content-Type", "text/html" if kind != "revisit" else "application/octet-stream"),
        ("Content-Length", len(block)),
    ]
    head = "WARC/1.1\r\n" + "\r\n".join(f"{k}: {v}" for k, v in fields)
    return head.encode() + _END + block


def _target(url: str | None) -> list[tuple[str, object]]:
    return [("WARC-Target-URI", re.sub(r"[\x00-\x20]", "", url))] if url else []


def page_records(
    page: int | None, url: str | None, payload: bytes, refers_to: int | None, chunk: int = CHUNK
) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response with its continuations."""
    name = f"{_ID}{'' if page is None else page}"
    sha1 = hashlib.sha1()
    if refers_to is not None:
        sha1.update(payload)
        yield _record(
            "revisit",
            name,
            b"",
            [
                *_target(url),
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ("WARC-Refers-To", f"<{_ID}{refers_to}>"),
                ("WARC-Payload-Digest", _digest(sha1)),
                ("X-Payload-Length", len(payload)),
            ],
        )
        return
    done = 0
    for number, piece in enumerate(_pieces(payload, chunk), 1):
        sha1.update(piece)
        done += len(piece)
        fields = _target(url)
        if len(payload) > chunk:
            fields.append(("WARC-Segment-Number", number))
        if number > 1:
            fields.append(("WARC-Segment-Origin-ID", f"<{name}>"))
        if done == len(payload):
            fields.append(("WARC-Payload-Digest", _digest(sha1)))
            if number > 1:
                fields.append(("WARC-Segment-Total-Length", done))
        own = name if number == 1 else f"{name}:{number}"
        yield _record("response" if number == 1 else "continuation", own, piece, fields)


class RecordStream:
    """Records of a WARC byte stream: (fields, bytes and SHA-1 of the block)."""

    def __init__(self) -> None:
        self.head, self.fields, self.left, self.skip = bytearray(), None, 0, 0

    def feed(self, data: bytes, sha1) -> Iterator[tuple[dict[str, str], int]]:
        """Consumes `data`; `sha1` gives the digest to feed a record's block to."""
        view, at = memoryview(data), 0
        while at < len(data) or (self.fields is not None and not self.left and not self.skip):
            if self.skip:
                step = min(self.skip, len(data) - at)
                self.skip -= step
                at += step
            elif self.fields is None:
                # The header's end may lie across two pieces.
                start = max(0, len(self.head) - 3)
                self.head += view[at:]
                end = self.head.find(_END, start)
                if end < 0:
                    return
                at = len(data) - (len(self.head) - end - len(_END))
                lines = self.head[:end].decode("utf-8", "replace").split("\r\n")
                self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                self.head = bytearray()
                self.length = self.left = int(self.fields.get("content-length", 0))
                self.sha1 = sha1(self.fields)
            else:
                step = min(self.left, len(data) - at)
                self.sha1.update(view[at : at + step])
                self.left -= step
                at += step
                if not self.left:
                    fields, self.fields, self.skip = self.fields, None, len(_END)
                    yield fields, self.length


class PayloadReader:
    """Payloads of the records of one archive, continuations joined to their response."""

    def __init__(self) -> None:
        self.stream, self.sha1, self.total = RecordStream(), hashlib.sha1(), 0

    def _digest_for(self, fields: dict[str, str]):
        if fields.get("warc-type") != "continuation":
            self.sha1, self.total = hashlib.sha1(), 0
        return self.sha1

    def feed(self, data: bytes) -> Iterator[tuple]:
        """(record, type, refers to, payload bytes, digest found, digest stated)."""
        for fields, length in self.stream.feed(data, self._digest_for):
            self.total += length
            kind, stated = fields.get("warc-type"), fields.get("warc-payload-digest", "")
            if kind == "response":
                self.name, self.refers = fields.get("warc-record-id", "").strip("<>"), None
            elif kind == "revisit":
                self.name = fields.get("warc-record-id", "").strip("<>")
                self.refers = fields.get("warc-refers-to", "").strip("<>")
            if kind in ("response", "continuation", "revisit") and stated.startswith("sha1:"):
                hexed = b16encode(b32decode(stated[5:])).decode().lower()
                if kind == "revisit":
                    yield self.name, kind, self.refers, int(fields.get("x-payload-length", 0)), hexed, hexed
                else:
                    yield self.name, "response", None, self.total, self.sha1.hexdigest(), hexed


def plan_revisits(pages: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """(page_id, digest, length, refers_to) of every page; no payload is shuffled."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    marks = pages.select("page_id", F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("length"))
    large = marks.where(F.col("length") >= least)
    kept = large.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("response")), F.col("response"))
    return large.join(kept.drop("n"), "digest").select("page_id", "digest", refers.alias("refers_to")).where("refers_to IS NOT NULL")


def write_archives(pages: DataFrame, path: str, chunk: int = CHUNK, least: int = LEAST_REVISITED) -> None:
    """Writes one WARC record per page (more for an oversized one) below `path`, gzipped.

    Of pages with equal payloads of at least `least` bytes, that with the largest
    page_id is the response. A null html is an empty payload. Rows that share the
    largest page_id are all responses; a page without an id revisits one that has an id.
    A row is a revisit by its own payload, whatever other rows of its page_id hold.
    """
    revisits = plan_revisits(pages, least).distinct().withColumnsRenamed({"page_id": "revisiting", "digest": "revisited"})
    payload = F.coalesce(F.col("html"), F.lit("")).alias("html")
    marked = pages.select("page_id", "url", payload).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    same = F.col("page_id").eqNullSafe(F.col("revisiting")) & (F.col("digest") == F.col("revisited"))
    joined = marked.join(revisits, same, "left")
    rows = joined.select("page_id", "url", F.col("html").cast("binary"), "refers_to")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, size = [], 0
            for page, url, html, refers in zip(*(batch.column(i) for i in range(4))):
                for record in page_records(page.as_py(), url.as_py(), html.as_py(), refers.as_py(), chunk):
                    texts.append(record)
                    size += len(record)
                    if size > 2**24:
                        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()).cast(pa.string())], ["value"])
                        texts, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()).cast(pa.string())], ["value"])

    archived = rows.mapInArrow(records, "value string")
    # A record's continuations follow it in its file: a session's limit of rows in a file must not cut there.
    archived.write.option("maxRecordsPerFile", 0).option("lineSep", _END.decode()).option("compression", "gzip").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, refers_to, payload_bytes, payload_digest, sound) of the archives' payloads.

    `sound` tells whether the digest of what was read is the digest that was stated.
    Gzipped archives are not split, so each is one stream of pieces in file order.
    """
    pieces = spark.read.option("lineSep", _END.decode()).text(path).select(F.col("value").cast("binary"))
    names = ["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "stated"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = PayloadReader()
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            found = [r for piece in batch.column(0) for part in (piece.as_py(), _END) for r in reader.feed(part)]
            columns = zip(*found) if found else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    read = pieces.mapInArrow(
        parse,
        "record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, stated string",
    )
    return read.withColumn("sound", F.col("payload_digest") == F.col("stated")).drop("stated")


def archive_report(pages: DataFrame, path: str) -> DataFrame:
    """Writes the archives of `pages` and reports what reading them back gives, per page."""
    write_archives(pages, path)
    read = read_archives(pages.sparkSession, path)
    number = lambda c: F.nullif(F.substring(c, len(_ID) + 1, 20), F.lit("")).cast("long")
    return read.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )
