"""Web archives: writing them from page rows, and reading them record by record.

An archive is a file of gzip members, one a record. Equal payloads of some size are stored
once; the other records of the group are revisits that name the record holding the payload.
The reader goes through a file once, in small chunks: it inflates a member step by step,
parses the record's header, takes the block by its stated length and checks its digests.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmotion.llm.common import fresh_folder, open_store, write_once

SHARED_FROM = 1000  # payloads of fewer bytes are always stored
ARCHIVE_BYTES = 256_000_000  # an archive is closed beyond so many bytes
CHUNK = 1 << 16
DATE = "2024-01-01T00:00:00Z"  # fixed, so that equal rows give equal records
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, least: int = SHARED_FROM) -> DataFrame:
    """Which row holds its payload and which row revisits another.

    Adds payload_digest, payload_bytes, record_type and refers_to to (page_id, url, html). Only
    groups that occur more than once are joined back.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("payload_digest", F.sha1("html")).withColumn(
        "payload_bytes", F.octet_length("html").cast("long")
    )
    shared = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("holder"))
        .where("copies > 1 AND holder IS NOT NULL")
        .select(F.col("payload_digest").alias("__d"), F.col("payload_bytes").alias("__b"), "holder")
    )
    joined = rows.join(
        shared, (F.col("payload_digest") == F.col("__d")) & (F.col("payload_bytes") == F.col("__b")), "left"
    )
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return joined.select(
        "page_id",
        "url",
        "html",
        "payload_digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("holder")).alias("refers_to"),
    )


def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() and c != " " else "%" + format(ord(c), "02X") for c in value)


def record(row: dict) -> bytes:
    """One record as a gzip member."""
    payload = row["html"].encode()
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    if row["record_type"] == "response":
        block += payload
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<urn:page:{'null' if row['page_id'] is None else row['page_id']}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _line(row["url"])))
    if row["record_type"] == "revisit":
        fields += [("WARC-Refers-To", f"<urn:page:{row['refers_to']}>"), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Length", str(len(block))))
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(head) + deflate.compress(block) + deflate.compress(b"\r\n\r\n") + deflate.flush()


def write_archives(pages: DataFrame, least: int = SHARED_FROM, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every row of (page_id, url, html) as a record; returns (path, records) of the archives.

    A null html is an empty payload, a null url is left out, a null page_id never holds a
    payload for others unless all of the group are null (then each row holds its own); of
    repeated rows that share the largest page_id each is a response. Other columns are ignored
    and an empty table gives no archive. Attempts write files of their own; only those of
    finished tasks are listed.
    """
    spark = pages.sparkSession
    folder = fresh_folder(spark, "archives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, counts, out, size = [], [], None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if out is None:
                    path, out = write_once(folder, "pages", ".warc.gz")
                    paths.append(path)
                    counts.append(0)
                    size = 0
                member = record(row)
                out.write(member)
                counts[-1] += 1
                size += len(member)
                if size >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["path", "records"])

    listing = fresh_folder(spark, "archive-list")
    plan_records(pages, least).mapInArrow(run, "path string, records long").write.parquet(listing)
    return spark.read.schema("path string, records long").parquet(listing)


class Members:
    """Inflates a stream of gzip members; hands out bytes of the current one."""

    def __init__(self, stream):
        self.stream, self.raw, self.ready = stream, b"", b""
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        """Inflate a little more of the member; False when it has ended."""
        if self.inflate.eof:
            return False
        feed = self.inflate.unconsumed_tail or self.raw or self.stream.read(CHUNK)
        self.raw = b""
        part = self.inflate.decompress(feed, CHUNK)
        if not feed and not part and not self.inflate.eof:
            raise ValueError("an archive ends inside a record")
        self.ready += part
        if self.inflate.eof:
            self.raw = self.inflate.unused_data
        return True

    def line(self) -> bytes:
        while b"\r\n" not in self.ready:
            if not self._more():
                raise ValueError("a header line does not end")
        line, _, self.ready = self.ready.partition(b"\r\n")
        return line

    def take(self, most: int) -> bytes:
        """Between 1 and `most` bytes; none at the member's end."""
        while not self.ready and self._more():
            pass
        out, self.ready = self.ready[:most], self.ready[most:]
        return out

    def next(self) -> bool:
        """Go on to the next member."""
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
        if not self.raw:
            return False
        self.inflate, self.ready = zlib.decompressobj(31), b""
        return True


def _fields(members: Members) -> dict[str, str]:
    out = {}
    while line := members.line():
        name, _, value = line.decode().partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def read_archive(stream, keep: bool = False) -> Iterator[dict]:
    """Records of one archive, in order; digests are checked, payloads kept only on request."""
    members = Members(stream)
    while members.next():
        if members.line() != VERSION:
            raise ValueError("not a record of a known version")
        head = _fields(members)
        left = int(head["content-length"])
        block, payload, lead, kept = hashlib.sha1(), hashlib.sha1(), b"", []
        http, size = None, 0
        while left:
            part = members.take(min(left, CHUNK))
            if not part:
                raise ValueError("a record is shorter than its stated length")
            left -= len(part)
            block.update(part)
            if http is None:
                lead += part
                if b"\r\n\r\n" not in lead:
                    continue
                http, _, part = lead.partition(b"\r\n\r\n")
            payload.update(part)
            size += len(part)
            if keep:
                kept.append(part)
        end = b""
        while part := members.take(CHUNK):
            end += part
        if end != b"\r\n\r\n":
            raise ValueError("a record is longer than its stated length")
        if head["warc-block-digest"] != f"sha1:{block.hexdigest()}":
            raise ValueError(f"block digest of {head['warc-record-id']} differs")
        stated = head["warc-payload-digest"].removeprefix("sha1:")
        if head["warc-type"] == "response":
            if stated != payload.hexdigest():
                raise ValueError(f"payload digest of {head['warc-record-id']} differs")
        else:  # the full payload's length stands in the kept HTTP header
            fields = dict(x.split(b": ", 1) for x in (http or b"").split(b"\r\n")[1:])
            size = int(fields[b"Content-Length"])
        identity = lambda name: head[name].removeprefix("<urn:page:").removesuffix(">")
        page = identity("warc-record-id")
        yield {
            "page_id": None if page == "null" else int(page),
            "payload_bytes": size,
            "payload_digest": stated,
            "record_type": head["warc-type"],
            "refers_to": int(identity("warc-refers-to")) if "warc-refers-to" in head else None,
            "url": head.get("warc-target-uri"),
            "payload": b"".join(kept) if keep else None,
        }


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def read_archives(listing: DataFrame, at_once: int = 4096) -> DataFrame:
    """Records of all listed archives, one task an archive; a damaged archive fails the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_store(row["path"])
                rows, seen = [], 0
                with store.open_input_stream(path, buffer_size=CHUNK) as stream:
                    for item in read_archive(stream):
                        item.pop("payload")
                        rows.append(item)
                        seen += 1
                        if len(rows) == at_once:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if seen != row["records"]:
                    raise ValueError(f"{path}: {seen} records, {row['records']} were written")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    n = max(1, listing.count())
    return listing.repartition(n).mapInArrow(run, RECORDS)
