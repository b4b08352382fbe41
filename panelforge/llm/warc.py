"""Web archives (WARC/1.1) by way of a chunked record table.

Every payload becomes rows of (record id, chunk number, bytes), each carrying the SHA-1 of the
payload up to its end; the last chunk's is the payload's. No step handles a payload as a whole once
it has left the input row: records of one chunk are written as they are scanned, records of more
are brought together by record id, sorted by chunk number and streamed to the archive. Of records
with equal payloads the one with the smallest page_id is a response; the others are revisits that
name it and have no payload of their own. Archives are gzip files, one member a record; a task
writes its archive under a name of its own attempt, and only archives that a finished task reported
are read, so a lost executor leaves no half archive behind.

Defined results: a very long html is one row of the input, of which chunks are cut one after another; a null html is an empty payload; a null page_id sorts last; of rows equal in
page_id and payload one is the response and the rest revisit it; a null url has no target header;
an empty table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_batches, scratch_path, staged

#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK_SCHEMA = "_uid long, page_id long, url string, chunk_no int, last boolean, upto long, sha1 string, data binary"
ARCHIVE_SCHEMA = "path string, records long, bytes long"
RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def payload_chunks(payload: memoryview | bytes, size: int) -> Iterator[tuple[int, bool, int, str, bytes]]:
    """chunk number, last, bytes so far, SHA-1 so far, and the chunk."""
    so_far, total = hashlib.sha1(), len(payload)
    for no, at in enumerate(range(0, max(total, 1), size)):
        chunk = bytes(payload[at : at + size])
        so_far.update(chunk)
        yield no, at + size >= total, at + len(chunk), base32_sha1(so_far.copy().digest()), chunk


def record_chunks(pages: DataFrame, chunk_bytes: int = 1 << 16, batch_bytes: int = 8 << 20) -> DataFrame:
    """The chunked record table of pages (page_id, url, html), in the shared folder."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    rows = pages.select(F.monotonically_increasing_id().alias("_uid"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").cast("binary").alias("html"))
    schema = to_arrow_schema(_parse_datatype_string(CHUNK_SCHEMA))
    bounded_batches(pages.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            uid, page, url, html = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                payload = html[i].as_buffer() if html[i].is_valid else b""
                for no, last, upto, sha1, chunk in payload_chunks(memoryview(payload), chunk_bytes):
                    held.append((uid[i].as_py(), page[i].as_py(), url[i].as_py(), no, last, upto, sha1, chunk))
                    if (size := size + len(chunk) + 200) >= batch_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return staged(rows.mapInArrow(cut, CHUNK_SCHEMA), "warc-chunks")


def record_plan(chunks: DataFrame, least_bytes: int = 0) -> DataFrame:
    """_uid, _first_uid and _first_page of every record that revisits another."""
    ends = chunks.filter("last").select("_uid", "page_id", F.col("upto").alias("_bytes"), "sha1")
    ends = ends.filter(F.col("_bytes") >= least_bytes)
    order = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page"), F.col("_uid").alias("uid"))
    firsts = ends.groupBy("sha1", "_bytes").agg(F.min(order).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    out = ends.join(firsts, ["sha1", "_bytes"]).filter("_uid <> _first.uid")
    return staged(out.select("_uid", F.col("_first.uid").alias("_first_uid"), F.col("_first.page").alias("_first_page"), F.col("sha1").alias("_sha1"), F.col("_bytes")), "warc-plan")


def _record_head(kind: str, uid: int, page_id: int | None, url: str | None, date: str, size: int, digest: str, first: tuple[int, int | None] | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{uid}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if first:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{first[0]}>"]
        lines += [f"X-Refers-To-Page-ID: {first[1]}"] if first[1] is not None else []
    lines.append(f"Content-Length: {len(http) + (0 if first else size)}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_archives(chunks: DataFrame, plan: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 6, file_bytes: int = 64 << 20) -> DataFrame:
    """Writes the records; returns a table of the archives: path, records, bytes.

    The record's head needs its length and digest before its first byte, so they come along with
    each chunk of an oversized record, by a window over chunk rows without their bytes.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(f"{folder}")
        path, out, n, size, gz = f"{at}/{uuid.uuid4().hex}.warc.gz", None, 0, 0, None
        for batch in batches:
            cols = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                get = {c: v[i].as_py() for c, v in cols.items() if c != "data"}
                if out is None:
                    fs.create_dir(at, recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                first = (get["_first_uid"], get["_first_page"]) if get["_first_uid"] is not None else None
                if get["chunk_no"] == 0:
                    gz = zlib.compressobj(level, wbits=31)
                    out.write(gz.compress(_record_head("revisit" if first else "response", get["_uid"], get["page_id"], get["url"], date, get["_size"], get["_digest"], first)))
                if not first:
                    out.write(gz.compress(cols["data"][i].as_buffer()))
                if get["last"] or first:
                    out.write(gz.compress(b"\r\n\r\n") + gz.flush())
                    n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{path.rsplit('/', 1)[1]}"], "records": [n], "bytes": [size]})

    # oversized records are dealt by their bytes, to as many archives as `file_bytes` asks for
    total = chunks.filter("last and chunk_no > 0").agg(F.sum("upto")).first()[0] or 0
    oversized = max(4, -(-total // file_bytes))
    single = chunks.filter("chunk_no = 0 and last").select("_uid", "page_id", "url", "chunk_no", "last", F.col("upto").alias("_size"), F.col("sha1").alias("_digest"), "data")
    many = chunks.filter("chunk_no > 0 or not last")
    ends = many.filter("last").select("_uid", F.col("upto").alias("_size"), F.col("sha1").alias("_digest"))
    many = many.join(ends, "_uid").select(single.columns)
    # a revisit needs its head only, so the bytes of its chunks stay behind
    known = plan.select("_uid", "_first_uid", "_first_page")
    heads = lambda df: df.join(known, "_uid", "left").filter("_first_uid is null or chunk_no = 0").withColumn("data", F.when(F.col("_first_uid").isNull(), F.col("data")))
    many = heads(many).repartition(oversized, "_uid").sortWithinPartitions("_uid", "chunk_no")
    done = heads(single).mapInArrow(write, ARCHIVE_SCHEMA).unionByName(many.mapInArrow(write, ARCHIVE_SCHEMA))
    return staged(done, "warc-archives")


class _Stream:
    """Bytes of a gzip file of many members, read in pieces of bounded size."""

    def __init__(self, raw, piece: int):
        self.raw, self.piece, self.gz, self.left = raw, piece, zlib.decompressobj(wbits=31), b""
        self.rest = b""

    def _more(self) -> bool:
        while True:
            if self.gz.eof:
                self.rest, self.gz = self.gz.unused_data, zlib.decompressobj(wbits=31)
            if not self.rest:
                self.rest = self.raw.read(self.piece)
            if not self.rest:
                return False
            got = self.gz.decompress(self.rest, self.piece)
            self.rest = self.gz.unconsumed_tail
            if got:
                self.left += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (i := self.left.find(mark)) < 0:
            if not self._more():
                return None
        got, self.left = self.left[:i], self.left[i + len(mark) :]
        return got

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.left and not self._more():
                raise EOFError("the archive ends within a record")
            got, self.left = self.left[:n], self.left[n:]
            n -= len(got)
            yield got


def read_records(path: str, piece: int = 1 << 16) -> Iterator[dict]:
    """The records of one archive, payloads streamed through the digest."""
    fs, at = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(at, compression=None) as raw:
        s = _Stream(raw, piece)
        while (head := s.until(b"\r\n\r\n")) is not None:
            lines = head.decode().split("\r\n")
            if lines[0].encode() != VERSION:
                raise ValueError(f"no record begins at {lines[0][:40]!r} in {path}")
            h = dict(x.split(": ", 1) for x in lines[1:])
            http = s.until(b"\r\n\r\n")
            left, digest, n = int(h["Content-Length"]) - len(http) - 4, hashlib.sha1(), 0
            for chunk in s.take(left):
                digest.update(chunk)
                n += len(chunk)
            b"".join(s.take(4))
            told = h["WARC-Payload-Digest"].removeprefix("sha1:")
            revisit = h["WARC-Type"] == "revisit"
            page, first = h.get("X-Page-ID"), h.get("X-Refers-To-Page-ID")
            yield {
                "page_id": int(page) if page else None, "payload_bytes": int(h["X-Payload-Length"]) if revisit else n,
                "payload_digest": told if revisit else base32_sha1(digest.digest()), "record_type": h["WARC-Type"],
                "refers_to": int(first) if first else None, "intact": revisit or (base32_sha1(digest.digest()) == told and n == int(h["X-Payload-Length"])),
            }


def read_archives(archives: DataFrame, batch: int = 4096) -> DataFrame:
    """A row per record of the archives in the table (path)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(RECORD_SCHEMA))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                held = []
                for r in read_records(path):
                    held.append(r)
                    if len(held) == batch:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    paths = archives.select("path")
    n = archives.count()
    return paths.repartition(max(1, min(n, 4096))).mapInArrow(read, RECORD_SCHEMA)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, chunk_bytes: int = 1 << 16, least_bytes: int = 0) -> DataFrame:
    """Writes all pages to archives in `folder` (one in the shared folder) and returns their table."""
    chunks = record_chunks(pages, chunk_bytes)
    return write_archives(chunks, record_plan(chunks, least_bytes), folder or scratch_path(spark, "warc"))


def round_trip(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """What the archives say of each page after they were written."""
    return read_archives(archive_pages(spark, pages, **options)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")
