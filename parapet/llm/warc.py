"""WARC archives: write records, read them back as a chunked table.

Writing: payload digests are compared first; of records with equal payloads
of at least ``MIN_REVISIT`` bytes, that with the largest id is a response and
the others are revisits of it, found by a join salted on frequent digests.
Each task streams its records, one gzip member each, into archives of its
own in the shared folder; only archives named in the committed manifest are
read, so a retried task leaves no doubles.

Reading: each archive is streamed. A payload of any size becomes rows
(record_id, chunk_no) of at most ``CHUNK`` bytes with the SHA-1 of the
payload up to and including the chunk, so no record is ever held whole; the
last chunk's digest is checked against the header. A revisit has no payload
of its own: its one row carries the digest and length its headers give.

Nulls and empties: a null payload counts as empty; a null url gives no
target address; a null id never leads and revisits a record with an id if
there is one. Rows with the same id and payload keep the same type. An
empty table gives an archive table without rows. Other columns are ignored.
A payload of any length is written and read in chunks.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parapet.llm.shared import shared_path, write_shared
from parapet.operators.skew import salted_join

CHUNK = 64 << 10
MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20       # a task starts another archive beyond
LEVEL = 1                       # of gzip
DATE = "1970-01-01T00:00:00Z"   # the tables name no capture time
_END = b"\r\n\r\n"


def _store(uri: str):
    """(file system, path): local, hdfs, s3, gs ... as the address says."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# --- writing ------------------------------------------------------------------

def typed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, url, payload, bytes, digest, refers_to): ``refers_to`` names the
    leading record of a revisit and is null for a response."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("__id"), F.col(url_col).alias("url"),
                        payload.alias("payload")) \
        .withColumn("bytes", F.octet_length("payload").cast("bigint")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    heads = write_shared(rows.filter(F.col("bytes") >= MIN_REVISIT).groupBy("digest")
                         .agg(F.max("__id").alias("__head"), F.count(F.lit(1)).alias("__n")).filter("__n > 1"), "heads")
    joined = salted_join(rows, heads.select("digest", "__head"), "digest", heads.select("digest", "__n"), how="left")
    revisit = F.col("__head").isNotNull() & (F.col("__id").isNull() | (F.col("__id") < F.col("__head")))
    return joined.select("id", "url", "payload", "bytes", "digest",
                         F.when(revisit, F.col("__head").cast("string")).alias("refers_to"))


def _record(kind: str, name: str, block: int, uri: str | None, extra: list[str]) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}"]
    if uri is not None:     # no control characters in a header
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    return "\r\n".join([*head, *extra, f"Content-Length: {block}"]).encode() + _END


def record_name(key: str | None) -> str:
    return f"urn:page:{key}" if key is not None else f"urn:page:none:{uuid.uuid4()}"


def write(records: DataFrame, folder: str) -> DataFrame:
    """Write ``typed`` records below ``folder``; the manifest (archive,
    records, bytes) of what the finished tasks wrote."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _store(folder)
        out = name = None
        count = size = 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([count]), pa.array([size])],
                                              ["archive", "records", "bytes"])

        for rb in batches:
            for row in range(rb.num_rows):
                if out is not None and size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)    # members are packed here
                key, url, digest, refers = (rb.column(k)[row].as_py() for k in (0, 1, 4, 5))
                payload = memoryview(rb.column(2)[row].as_buffer())
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + _END
                extra = ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
                if refers is not None:
                    extra += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                              f"WARC-Refers-To: <{record_name(refers)}>"]
                    payload = payload[:0]
                kind = "response" if refers is None else "revisit"
                z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                parts = [_record(kind, record_name(key), len(http) + len(payload), url, extra), http]
                for piece in (*parts, *(payload[i:i + CHUNK] for i in range(0, len(payload), CHUNK)), _END):
                    got = z.compress(piece)
                    if got:
                        size += len(got)
                        out.write(got)
                got = z.flush()
                size += len(got)
                out.write(got)
                count += 1
        if out is not None:
            yield close()

    rows = records.select("id", "url", F.col("payload").cast("binary"), "bytes", "digest", "refers_to")
    return write_shared(rows.mapInArrow(run, "archive string, records bigint, bytes bigint"), "manifest")


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            folder: str | None = None) -> DataFrame:
    """Write a record per row of ``pages``; the manifest of the archives."""
    return write(typed(pages, id_col, url_col, payload_col), folder or shared_path(pages.sparkSession, "warc"))


# --- reading ------------------------------------------------------------------

class Stream:
    """Bytes of a gzip file of any number of members, at most ``CHUNK`` of
    them unpacked at a time."""

    def __init__(self, raw):
        self.raw, self.unzip, self.packed, self.full = raw, None, b"", False
        self.ready = bytearray()

    def more(self) -> bool:
        while True:
            fresh = self.unzip is None or self.unzip.eof
            # after a full piece the unpacker may hold more without further input
            if not self.packed and (fresh or not self.full):
                self.packed = self.raw.read(CHUNK)
                if not self.packed:
                    if not fresh:
                        raise EOFError("the archive ends in a record")
                    return False
            if fresh:
                self.unzip = zlib.decompressobj(31)
            got = self.unzip.decompress(self.packed, CHUNK)
            self.full = len(got) == CHUNK
            self.packed = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
            if got:
                self.ready += got
                return True

    def head(self) -> bytes | None:
        """Up to the next blank line; None at the end of the file."""
        at = 0
        while (end := self.ready.find(_END, at)) < 0:
            at = max(0, len(self.ready) - len(_END))
            if not self.more():
                if self.ready:
                    raise EOFError("the archive ends in a header")
                return None
        got = bytes(self.ready[:end])
        del self.ready[:end + len(_END)]
        return got

    def chunks(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces of ``CHUNK``; the last is shorter."""
        while n:
            want = min(n, CHUNK)
            while len(self.ready) < want:
                if not self.more():
                    raise EOFError("the archive ends in a record")
            got = bytes(self.ready[:want])
            del self.ready[:want]
            n -= want
            yield got


def _fields(head: bytes) -> dict[str, str]:
    rows = (x.split(":", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in x)
    return {k.strip().lower(): v.strip() for k, v in rows}


def records(raw) -> Iterator[tuple]:
    """(record_id, record_type, refers_to, uri, chunk_no, is_last,
    payload_bytes so far, SHA-1 so far, chunk) of an open archive."""
    s = Stream(raw)
    while (head := s.head()) is not None:
        f = _fields(head)
        name, kind = f["warc-record-id"].strip("<>"), f["warc-type"]
        refers = f["warc-refers-to"].strip("<>") if "warc-refers-to" in f else None
        left = int(f["content-length"])
        http = {}
        if f.get("content-type", "").startswith("application/http"):
            block = s.head()
            http, left = _fields(block), left - len(block) - len(_END)
        said = f.get("warc-payload-digest", "").removeprefix("sha1:")
        sha, size, no = hashlib.sha1(), 0, 0
        if kind == "revisit":
            for _ in s.chunks(left):
                pass
            yield name, kind, refers, f.get("warc-target-uri"), 0, True, int(http.get("content-length", 0)), said, b""
        else:
            if not left and said and said != sha.hexdigest():
                raise ValueError(f"payload of {name} does not match its digest")
            if not left:
                yield name, kind, refers, f.get("warc-target-uri"), 0, True, 0, sha.hexdigest(), b""
            for piece in s.chunks(left):
                sha.update(piece)
                size += len(piece)
                left -= len(piece)
                now = sha.hexdigest()
                if not left and said and said != now:
                    raise ValueError(f"payload of {name} does not match its digest")
                yield name, kind, refers, f.get("warc-target-uri"), no, not left, size, now, piece
                no += 1
        if next(s.chunks(len(_END))) != _END:
            raise ValueError(f"record {name} does not end where its length says")


_CHUNK_ROW = ("archive string, record_id string, record_type string, refers_to string, uri string, chunk_no int, "
              "is_last boolean, payload_bytes bigint, payload_digest string, chunk binary")


def read_chunks(spark: SparkSession, manifest: DataFrame, with_bytes: bool = True) -> DataFrame:
    """The chunked record table of the archives in ``manifest`` (archive)."""
    kinds = [pa.string()] * 5 + [pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in _CHUNK_ROW.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for path in rb.column(0).to_pylist():
                fs, inner = _store(path)
                with fs.open_input_stream(inner, compression=None) as raw:
                    rows, held = [], 0
                    for r in records(raw):
                        rows.append((path, *r) if with_bytes else (path, *r[:-1], None))
                        held += len(r[-1]) if with_bytes else 0
                        if held >= 32 * CHUNK or len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    archives = manifest.select("archive")
    return archives.repartition(max(1, archives.count())).mapInArrow(run, _CHUNK_ROW)


def summary(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk: the digest and length are whole there."""
    return chunks.filter("is_last").select("record_id", "record_type", "refers_to", "uri", "payload_bytes", "payload_digest")


def page_of(name: Column) -> Column:
    """The id in a record's name; null for a record without one."""
    return F.nullif(F.regexp_extract(name, r"^urn:page:(-?\d+)$", 1), F.lit("")).cast("bigint")
