"""WARC archives: writing a table as archives, normalising whole-file gzip streams, reading by offset index.

``write_archives`` stores each row as a record in archives whose gzip stream spans the whole file, as crawlers
that pipe through gzip leave them. ``normalise`` inflates each such stream once, from front to back, rewrites
every record as a gzip member of its own and writes a sidecar index of member offsets. ``read_archives`` opens
members by that index.

Work is dealt by archive; archives are closed at ``max_bytes`` of records. Records pass through in pieces, so
a task holds one piece of a record and, on reading, one record. Files get names of their own per task attempt
and only those of attempts that succeeded are in the returned manifest, so retried and speculative tasks leave
no double records. Manifests are tables, never lists on the driver.

Edge rows: a null payload is empty; a null id or URL is a missing header field and is read back as null. Rows
that repeat an id and its payload are all responses when that id is the largest. An empty table gives no
archive and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import broadcast_if, rows_of, stored, text_bytes
from textloom.sources.npy import file_system

GZIP = 16 + zlib.MAX_WBITS
PIECE = 1 << 20
MAX_BYTES = 64 << 20
#: Digests of repeated payloads up to this many rows (about 50 bytes each) are broadcast; beyond it the join shuffles.
BROADCAST_DIGESTS = 200_000
#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

MANIFEST = "path string, index_path string, records long, bytes long"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, path string, member_offset long, member_length long")


def mark_revisits(pages: DataFrame, id_col: str = "page_id", min_bytes: int = 0,
                  broadcast_digests: int = BROADCAST_DIGESTS) -> DataFrame:
    """Adds ``record_type`` and ``refers_to`` to rows with a binary ``payload``.

    Of rows whose payloads are equal and have at least ``min_bytes``, those with the largest id are responses."""
    rows = pages.withColumn("_key", F.when(F.octet_length("payload") >= min_bytes, F.unhex(F.sha2("payload", 256))))
    first = stored(rows.where("_key IS NOT NULL").groupBy("_key")
                   .agg(F.max(id_col).alias("_first"), F.count(F.lit(1)).alias("_n"))
                   .where("_n > 1").select("_key", "_first"), "warc-digests")
    rows = rows.join(broadcast_if(first, broadcast_digests), "_key", "left")
    again = F.col("_key").isNotNull() & F.col("_first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("_first"))
    return (rows.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(again, F.col("_first"))).drop("_key", "_first"))


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}')}>"


def _record(page_id, url, payload: bytes, kind: str, refers_to, date: str) -> bytes:
    block = HTTP_HEAD % len(payload) + (payload if kind == "response" else b"")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", date),
              ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("X-Payload-Length", len(payload))]
    if page_id is not None:
        fields.append(("X-Page-ID", page_id))
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="/:?&=#+,;@!$'()*[]~")))
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to)), ("X-Refers-To-ID", refers_to)]
    fields.append(("Content-Length", len(block)))
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def write_archives(rows: DataFrame, folder: str, max_bytes: int = MAX_BYTES, level: int = 1,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes rows (page_id, url, payload, record_type, refers_to) as archives; returns their manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        out, done, n, size = None, [], 0, 0

        def close():
            out.write(pack.flush())
            out.close()
            done.append((f"{folder}/{name}", None, n, size))

        for page_id, url, payload, kind, refers_to in rows_of(batches, "page_id", "url", "payload", "record_type", "refers_to"):
            if out is None:
                name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                out, pack = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, GZIP)
            record = _record(page_id, url, payload, kind, refers_to, date)
            out.write(pack.compress(record))
            n, size = n + 1, size + len(record)
            if size >= max_bytes:
                close()
                out = None
        if out is not None:
            close()
        if done:
            yield _manifest(done)

    cols = rows.select("page_id", "url", "payload", "record_type", "refers_to")
    return stored(cols.mapInArrow(write, MANIFEST), "warc-manifest")


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    path, index, n, size = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(index, pa.string()),
                                       pa.array(n, pa.int64()), pa.array(size, pa.int64())],
                                      ["path", "index_path", "records", "bytes"])


class _Stream:
    """The inflated bytes of a gzip file, front to back; members that follow each other are one stream."""

    def __init__(self, file):
        self.file, self.inflate, self.buffer = file, zlib.decompressobj(GZIP), bytearray()

    def more(self) -> bool:
        data = self.inflate.unconsumed_tail or self.inflate.unused_data
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(GZIP)
            data = data or self.file.read(PIECE)
            if not data:
                return False
        else:
            data = data or self.file.read(PIECE)
            if not data:
                raise ValueError("the gzip stream ends before its trailer")
        self.buffer += self.inflate.decompress(data, PIECE)
        return True

    def head(self) -> bytes | None:
        """The next record's header with its blank line; None at the end."""
        seen = 0
        while (at := self.buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.buffer)
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("the archive ends inside a record's header")
                return None
        return self.take(at + 4)

    def take(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self.more():
                raise ValueError("the archive ends inside a record")
            piece = self.take(min(n, len(self.buffer)))
            n -= len(piece)
            yield piece


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def normalise(manifest: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrites every record of the listed archives as its own gzip member, with a sidecar index per archive.

    An index line is a JSON object: offset, length, records' type, id and digest. Returns the new manifest."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        done = []
        for (path,) in rows_of(batches, "path"):
            name = uuid.uuid4().hex
            src_fs, src = file_system(path)
            at = n = 0
            with (src_fs.open_input_stream(src, compression=None) as file,
                  fs.open_output_stream(f"{base}/{name}.warc.gz", compression=None) as out,
                  fs.open_output_stream(f"{base}/{name}.index.jsonl", compression=None) as index):
                stream = _Stream(file)
                while (head := stream.head()) is not None:
                    fields, pack = _fields(head), zlib.compressobj(level, zlib.DEFLATED, GZIP)
                    size = out.write(pack.compress(head))
                    for piece in stream.pieces(int(fields["content-length"]) + 4):
                        size += out.write(pack.compress(piece))
                    size += out.write(pack.flush())
                    entry = {"offset": at, "length": size, "type": fields.get("warc-type"),
                             "id": fields.get("warc-record-id"), "digest": fields.get("warc-payload-digest")}
                    index.write(json.dumps(entry).encode() + b"\n")
                    at, n = at + size, n + 1
            done.append((f"{folder}/{name}.warc.gz", f"{folder}/{name}.index.jsonl", n, at))
        if done:
            yield _manifest(done)

    tasks = max(1, manifest.count())
    return stored(manifest.repartition(min(tasks, 100_000)).mapInArrow(rewrite, MANIFEST), "warc-normalised")


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of normalised archives, each member opened at the offset its index gives.

    Payload length and digest of responses are computed from the payload read; revisits carry those of the
    payload they refer to in their header."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, index_path in rows_of(batches, "path", "index_path"):
            fs, inner = file_system(path)
            rows = []
            with fs.open_input_stream(file_system(index_path)[1], compression=None) as index:
                entries = [json.loads(line) for line in index.read().splitlines()]
            with fs.open_input_file(inner) as file:
                for e in entries:
                    file.seek(e["offset"])
                    record = zlib.decompress(file.read(e["length"]), GZIP)
                    rows.append((*_parsed(record), path, e["offset"], e["length"]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES, strict=True)], [x.split()[0] for x in RECORD.split(", ")])

    tasks = max(1, manifest.count())
    return manifest.repartition(min(tasks, 100_000)).mapInArrow(read, RECORD)


_TYPES = [{"long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in RECORD.split(", ")]


def _parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    f = _fields(head)
    number = lambda k: int(f[k]) if k in f else None
    size, digest = number("x-payload-length"), f["warc-payload-digest"].removeprefix("sha1:")
    if f["warc-type"] == "response":
        block = rest[:int(f["content-length"])]
        payload = block[block.index(b"\r\n\r\n") + 4:]
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    url = f.get("warc-target-uri")
    return (number("x-page-id"), None if url is None else unquote(url), size, digest, f["warc-type"], number("x-refers-to-id"))


def archive_pages(pages: DataFrame, folder: str, min_bytes: int = 0, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The whole round: revisit marking, monolithic archives, normalising, reading back."""
    rows = pages.select("page_id", "url", text_bytes("html").alias("payload"))
    raw = write_archives(mark_revisits(rows, min_bytes=min_bytes), f"{folder}/raw", max_bytes)
    return read_archives(normalise(raw, f"{folder}/normalised"))
