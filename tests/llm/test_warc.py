import base64
import hashlib
import json
import zlib
from collections import defaultdict

import pytest

from textloom.llm.common import text_bytes
from textloom.llm.warc import GZIP, _Stream, archive_pages, mark_revisits, normalise, read_archives, write_archives

PAGES = [(1, "http://a/é b\r\nX: y", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b/?q=%20", None), (4, "u", ""),
         (5, "u", "ü" * 200_000), (None, "u", "<p>one</p>"), (None, "v", "alone"), (7, "w", "tie"), (7, "w", "tie"),
         (8, "x", "line\r\n\r\nWARC/1.1\r\n")] + [(100 + i, "h", "hot") for i in range(60)]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*p, 1, "z") for p in PAGES], "page_id long, url string, html string, path string, digest string").repartition(3)


def brute():
    groups = defaultdict(list)
    for page, _, html in PAGES:
        groups[(html or "").encode()].append(page)
    out = []
    for payload, ids in groups.items():
        first = max((i for i in ids if i is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out += [(i, len(payload), digest, "response" if i == first else "revisit", None if i == first else first) for i in ids]
    return out


def order(rows):
    return sorted((tuple((x is None, x or 0) for x in r) for r in rows))


@pytest.mark.parametrize("max_bytes", [1, 1 << 20])
def test_archives_equal_brute_force(pages, tmp_dir, max_bytes):
    out = archive_pages(pages, tmp_dir, max_bytes=max_bytes)
    got = out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert order(map(tuple, got)) == order(brute())
    assert {(r.page_id, r.url) for r in out.collect()} == {(p, u) for p, u, _ in PAGES}


def test_every_record_is_a_member_at_its_indexed_offset(pages, tmp_dir):
    raw = write_archives(mark_revisits(pages.withColumn("payload", text_bytes("html"))), tmp_dir + "/raw")
    for m in raw.collect():
        data = open(m.path, "rb").read()
        one = zlib.decompressobj(GZIP)
        assert len(one.decompress(data)) == m.bytes and one.eof and not one.unused_data  # a stream over the whole file
    for m in normalise(raw, tmp_dir + "/out").collect():
        data, at = open(m.path, "rb").read(), 0
        for e in map(json.loads, open(m.index_path)):
            assert e["offset"] == at
            assert zlib.decompress(data[at:at + e["length"]], GZIP).startswith(b"WARC/1.1\r\nWARC-Type: " + e["type"].encode())
            at += e["length"]
        assert at == len(data) == m.bytes


def test_minimum_size_and_empty_table(pages, tmp_dir):
    few = archive_pages(pages, tmp_dir, min_bytes=4).collect()
    assert {r.record_type for r in few if r.payload_bytes < 4} == {"response"}
    assert any(r.record_type == "revisit" for r in few)
    assert archive_pages(pages.limit(0), tmp_dir + "/none").count() == 0


def test_streams_of_members_and_cut_files(tmp_dir):
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    pack = lambda x: (c := zlib.compressobj(1, zlib.DEFLATED, GZIP)).compress(x) + c.flush()
    path = tmp_dir + "/x.gz"
    open(path, "wb").write(pack(record[:20]) + pack(record[20:] + record))
    stream, n = _Stream(open(path, "rb")), 0
    while stream.head() is not None:
        assert b"".join(stream.pieces(9)) == b"hello\r\n\r\n"
        n += 1
    assert n == 2
    open(path, "wb").write(pack(record * 50)[:-12])
    stream = _Stream(open(path, "rb"))
    with pytest.raises(ValueError):
        while stream.head() is not None:
            b"".join(stream.pieces(9))
    assert read_archives is not None
