import base64
import gzip
import hashlib
import io

import pytest
from awkward_rows import norm
from pyspark.sql import functions as F

from propensia.llm import warc
from propensia.llm.common import scratch_path

PAGES = [
    (5, "http://a/1", "<p>same</p>"), (3, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"),
    (3, "http://a/2", "<p>same</p>"), (4, "http://a/\r\nX: y", None), (7, "u", ""), (None, "n", "<p>same</p>"),
    (None, "n", "alone"), (11, "big", "x" * 700_000 + "é"), (12, "bytes", "\x1f\x8b\x08 WARC/1.1"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*p, "clash", b"clash") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha string, payload binary")


def expected():
    out = []
    for k, _, html in PAGES:
        body = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = min(same) if same else None
        revisit = first is not None and k != first
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((k, len(body), digest, "revisit" if revisit else "response", first if revisit else None))
    return out


@pytest.mark.parametrize("range_bytes", [97, 1000, 1 << 20])
def test_round_trip_at_any_range_size(spark, pages, range_bytes):
    path = scratch_path(spark, "test-warc")
    assert warc.write_archives(pages, path, file_bytes=4000) == len(PAGES)
    rows = warc.resolve(warc.read_archives(spark, path, range_bytes=range_bytes))
    got = rows.select("page_id", "payload_bytes", "digest", "record_type", "refers_to").collect()
    assert norm(got) == norm(expected())


def test_payloads_and_headers(spark, pages):
    path = scratch_path(spark, "test-warc")
    warc.write_archives(pages, path)
    rows = warc.read_archives(spark, path, with_payload=True).filter("record_type = 'response'").collect()
    assert {bytes(r["payload"]) for r in rows} == {(h or "").encode() for _, _, h in PAGES}
    assert {r["url"] for r in rows if r["page_id"] == 4} == {"http://a/%0D%0AX: y"}


def test_scanner_ignores_false_magic_and_foreign_members():
    good = warc.encode_record(1, "u", b"payload", None, False, "2024-01-01T00:00:00Z")
    raw = b"junk" + warc.MAGIC + b"zz" + gzip.compress(b"not an archive") + good + b"\x1f" + good + warc.MAGIC
    found = [o for o, _ in warc.MemberScanner(io.BytesIO(raw), 0, len(raw)).records()]
    first = raw.index(good)
    assert found == [first, first + len(good) + 1]
    cuts = [o for low in range(0, len(raw), 7) for o, _ in warc.MemberScanner(io.BytesIO(raw), low, low + 7).records()]
    assert cuts == found
    cut = raw[: first + len(good) - 3]
    assert not list(warc.MemberScanner(io.BytesIO(cut), 0, len(cut)).records())


def test_smaller_payloads_are_never_revisits(spark, pages):
    path = scratch_path(spark, "test-warc")
    warc.write_archives(pages, path, min_revisit_bytes=100)
    assert warc.read_archives(spark, path).filter("record_type = 'revisit'").count() == 0


def test_empty_table(spark, pages):
    path = scratch_path(spark, "test-warc")
    assert warc.write_archives(pages.filter(F.lit(False)), path) == 0
    assert warc.read_archives(spark, path).count() == 0


def foreign(kind, block, *fields):
    """A record as some other writer may put it."""
    lines = ["WARC/1.0", *([f"WARC-Type: {kind}"] if kind else []), *fields]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def sha1_32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_archives_of_other_writers(spark, scratch):
    http, msg = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n", "Content-Type: application/http;msgtype=response"
    chunked = http + b"Transfer-Encoding: chunked\r\n\r\n4\r\nWiki\r\n6;x=y\r\npedia!\r\n0\r\n\r\n"
    n = lambda block: f"Content-Length: {len(block)}"
    plain, broken = http + b"\r\nhello", http + b"Transfer-Encoding: chunked\r\n\r\nnot chunked"
    members = [
        foreign("warcinfo", b"software: x\r\n", "WARC-Record-ID: <urn:1>", "Content-Type: application/warc-fields", n(b"software: x\r\n")),
        foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "WARC-Record-ID: <urn:2>", "Content-Type: application/http; msgtype=request", n(b"GET / HTTP/1.1\r\nHost: a\r\n\r\n")),
        foreign("response", plain, "WARC-Record-ID: <urn:3>", msg, n(plain), "WARC-Target-URI: http://a/", "X-Page-Id: none"),
        foreign("response", chunked, "WARC-Record-ID: <urn:4>", msg, n(chunked), f"WARC-Payload-Digest: sha1:{sha1_32(b'Wikipedia!')}"),
        foreign("response", chunked, "WARC-Record-ID: <urn:5>", msg, n(chunked), f"WARC-Payload-Digest: sha1:{sha1_32(chunked.partition(bytes(2 * [13, 10]))[2])}"),
        foreign("response", broken, "WARC-Record-ID: <urn:6>", msg, n(broken), "WARC-Payload-Digest: md5:abc", "X-Folded: one", " two"),
        foreign("resource", b"\x00\x01", "WARC-Record-ID: <urn:7>", "Content-Type: image/png", n(b"\x00\x01")),
        foreign("metadata", b"via: b", "WARC-Record-ID: <urn:8>", "Content-Length: many"),
        foreign("revisit", b"", "WARC-Record-ID: <urn:9>", "Content-Length: 0", f"WARC-Payload-Digest: sha1:{sha1_32(b'gone')}", "WARC-Refers-To: <urn:elsewhere>"),
        foreign(None, b"", "Content-Length: 0"),
    ]
    with open(f"{scratch}/other.warc.gz", "wb") as out:
        out.write(b"".join(members))
    want = [
        ("warcinfo", "<urn:1>", None, 13), ("request", "<urn:2>", None, 0), ("response", "<urn:3>", sha1_32(b"hello"), 5),
        ("response", "<urn:4>", sha1_32(b"Wikipedia!"), 10), ("response", "<urn:5>", sha1_32(b"Wikipedia!"), 10),
        ("response", "<urn:6>", sha1_32(b"not chunked"), 11), ("resource", "<urn:7>", sha1_32(b"\x00\x01"), 2),
        ("metadata", "<urn:8>", None, 6), ("revisit", "<urn:9>", sha1_32(b"gone"), None), (None, None, None, 0),
    ]
    for range_bytes, tasks in ((256 << 20, 10), (50, 3)):
        rows = warc.read_archives(spark, scratch, range_bytes=range_bytes, most_tasks=tasks)
        for found in (rows, warc.resolve(rows)):
            assert norm(found.select("record_type", "record_id", "digest", "payload_bytes").collect()) == norm(want)
        assert rows.filter("page_id is not null").count() == 0


def test_a_damaged_payload_is_an_error(spark, scratch):
    block = b"HTTP/1.1 200 OK\r\n\r\nhello"
    with open(f"{scratch}/bad.warc.gz", "wb") as out:
        out.write(foreign("response", block, "Content-Type: application/http", f"Content-Length: {len(block)}", f"WARC-Payload-Digest: sha1:{sha1_32(b'other')}"))
    with pytest.raises(Exception, match="digest differs"):
        warc.read_archives(spark, scratch).collect()
