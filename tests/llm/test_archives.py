"""ARC parsing, WARC synthesis and the way through both."""

import base64
import hashlib

import pytest

from siltstone.llm import warc
from siltstone.session import scratch_path


def test_both_header_forms():
    for version in (1, 2):
        bodies = [b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc", b"", b"line\nfeeds\n\n", "é".encode()]
        data = warc.arc_version_block(version)
        data += b"".join(warc.arc_record(version, f"http://a/{i} b", "20240102", b) for i, b in enumerate(bodies))
        got = list(warc.arc_records(data))
        assert [r.body for r in got] == bodies
        assert got[0].url == "http://a/0%20b" and got[0].date == "20240102"
        assert got[0].http() == (bodies[0][:-3], b"abc") and got[2].http() == (b"", bodies[2])
        for broken in (data[:-2], data[:-1] + b"x", data.replace(b" 2\n", b" x\n"), data + b"u\n"):
            with pytest.raises(ValueError):
                list(warc.arc_records(broken))


def test_dates():
    assert warc.iso("20240203040506") == "2024-02-03T04:05:06Z"
    assert warc.iso("2024") == "2024-01-01T00:00:00Z"


def test_archive(spark):
    rows = [
        (1, "http://a/", "<p>same</p>", "clash"),
        (2, "http://b/ c", "<p>same</p>", "clash"),
        (3, None, "other é 日本", "clash"),
        (4, "http://d/", None, "clash"),
        (5, "http://e/", "", "clash"),
        (6, "http://f/", "line\r\n\r\nline\n" * 5000, "clash"),
        (7, "http://g/", "<p>same</p>", "clash"),
        (7, "http://g/", "<p>same</p>", "clash"),
        (None, "http://h/", "<p>same</p>", "clash"),
        (None, "http://i/", "alone", "clash"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string").repartition(3)
    got = warc.archive(pages).collect()
    groups: dict = {}
    for i, _, html, _ in rows:
        groups.setdefault(html or "", []).append(-1 if i is None else i)
    want = []
    for i, url, html, _ in rows:
        raw = (html or "").encode()
        last = max(groups[html or ""])
        copy = (-1 if i is None else i) != last
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, len(raw), digest, "revisit" if copy else "response", last if copy else None))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key
    ) == sorted(want, key=key)
    small = warc.archive(pages, least_bytes=12).collect()
    assert all(r.record_type == "response" for r in small if r.payload_bytes < 12)
    assert warc.archive(pages.limit(0)).count() == 0


def test_blocks_as_a_table(spark):
    rows = [(i, f"http://a/{i}", f"page {i}") for i in range(40)]
    marked = warc.with_copies(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    folder = scratch_path(spark, "warc")
    warc.convert(warc.to_arc(marked), folder)
    got = warc.read_warc(spark, folder).collect()
    assert sorted((r.page_id, r.url, r.payload_bytes) for r in got) == [(i, u, len(h)) for i, u, h in rows]


def test_broken_warc():
    record = warc.ArcRecord("http://a/", "0.0.0.0", "2024", "text/html", warc._http(b"abc"))
    made = warc.warc_record(record, 1, None, False)
    fields, block = next(warc.warc_records(made))
    assert warc._described(fields, block)["payload_bytes"] == 3
    with pytest.raises(ValueError):
        warc._described(fields, block.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        list(warc.warc_records(made[:-3]))
    assert made == warc.warc_record(record, 1, None, False)  # a repeated task writes the same bytes
