import base64
import hashlib
import io

import pytest
import zstandard

from quotemill.llm import warc

PAGES = "page_id bigint, url string, html string, path string, records string"


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "p", "r") for row in rows], PAGES)
    archives = warc.write_archives(frame, **options)
    return archives, sorted(map(tuple, warc.read_archives(archives).collect()), key=repr)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    rows = [(n, f"http://x.example/{n}", f"<p>page {n % 30}</p>" * (n % 5 + 1)) for n in range(300)]
    rows += [(1000, None, None), (1001, "http://a b.example/\r\n", ""), (1002, "u", "é" * 500_000), (-5, "u", "neg"), (2**62 + 7, "u", "big")]
    archives, got = run(spark, rows, archive_bytes=5000)
    first = {}
    for i, _, html in sorted(rows):
        first.setdefault(html or "", i)
    want = []
    for i, url, html in rows:
        own = first[html or ""] == i
        shown = None if url is None else url.replace(" ", "%20").replace("\r", "%0D").replace("\n", "%0A")
        payload = (html or "").encode()
        want.append(
            (i, shown, "response" if own else "revisit", len(payload), sha(html), None if own else first[html or ""], payload if own else None)
        )
    assert got == sorted(want, key=repr)
    assert archives.agg({"records": "sum"}).first()[0] == len(rows)


def test_least_bytes_and_null_or_repeated_ids(spark):
    rows = [(3, "u", "aa"), (4, "u", "aa"), (5, "u", "long"), (6, "u", "long"), (None, "u", "long"), (5, "u", "long")]
    _, got = run(spark, rows, least_bytes=3)
    assert sorted(((r[0], r[2], r[5]) for r in got), key=repr) == sorted(
        [(3, "response", None), (4, "response", None), (5, "response", None), (5, "response", None), (6, "revisit", 5), (None, "response", None)],
        key=repr,
    )


def test_empty(spark):
    archives, got = run(spark, [])
    assert got == [] and archives.count() == 0


def packed(records, content=None):
    dictionary = zstandard.ZstdCompressionDict(content) if content else None
    packer = zstandard.ZstdCompressor(dict_data=dictionary)
    frame = b""
    if content:
        frame = warc.DICTIONARY_FRAME.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content
    return frame + b"".join(packer.compress(r) for r in records)


def test_dictionary_comes_from_the_leading_frame():
    records = [warc._record(n, "u", b"some shared words %d" % n, None, warc.DATE) for n in range(400)]
    content = zstandard.train_dictionary(4096, records).as_bytes()
    for data in (packed(records), packed(records, content), packed(records, content)[:]):
        assert list(warc.read_frames(io.BytesIO(data))) == records
    squeezed = zstandard.ZstdCompressor().compress(content)
    data = warc.DICTIONARY_FRAME.to_bytes(4, "little") + len(squeezed).to_bytes(4, "little") + squeezed
    data += packed(records, content)[8 + len(content) :]
    assert list(warc.read_frames(io.BytesIO(data))) == records
    with pytest.raises(ValueError, match="early"):
        list(warc.read_frames(io.BytesIO(packed(records, content)[:-3])))


@pytest.mark.parametrize(
    ("old", "new", "told"),
    [
        (b"WARC/1.1", b"WARC/0.9", "not a record"),
        (b"WARC-Date", b"X-Date", "missing"),
        (b"body", b"bo", "bytes"),
        (b"body", b"bodY", "digest"),
        (b"text/html; charset=utf-8\r\nContent-Length: 4", b"text/html; charset=utf-8\r\nContent-Length: 5", "length or digest"),
    ],
)
def test_broken_records(old, new, told):
    record = warc._record(1, "u", b"body", None, warc.DATE)
    assert warc.parse_record(record)["payload"] == b"body"
    with pytest.raises(ValueError, match=told):
        warc.parse_record(record.replace(old, new))


@pytest.mark.parametrize("page", [0, 1, -1, 2**63 - 1, -(2**63), 2**62])
def test_ids(page):
    assert warc.page_of(warc.record_id(page)) == page
