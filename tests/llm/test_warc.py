import gzip
import hashlib

import pytest

from gatewright.llm import warc as op
from gatewright.llm.files import reading, shared_uri

SCHEMA = "page_id BIGINT, url STRING, html STRING, payload STRING, n INT"
LONG = "<p>" + "é" * 80


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


ROWS = [
    (5, "http://a/5", LONG),
    (3, "http://a/3", LONG),
    (9, None, LONG),
    (None, "http://a/n", LONG),
    (4, "http://a/\r\n4", "short"),
    (6, "u", "short"),
    (7, "u", None),
    (8, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\n" * 20),
    (10, "u", "x" * 3_000_000),
]


def test_records_come_back(spark):
    found = {r.page_id: r for r in op.archive_pages(spark, pages(spark, ROWS)).collect()}
    assert len(found) == len(ROWS)
    for page_id, url, html in ROWS:
        data = (html or "").encode()
        r = found[page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        revisit = html == LONG and page_id != 3
        assert (r.record_type, r.refers_to) == (("revisit", 3) if revisit else ("response", None))
        assert (r.payload is None) if revisit else (bytes(r.payload) == data)
        assert r.url == (url.replace("\r", "%0D").replace("\n", "%0A") if url else None)


def test_raw_is_one_stream_and_members_stand_alone(spark):
    folder = shared_uri(spark, "test-warc")
    raw = op.write_archives(op.record_types(pages(spark, ROWS)).coalesce(1), folder, archive_bytes=1000)
    assert raw.count() > 1
    files = op.normalise(raw, folder)
    assert raw.agg({"records": "sum"}).first()[0] == files.agg({"records": "sum"}).first()[0] == len(ROWS)
    for r in files.collect():
        with reading(r.uri) as file:
            data = file.read()
        index = op.read_index(r.uri)
        assert sum(i[1] for i in index) == len(data)
        for offset, length, *_ in index:
            assert gzip.decompress(data[offset : offset + length]).startswith(b"WARC/1.1\r\n")


def test_stream_of_many_members_is_inflated_too(spark, tmp_path):
    path = tmp_path / "many.warc.gz"
    records = [op.render(i, "u", b"x" * i, "d", i, None) for i in range(50)]
    path.write_bytes(b"".join(gzip.compress(r) for r in records))
    assert [r for _, r in op.split_records(op.inflated(f"file://{path}"))] == records
    path.write_bytes(gzip.compress(records[3])[:-12] + b"")
    with pytest.raises(ValueError):
        list(op.split_records(iter([records[3][:-1]])))


def test_empty_and_repeated(spark):
    assert op.archive_pages(spark, pages(spark, [])).count() == 0
    rows = op.archive_pages(spark, pages(spark, [(1, "u", LONG), (1, "u", LONG), (2, "u", LONG)])).collect()
    assert sorted((r.page_id, r.record_type) for r in rows) == [(1, "response"), (1, "response"), (2, "revisit")]
