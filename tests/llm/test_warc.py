import gzip
import hashlib

import pytest

from attrition.llm import warc as w
from attrition.llm.queries import op4_warc

BIG = "<p>ä" + "x" * 150_000 + "\r\n\r\nWARC/1.1\r\n\r\n" + "€" * 40_000
DUP = "same page " * 200


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a/1", DUP, 5), (2, "http://a/2", DUP, 5), (3, None, DUP, 5), (4, "u\r\nX: y", BIG, 5),
        (5, "u", None, 5), (6, "u", "", 5), (7, "u", "small", 5), (8, "u", "small", 5), (None, "u", "no id " * 300, 5),
        (9, "u", "WARC/1.1\r\n\r\n", 5), (9, "u", "WARC/1.1\r\n\r\n", 5), (10, "u", BIG, 5), (10, "u", BIG, 5), (-3, "u", "y" * 4096, 5),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)


def test_round_trip(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(w, "FILE_RECORDS", 3)  # segments of a record fall into several files
    path = str(tmp_path / "a")
    w.write_archive(pages, path)
    got = sorted(
        ((r.page_id, r.record_type, r.to, r.payload_bytes, r.digest, bytes(r.payload))
         for r in w.read_archive(spark, path).withColumns({"page_id": w.page_id_of("record_id"), "to": w.page_id_of("refers_to")}).collect()),
        key=str,
    )
    keep = {DUP: 3, BIG: 10}
    want = []
    for r in pages.collect():
        data = (r.html or "").encode()
        to = keep.get(r.html)
        to = None if to == r.page_id else to
        want.append((r.page_id, "revisit" if to else "response", to, len(data), hashlib.sha1(data).hexdigest(), b"" if to else data))
    assert got == sorted(want, key=str)


def test_files_are_valid_warc(spark, pages, tmp_path):
    path = tmp_path / "a"
    w.write_archive(pages, str(path))
    kinds = []
    for f in path.glob("part-*.gz"):
        for h, block in w.parse_records(gzip.decompress(f.read_bytes())):
            assert len(block) <= w.SEGMENT and int(h[b"content-length"]) == len(block)
            assert {b"warc-type", b"warc-record-id", b"warc-date"} <= set(h)
            kinds.append(h[b"warc-type"])
    assert kinds.count(b"revisit") == 3 and kinds.count(b"continuation") > 6


def test_lost_segment_raises(spark):
    rows = [("a", "response", "u", "d", None, "a", 1, None, b"12"), ("a3", "continuation", "u", None, None, "a", 3, 6, b"56")]
    with pytest.raises(Exception, match="incomplete segments of a"):
        w.reassemble(spark.createDataFrame(rows, w.RECORD_SCHEMA)).collect()
    rows.append(("a2", "continuation", "u", None, None, "a", 2, None, b"34"))
    assert bytes(w.reassemble(spark.createDataFrame(rows, w.RECORD_SCHEMA)).first().block) == b"123456"
    short = [(*r[:7], 7 if r[7] else None, r[8]) for r in rows]
    with pytest.raises(Exception, match="incomplete"):
        w.reassemble(spark.createDataFrame(short, w.RECORD_SCHEMA)).collect()


def test_chunked_framing_and_gzip_members():
    assert w.decode_chunked(b"3;x=1\r\nabc\r\nA\r\n0123456789\r\n0\r\nT: 1\r\n\r\n") == b"abc0123456789"
    with pytest.raises(ValueError):
        w.decode_chunked(b"3\r\nabcd\r\n0\r\n\r\n")
    assert w.unzip(gzip.compress(b"one") + gzip.compress(b"two")) == b"onetwo"
    assert w.unzip(b"plain") == b"plain"


def test_empty_table(spark, pages, tmp_path):
    w.write_archive(pages.limit(0), str(tmp_path / "e"))
    assert w.read_archive(spark, str(tmp_path / "e")).collect() == []


def test_query_reads_every_page(spark):
    rows = op4_warc(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 50
