"""Archives: exact round trips and what the format demands."""

import hashlib
import zlib

import pytest

from herdframe.llm import warc

PAGES = "page_id long, url string, html string, digest string, block string, copies int"


def brute(rows):
    out = []
    data = [(p, (h or "").encode()) for p, _, h in rows]
    for p, b in data:
        equal = [q for q, c in data if c == b and q is not None]
        top = max(equal, default=None)
        revisit = len(b) >= 1000 and p is not None and top is not None and top != p
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], PAGES)


@pytest.fixture(scope="module")
def rows():
    big = "<p>ä\r\n\r\nWARC/1.1\r\n</p>" * 4000
    return [
        (1, "http://a/1", "<html>a</html>"), (2, "http://a/2", "<html>a</html>"), (3, "http://a/3", "x" * 1000), (4, "http://a/4\r\nWARC-Type: warcinfo", "x" * 1000),
        (5, None, "x" * 999), (6, "u", "x" * 999), (7, "u", None), (8, "u", ""), (9, "u", big), (10, "u", big), (11, "u", big + "!"), (11, "u", big + "!"),
        (None, "u", big), (None, "u", "short"), (12, "u", "0\r\n\r\n" * 500), (13, "u", "€" * 4096),
    ]


def test_pages_come_back(spark, rows):
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_pages(make(spark, rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_payloads_and_segments(spark, rows, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(make(spark, rows), path, segment_bytes=1000)
    records = warc.read_archives(spark, path).cache()
    assert records.filter("warc_type = 'continuation'").count() > 50
    assert records.filter("segment > 1 and origin = record_id").count() == 0
    got = warc.payloads(warc.reassemble(records)).filter("warc_type = 'response'").collect()
    want = {(r[0], (r[2] or "").encode()) for r in rows}
    assert {(r.page_id, bytes(r.payload)) for r in got} <= want
    assert {hashlib.sha1(bytes(r.payload)).hexdigest() for r in got} == {hashlib.sha1(b).hexdigest() for _, b in want}


def test_lost_segment_is_an_error(spark, rows, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(make(spark, rows[8:9]), path, segment_bytes=1000)
    with pytest.raises(Exception, match="segments missing"):
        warc.reassemble(warc.read_archives(spark, path).filter("coalesce(segment, 0) <> 3")).collect()


def test_empty_table(spark):
    assert warc.archive_pages(make(spark, [])).count() == 0


def test_parser_reads_pieces_of_any_size():
    record = b"WARC/1.1\r\nWARC-Record-ID: <a>\r\nContent-Length: 7\r\n\r\nab\r\n\r\nc\r\n\r\n"
    data = record * 3
    for step in (1, 5, 1000):
        pieces = (data[i : i + step] for i in range(0, len(data), step))
        assert [b for _, b in warc.parse_records(pieces)] == [b"ab\r\n\r\nc"] * 3
    members = b"".join(zlib.compress(record, wbits=31) for _ in range(3))
    assert b"".join(warc._inflate(members, 10)) == data
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse_records(iter([data[:-8]])))


def test_chunks():
    assert warc.decode_chunks(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError, match="broken"):
        warc.decode_chunks(b"3\r\nab\r\n0\r\n\r\n")


def test_a_large_page_of_many_segments(spark):
    big = "".join(f"<p>{i}é</p>" for i in range(400_000))
    got = warc.archive_pages(make(spark, [(1, "u", big), (2, "u", big)])).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type) for r in got) == [(1, len(big.encode()), "revisit"), (2, len(big.encode()), "response")]
