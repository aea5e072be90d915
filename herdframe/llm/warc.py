"""WARC archives: one response or revisit record per page, cut into segments, and their reassembly."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from herdframe.session import cut_lineage, fresh_path

CRLF = "\r\n"
CHUNK_BYTES = 4096
SEGMENT_BYTES = 16384
RECORDS_PER_FILE = 4096
LEAST_REVISIT_BYTES = 1000

# Fixed values of the formats (WARC 1.1, HTTP/1.1).
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Transfer-Encoding: chunked{CRLF}{CRLF}"

_RECORD = pa.schema(
    [
        ("record_id", pa.string()), ("warc_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.string()),
        ("digest", pa.string()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()),
    ]
)
_RECORD_SQL = "record_id string, warc_type string, page_id long, refers_to string, digest string, origin string, segment int, total long, block binary"


def _raw(text: str | Column) -> Column:
    return (F.lit(text) if isinstance(text, str) else text).cast("binary")


def _bytes(*parts: Column) -> Column:
    return F.concat(*parts)


def _identity(page: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"), digest, F.lit(">"))


def _head(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field whose value is null is left out."""
    lines = [F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))) for name, value in fields]
    return F.concat(F.lit(_VERSION + CRLF), *[F.coalesce(x, F.lit("")) for x in lines])


def plan_records(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest (SHA-1, hex) and original: the largest page_id with an equal payload of at least ``least`` bytes.

    The largest id of each digest is an aggregate joined back, so a payload shared by a third of all pages is no
    large group. Null html is empty; a page without an id is always a response.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    large = F.octet_length("payload") >= least
    top = rows.filter(large).groupBy("digest").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
    top = top.filter("n > 1").drop("n")
    joined = rows.join(top, "digest", "left")
    return joined.withColumn("original", F.when(large & F.col("page_id").isNotNull(), F.coalesce("original", "page_id")).otherwise(F.col("page_id")))


def _joined(parts: Column) -> Column:
    """The bytes of a list put together in one pass; strings of Spark hold any bytes."""
    return F.array_join(F.transform(parts, lambda x: x.cast("string")), "").cast("binary")


def _cut(data: Column, last: Column, size: int) -> Column:
    """Pieces 0 to ``last`` of ``size`` bytes. The data are bound once: a piece costs its own bytes, not those of the whole."""
    return F.transform(F.array(data), lambda d: F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(d, k * size + 1, F.lit(size))))[0]


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, least: int = LEAST_REVISIT_BYTES) -> None:
    """Write gzipped WARC files with one record per page; blocks over ``segment_bytes`` continue in further records.

    A response block is an HTTP message with the payload in chunks of ``CHUNK_BYTES``. A revisit has no payload. Records end
    with two line ends, which is the line separator of the text writer, so the files hold nothing else. Control characters in
    an address are replaced, so an address cannot start a new header line.
    """
    rows = plan_records(pages, least)
    revisit = F.col("page_id") != F.col("original")
    count = F.ceil(F.octet_length("payload") / CHUNK_BYTES).cast("int")
    chunk = lambda x: _bytes(_raw(F.lower(F.hex(F.octet_length(x)))), _raw(CRLF), x, _raw(CRLF))
    chunks = F.when(count > 0, F.transform(_cut(F.col("payload"), count - 1, CHUNK_BYTES), chunk)).otherwise(F.array().cast("array<binary>"))
    body = _joined(chunks)
    block = F.when(revisit, _raw(f"HTTP/1.1 200 OK{CRLF}{CRLF}")).otherwise(_bytes(_raw(_HTTP_HEAD), body, _raw(f"0{CRLF}{CRLF}")))
    whole = rows.select(
        _identity(F.col("page_id"), F.col("digest")).alias("id"), "page_id", "digest", "original", revisit.alias("revisit"),
        F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20").alias("url"), block.alias("block"),
    )
    last = F.greatest(F.ceil(F.octet_length("block") / segment_bytes), F.lit(1)).cast("int") - 1
    # a segment's row has its own bytes only
    sized = whole.select("*", last.alias("last"), F.octet_length("block").alias("total"), _cut(F.col("block"), last, segment_bytes).alias("cut")).drop("block")
    parts = sized.select(*[c for c in sized.columns if c != "cut"], F.posexplode("cut").alias("k", "part"))
    part = F.col("part")
    first, several = F.col("k") == 0, F.col("last") > 0
    head = _head(
        ("WARC-Type", F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response")),
        ("WARC-Record-ID", F.when(first, F.col("id")).otherwise(F.concat(F.rtrim(F.col("id"), F.lit(">")), F.lit(":"), F.col("k") + 1, F.lit(">")))),
        ("WARC-Date", F.lit("2024-01-01T00:00:00Z")),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Page-ID", F.when(first, F.col("page_id"))),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        ("WARC-Profile", F.when(first & F.col("revisit"), F.lit(_PROFILE))),
        ("WARC-Refers-To", F.when(first & F.col("revisit"), _identity(F.col("original"), F.col("digest")))),
        ("WARC-Segment-Number", F.when(several, F.col("k") + 1)),
        ("WARC-Segment-Origin-ID", F.when(~first, F.col("id"))),
        ("WARC-Segment-Total-Length", F.when(several & (F.col("k") == F.col("last")), F.col("total"))),
        ("Content-Type", F.when(first, F.lit("application/http;msgtype=response"))),
        ("Content-Length", F.octet_length(part)),
    )
    record = _bytes(_raw(head), _raw(CRLF), part).cast("string")
    writer = parts.select(record.alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _inflate(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, piece by piece; other data as it is."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    view = memoryview(data)
    unzip, at = zlib.decompressobj(31), 0
    while at < len(view) or unzip.unused_data:
        piece = unzip.unused_data + bytes(view[at : at + step]) if unzip.eof else bytes(view[at : at + step])
        at += step
        if unzip.eof:
            unzip = zlib.decompressobj(31)
        yield unzip.decompress(piece)


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of one file. A record that breaks off is an error."""
    held = b""
    pieces = iter(pieces)

    def more() -> bool:
        nonlocal held
        piece = next(pieces, None)
        held += piece or b""
        return piece is not None

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("the archive ends inside a record's header")
                return
        lines = held[:end].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length, start = int(fields["content-length"]), end + 4
        while len(held) < start + length + 4:
            if not more():
                raise ValueError("the archive ends inside a record's block")
        yield fields, held[start : start + length]
        held = held[start + length + 4 :]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records of the WARC files below a folder: record_id, warc_type, page_id, refers_to, digest, origin, segment, total, block.

    A file is read by one task and unzipped piece by piece. ``segment`` is null for a record in one piece.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for f, block in parse_records(_inflate(data.as_py())):
                    number = lambda name, f=f: int(f[name]) if name in f else None
                    digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    rows.append(
                        (f["warc-record-id"], f["warc-type"], number("warc-page-id"), f.get("warc-refers-to"), digest,
                         f.get("warc-segment-origin-id", f["warc-record-id"]), number("warc-segment-number"), number("warc-segment-total-length"), block)
                    )
                    held += len(block)
                    if held > 4 << 20:
                        yield _rows(rows, _RECORD)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows, _RECORD)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(read, _RECORD_SQL)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: segments are grouped by the origin's id, ordered by their number and checked against the total length.

    Records without a segment number pass as they are, without a shuffle. Repeated segments of repeated rows are counted first, so each
    origin has one row per number; the whole record comes out as often as its first segment was there. A missing
    segment or a wrong length raises an error.
    """
    cols = ["record_id", "warc_type", "page_id", "refers_to", "digest"]
    alone = records.filter("segment is null").select(*cols, "block")
    parts = records.filter("segment is not null").groupBy("origin", "segment")
    parts = parts.agg(F.count(F.lit(1)).alias("copies"), F.first("total", ignorenulls=True).alias("total"), F.first("block").alias("block"), *[F.first(c, ignorenulls=True).alias(c) for c in ("warc_type", "page_id", "refers_to", "digest")])
    own = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    whole = parts.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"), F.max("segment").alias("n"),
        *[own(c) for c in ("warc_type", "page_id", "refers_to", "digest", "copies")],
    )
    block = _joined(F.col("parts")["block"])
    whole = whole.select(F.col("origin").alias("record_id"), "warc_type", "page_id", "refers_to", "digest", block.alias("block"), "total", "copies", (F.size("parts") == F.col("n")).alias("full"))
    ok = F.col("full") & (F.octet_length("block") == F.col("total")) & F.col("copies").isNotNull()
    checked = F.when(ok, F.col("block")).otherwise(F.raise_error(F.concat(F.lit("segments missing or of wrong length: "), F.col("record_id"))).cast("binary"))
    whole = whole.withColumn("block", checked).withColumn("copies", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return alone.unionByName(whole.select(*cols, "block"))


def decode_chunks(data: bytes) -> bytes:
    """The payload of a body in chunked transfer framing. Extensions and trailers are skipped; anything else raises an error."""
    out, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        out.append(data[at : at + size])
        if len(out[-1]) != size or data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("broken chunk")
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    chunked = re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked\b", head)
    return decode_chunks(body) if chunked else body


def payloads(records: DataFrame) -> DataFrame:
    """page_id, record_id, warc_type, refers_to, digest, payload of whole records; a response whose payload does not have its digest raises an error."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                payload = http_payload(r["block"])
                if r["warc_type"] == "response" and hashlib.sha1(payload).hexdigest() != r["digest"]:
                    raise ValueError(f"wrong payload digest in {r['record_id']}")
                rows.append((r["page_id"], r["record_id"], r["warc_type"], r["refers_to"], r["digest"], payload))
            if rows:
                yield _rows(rows, schema)

    schema = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("warc_type", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("payload", pa.binary())])
    return records.mapInArrow(decode, T.StructType.fromDDL("page_id long, record_id string, warc_type string, refers_to string, digest string, payload binary"))


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files, read them back and return one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to (page_id of the response for revisits). Null html is an empty
    payload; repeated rows are records of their own; rows with equal page_id and payload are all responses; pages without an id are
    responses; an empty table gives an empty result; other columns are ignored. The payload length of a revisit is
    that of the response it refers to, as read back; if that is missing from the archives it is null.
    """
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    write_archives(pages, path)
    read = payloads(reassemble(read_archives(spark, path)))
    facts = read.select("page_id", "record_id", "warc_type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("bytes"))
    facts = cut_lineage(facts)
    originals = facts.filter("warc_type = 'response' and page_id is not null").groupBy("record_id").agg(F.max("page_id").alias("to_page"), F.max("bytes").alias("to_bytes"))
    revisits = facts.filter("warc_type = 'revisit'").drop("record_id").join(originals, F.col("refers_to") == F.col("record_id"), "left")
    shape = lambda bytes_, to: ["page_id", bytes_.alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("warc_type").alias("record_type"), to.alias("refers_to")]
    return facts.filter("warc_type = 'response'").select(*shape(F.col("bytes"), F.lit(None).cast("long"))).unionByName(revisits.select(*shape(F.col("to_bytes"), F.col("to_page"))))
