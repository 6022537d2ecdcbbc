"""WARC archives of web pages: writing, and reading back with segment reassembly.

Writing.  Every page becomes one HTTP response (chunked transfer framing) in a
``response`` record; of pages with equal payloads of at least
``REVISIT_BYTES`` bytes only that with the largest id keeps its payload, the
others are ``revisit`` records that name it.  A block longer than ``SEGMENT``
bytes is split into a first record and ``continuation`` records.  Records are
written by Spark's text sink (record separator CRLF CRLF, gzip), so any file
system that Spark writes to will do; ``FILE_RECORDS`` bounded records in a file
keep every file small enough to be read by one task.

Reading.  Files are parsed by the ``Content-Length`` of each record.  Whole
records are decoded where they are read; only records that were split are
shuffled: their segments are grouped by origin identifier, ordered by segment
number, joined, and checked against the total length.  A record whose segment
numbers have a gap or whose length differs raises an error.

Defined results: a null payload is an empty one; null ids and urls, repeated
rows and repeated ids are kept as records of their own; an empty table gives an
empty archive.  Equal payloads are told by SHA-256 beside the length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm.common import materialize

REVISIT_BYTES = 1000
SEGMENT = 32 << 10
HTTP_CHUNK = 4096
FILE_RECORDS = 2_000
BROADCAST_ROWS = 100_000  # duplicate groups (48 bytes each) up to here are broadcast
DATE = "1970-01-01T00:00:00Z"

CRLF = "\r\n"
END = b"\r\n\r\n"

RECORD_SCHEMA = (
    "record_id string, record_type string, uri string, digest string, refers_to string, "
    "origin string, segment int, total long, block binary"
)
PAGE_SCHEMA = (
    "record_id string, record_type string, uri string, digest string, refers_to string, "
    "payload binary, payload_bytes long"
)


def _page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")))


def _chunked(payload: str) -> str:
    """SQL for the chunked framing of a binary column (as a string of its raw bytes)."""
    piece = f"cast(substring({payload}, i * {HTTP_CHUNK} + 1, {HTTP_CHUNK}) as string)"
    frame = f"concat(lower(hex(octet_length({piece}))), '\\r\\n', {piece}, '\\r\\n')"
    count = f"cast(ceil(octet_length({payload}) / {HTTP_CHUNK}) as int)"
    frames = f"transform(if({count} > 0, sequence(0, {count} - 1), array()), i -> {frame})"
    return f"concat(array_join({frames}, ''), '0\\r\\n\\r\\n')"


def _segments(block: str) -> str:
    """SQL for the pieces of at most ``SEGMENT`` bytes of a binary column."""
    count = f"cast(ceil(octet_length({block}) / {SEGMENT}) as int)"
    return f"transform(sequence(0, {count} - 1), i -> substring({block}, i * {SEGMENT} + 1, {SEGMENT}))"


def duplicate_groups(pages: DataFrame) -> DataFrame:
    """``key, keep``: payloads that stand more than once, and the largest page id of each."""
    big = pages.where(F.octet_length("payload") >= REVISIT_BYTES)
    return big.groupBy("key").agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).where("n > 1").drop("n")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write ``pages`` as WARC files under ``path``."""
    df = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url_col), F.lit("urn:unknown")), "[\r\n]", " ").alias("uri"),
        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("key", F.sha2("payload", 256))
    groups = materialize(duplicate_groups(df), "warc-duplicates")
    if groups.count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    big = F.octet_length("payload") >= REVISIT_BYTES
    df = df.join(groups, "key", "left")
    revisit = big & F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    df = df.select(
        "uri",
        "payload",
        F.sha1("payload").alias("digest"),
        F.concat(_page_urn(F.col("page_id")), F.lit(":"), F.monotonically_increasing_id().cast("string"), F.lit(">")).alias("rid"),
        F.when(revisit, F.concat(_page_urn(F.col("keep")), F.lit(">"))).alias("target"),
    )
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"))
    block = F.when(
        F.col("target").isNotNull(),
        F.concat(head, F.lit("Content-Length: "), F.octet_length("payload").cast("string"), F.lit(CRLF * 2)),
    ).otherwise(F.concat(head, F.lit("Transfer-Encoding: chunked\r\n\r\n"), F.expr(_chunked("payload"))))
    df = df.select("uri", "digest", "rid", "target", block.cast("binary").alias("block"))
    df = df.select("uri", "digest", "rid", "target", F.octet_length("block").alias("total"), F.expr(_segments("block")).alias("parts"))
    df = df.select("uri", "digest", "rid", "target", "total", F.size("parts").alias("count"), F.posexplode("parts").alias("at", "part"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    first, split = F.col("at") == 0, F.col("count") > 1
    none = F.lit("")
    number = (F.col("at") + 1).cast("string")
    kind = F.when(~first, "continuation").when(F.col("target").isNotNull(), "revisit").otherwise("response")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        F.when(first, line("WARC-Record-ID", F.col("rid"))).otherwise(
            line("WARC-Record-ID", F.concat(F.expr("substring(rid, 1, length(rid) - 1)"), F.lit(":"), number, F.lit(">")))
        ),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.col("uri")),
        F.when(first, line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))).otherwise(none),
        F.when(F.col("target").isNotNull(), line("WARC-Refers-To", F.col("target"))).otherwise(none),
        F.when(F.col("target").isNotNull(), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(none),
        F.when(~first, line("WARC-Segment-Origin-ID", F.col("rid"))).otherwise(none),
        F.when(split, line("WARC-Segment-Number", number)).otherwise(none),
        F.when(split & (F.col("at") + 1 == F.col("count")), line("WARC-Segment-Total-Length", F.col("total").cast("string"))).otherwise(none),
        F.when(first, F.lit("Content-Type: application/http;msgtype=response\r\n")).otherwise(none),
        line("Content-Length", F.octet_length("part").cast("string")),
        F.lit(CRLF),
        F.col("part").cast("string"),
    )
    options = {"lineSep": CRLF * 2, "compression": "gzip", "maxRecordsPerFile": str(FILE_RECORDS)}
    df.select(record.alias("value")).write.options(**options).text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Headers (lower-case names) and block of every record of an uncompressed file."""
    at, n = 0, len(data)
    while at < n:
        stop = data.find(END, at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at} of {n}")
        headers = {}
        for field in data[at:stop].split(b"\r\n")[1:]:
            name, _, value = field.partition(b":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers[b"content-length"])
        begin = stop + len(END)
        end = begin + size
        if data[end : end + len(END)] != END:
            raise ValueError(f"record at byte {at} does not end after its content length")
        yield headers, data[begin:end]
        at = end + len(END)


def unzip(data: bytes) -> bytes:
    """Contents of a gzip file of one or more members; other bytes are taken as they are."""
    import zlib

    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out)


def decode_chunked(body: bytes) -> bytes:
    """Payload of a body in chunked transfer framing (extensions and trailers are skipped)."""
    out, at = [], 0
    while True:
        stop = body.index(b"\r\n", at)
        size = int(body[at:stop].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        begin = stop + 2
        if body[begin + size : begin + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end after its size")
        out.append(body[begin : begin + size])
        at = begin + size + 2


def http_payload(block: bytes) -> tuple[bytes, int]:
    """Payload of an HTTP response, and its length by the headers where the payload is left out."""
    head, _, body = block.partition(END)
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if headers.get(b"transfer-encoding", b"").lower() == b"chunked":
        body = decode_chunked(body)
        return body, len(body)
    return body, int(headers.get(b"content-length", len(body)))


def _text(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace")


def _digest(value: bytes | None) -> str | None:
    return None if value is None else value.rpartition(b":")[2].decode()


def _page_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Decoded pages from (record_id, type, uri, digest, refers_to, block)."""
    payloads = [http_payload(r[5]) for r in rows]
    cols = [pa.array([r[k] for r in rows], pa.string()) for k in range(5)]
    cols += [pa.array([p for p, _ in payloads], pa.binary()), pa.array([n for _, n in payloads], pa.int64())]
    return pa.RecordBatch.from_arrays(cols, names=["record_id", "record_type", "uri", "digest", "refers_to", "payload", "payload_bytes"])


OUT_BYTES = 4 << 20


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of the records that were not split."""
    for batch in batches:
        for content in batch.column(0):
            rows, size = [], 0
            for h, block in parse_records(unzip(content.as_py())):
                if b"warc-segment-number" in h or h[b"warc-type"] not in (b"response", b"revisit"):
                    continue
                rows.append(
                    (
                        _text(h[b"warc-record-id"]), _text(h[b"warc-type"]), _text(h.get(b"warc-target-uri")),
                        _digest(h.get(b"warc-payload-digest")), _text(h.get(b"warc-refers-to")), block,
                    )
                )
                size += len(block)
                if size > OUT_BYTES:
                    yield _page_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _page_batch(rows)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the records that were split."""
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for h, block in parse_records(unzip(content.as_py())):
                if b"warc-segment-number" not in h:
                    continue
                rid = _text(h[b"warc-record-id"])
                total = h.get(b"warc-segment-total-length")
                rows.append(
                    (
                        rid, _text(h[b"warc-type"]), _text(h.get(b"warc-target-uri")), _digest(h.get(b"warc-payload-digest")),
                        _text(h.get(b"warc-refers-to")), _text(h.get(b"warc-segment-origin-id")) or rid,
                        int(h[b"warc-segment-number"]), None if total is None else int(total), block,
                    )
                )
            for k in range(0, len(rows), 128):
                part = rows[k : k + 128]
                kinds = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in part], t) for j, t in enumerate(kinds)], names=names)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for k in range(0, len(rows), 64):
            yield _page_batch(rows[k : k + 64])


def reassemble(segments: DataFrame) -> DataFrame:
    """Whole records from segments: group by origin, order by number, check numbers and length."""
    first = F.col("segment") == 1

    def of_first(name: str) -> Column:
        return F.max(F.when(first, F.col(name))).alias(name)

    one = segments.groupBy("origin").agg(
        *(of_first(c) for c in ("record_type", "uri", "digest", "refers_to")),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total").alias("total"),
    )
    block = F.expr("cast(array_join(transform(parts, p -> cast(p.block as string)), '') as binary)")
    numbers = F.expr("transform(parts, p -> p.segment) = sequence(1, size(parts))")
    one = one.withColumn("block", block)
    good = numbers & (F.octet_length("block") == F.col("total"))
    problem = F.concat(F.lit("incomplete segments of "), "origin")
    checked = F.when(F.coalesce(good, F.lit(False)), F.col("block")).otherwise(F.raise_error(problem).cast("binary"))
    return one.select(F.col("origin").alias("record_id"), "record_type", "uri", "digest", "refers_to", checked.alias("block"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every page of the archive: record id, type, uri, stated digest, refers_to, payload and its full length.

    The payload of a revisit is empty; ``payload_bytes`` is the length of the payload it stands for.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    whole = files.mapInArrow(_whole, PAGE_SCHEMA)
    joined = reassemble(files.mapInArrow(_split, RECORD_SCHEMA)).mapInArrow(_decode, PAGE_SCHEMA)
    return whole.unionByName(joined)


def page_id_of(urn: str) -> Column:
    """The page id inside a record identifier of :func:`write_archive` (null for a null id)."""
    return F.nullif(F.regexp_extract(urn, r"<urn:page:(-?\d+)", 1), F.lit("")).cast("long")
