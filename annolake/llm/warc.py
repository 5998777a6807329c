"""WARC archives of web pages: segmented, chunk-framed writing and reassembly on reading.

A page becomes an HTTP response with chunked transfer framing inside a WARC ``response`` record.  A
block longer than ``SEGMENT_BYTES`` is cut: the first segment is the response record (segment
number 1), the rest are ``continuation`` records that name its id as origin, and the last states
the total length.  Pages whose payload equals another's become ``revisit`` records.

Files are written by Spark's text writer with CRLFCRLF, the end of a WARC record, as the line end.
Reading parses files in parallel, groups continuation records by origin, orders them by segment
number, verifies the total length and the payload digest, and decodes the chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.llm.common import join_keys, table
from annolake.session import staging_path

#: Payloads of at least this many bytes are written once.
REVISIT_BYTES = 1000
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
#: Records of a file at most: with the segment size it bounds what one reader holds.
FILE_RECORDS = 2000
#: Output batches of the Python sides.
BATCH_BYTES = 4 << 20

# Fixed values of the format.
VERSION = "WARC/1.1"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

RECORD = "origin string, kind string, number int, total long, page_id long, refers_to long, digest string, block binary"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunk-framed body; raises ``ValueError`` on broken framing."""
    at, parts = 0, []
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        piece = body[end + 2 : end + 2 + size]
        if len(piece) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("broken chunk")
        parts.append(piece)
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _head(fields: list[tuple[str, object]]) -> bytes:
    lines = [VERSION, *(f"{name}: {value}" for name, value in fields if value is not None)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def page_records(
    record: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> Iterator[bytes]:
    """The WARC records of one page, without the CRLFCRLF that ends each."""
    common = [
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else " ".join(url.split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Page-ID", page_id),
    ]
    if refers_to is not None:
        kind = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<urn:uuid:{record}>"), ("WARC-Profile", PROFILE)]
        yield _head([*kind, *common, ("Refers-To-Page-ID", refers_to), ("Content-Length", 0)])
        return
    block = HTTP_HEAD + chunked(payload)
    count = -(-len(block) // SEGMENT_BYTES)
    for number in range(1, count + 1):
        piece = block[(number - 1) * SEGMENT_BYTES : number * SEGMENT_BYTES]
        fields: list[tuple[str, object]] = [
            ("WARC-Type", "response" if number == 1 else "continuation"),
            ("WARC-Record-ID", f"<urn:uuid:{record}>" if number == 1 else f"<urn:uuid:{record}:{number}>"),
            ("WARC-Segment-Number", number if count > 1 else None),
            ("WARC-Segment-Origin-ID", f"<urn:uuid:{record}>" if number > 1 else None),
            ("WARC-Segment-Total-Length", len(block) if number == count > 1 else None),
        ]
        yield _head([*fields, *(common if number == 1 else []), ("Content-Length", len(piece))]) + piece


def _batched(values: Iterator[tuple[bytes, ...]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of about BATCH_BYTES (the last column is the large one)."""
    rows, held = [], 0
    for row in values:
        rows.append(row)
        held += 200 + len(row[-1] or b"")
        if held >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
            )
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
        )


def _write_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[tuple[bytes]]:
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                for record in page_records(*row):
                    yield (record,)

    return _batched(records(), pa.schema([("value", pa.binary())]))


def write_archive(pages: DataFrame, path: str, payload: str = "html", least: int = REVISIT_BYTES) -> str:
    """Write a record per row of ``pages`` (``page_id``, ``url`` and the payload column) below ``path``.

    Of rows with equal payloads of at least ``least`` bytes that with the largest page id is the
    response and the others revisit it; rows that repeat that id stay responses.  A null payload is
    empty.  A row without a page id is a response that nothing revisits.  Other columns are not
    read; an empty table gives an archive without records.  Only digests are grouped, so a
    payload shared by a third of all pages is a count, not a group of pages.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), body.alias("payload"))
    marked = rows.withColumn("digest", F.sha1("payload"))
    large = marked.filter((F.length("payload") >= least) & F.col("page_id").isNotNull()).select("page_id", "digest")
    kept = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("_n"))
    revisits = (
        large.join(kept.filter("_n > 1").drop("_n"), "digest").filter("page_id < refers_to").dropDuplicates(["page_id", "digest"])
    )
    records = join_keys(marked, revisits, ["page_id", "digest"]).select(
        F.uuid().alias("record"),
        "page_id",
        "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"),
        "digest",
        "refers_to",
    )
    lines = records.mapInArrow(_write_batches, "value binary").select(F.col("value").cast("string"))
    writer = lines.write.option("lineSep", END.decode()).option("compression", "gzip")
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(path)
    return path


def parse(archive: bytes) -> Iterator[tuple]:
    """Rows of ``RECORD`` from the bytes of one (uncompressed) archive."""
    at = 0
    while at < len(archive):
        end = archive.index(END, at)
        lines = archive[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
        size = int(fields["content-length"])
        block = archive[end + 4 : end + 4 + size]
        if len(block) != size or archive[end + 4 + size : end + 8 + size] != END:
            raise ValueError(f"the record at byte {at} is cut short")
        whole = lambda name: int(fields[name]) if name in fields else None  # noqa: B023, E731
        yield (
            fields.get("warc-segment-origin-id", fields["warc-record-id"]),
            fields["warc-type"],
            whole("warc-segment-number"),
            whole("warc-segment-total-length"),
            whole("page-id"),
            whole("refers-to-page-id"),
            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            block,
        )
        at = end + 8 + size


_RECORD_ARROW = pa.schema(
    [
        ("origin", pa.string()), ("kind", pa.string()), ("number", pa.int32()), ("total", pa.int64()),
        ("page_id", pa.int64()), ("refers_to", pa.int64()), ("digest", pa.string()), ("block", pa.binary()),
    ]
)


def _parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                yield from parse(zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data)

    return _batched(rows(), _RECORD_ARROW)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record (segment) of the archives below ``path``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parse_files, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: segments grouped by origin, in the order of their numbers.

    ``problem`` is null for a sound record, else ``missing segment`` (numbers are not 1 to n, once
    each, or no segment states the total) or ``wrong length``.  The first segment gives the fields.  A
    group is one record, which has to become one value anyway; whole records are not shuffled.
    """
    single = records.filter(F.col("number").isNull()).withColumn("problem", F.lit(None).cast("string"))
    cut = records.filter(F.col("number").isNotNull()).groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("_parts"),
        F.max("total").alias("total"),
        *[F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("kind", "page_id", "refers_to", "digest")],
    )
    numbers = F.col("_parts")["number"]
    length = F.aggregate("_parts", F.lit(0).cast("long"), lambda sum_, part: sum_ + F.length(part["block"]))
    gapless = numbers == F.sequence(F.lit(1), F.greatest(F.size("_parts"), F.lit(1)))
    whole = F.aggregate("_parts", F.lit(b""), lambda all_, part: F.concat(all_, part["block"]))
    joined = cut.select(
        "origin",
        "kind",
        F.lit(None).cast("int").alias("number"),
        "total",
        "page_id",
        "refers_to",
        "digest",
        whole.alias("block"),
        F.when(F.col("total").isNull() | ~gapless, "missing segment")
        .when(length != F.col("total"), "wrong length")
        .alias("problem"),
    )
    return single.unionByName(joined)


_PAGE_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("kind", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("problem", pa.string()), ("payload", pa.binary()),
    ]
)


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        names = ["page_id", "kind", "refers_to", "digest", "block", "problem"]
        for batch in batches:
            for page_id, kind, refers, digest, block, problem in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                payload = None
                if kind == "response" and problem is None:
                    try:
                        payload = payload_of(block)
                    except ValueError:
                        problem = "broken framing"
                    else:
                        found = hashlib.sha1(payload).hexdigest()
                        problem = None if digest in (None, found) else "wrong digest"
                        digest = found
                yield page_id, kind, refers, digest, None if payload is None else len(payload), problem, payload

    return _batched(rows(), _PAGE_ARROW)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, kind, refers_to, payload_digest, payload_bytes, problem, payload`` per page of the archives.

    A revisit has no payload of its own; its digest is the one it states.  Broken records are kept,
    with what is wrong in ``problem``.
    """
    whole = reassemble(read_records(spark, path))
    schema = (
        "page_id long, kind string, refers_to long, payload_digest string, payload_bytes long, "
        "problem string, payload binary"
    )
    return whole.mapInArrow(_decode_batches, schema)


def op1_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_archive(table(spark, sf_dir, "pages"), staging_path(spark, "warc"))
    pages = read_pages(spark, path).drop("payload")
    responses = (
        pages.filter("kind = 'response'")
        .select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("_bytes"))
        .dropDuplicates(["refers_to", "payload_digest"])
    )
    return pages.join(responses, ["refers_to", "payload_digest"], "left").select(
        "page_id",
        F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        "payload_digest",
        F.col("kind").alias("record_type"),
        "refers_to",
        "problem",
    )


ORACLE = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), k AS (
  SELECT payload_digest, max(page_id) AS keep FROM p WHERE payload_bytes >= 1000 GROUP BY 1
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN k.keep > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.keep > p.page_id THEN k.keep END AS refers_to,
       CAST(NULL AS VARCHAR) AS problem
FROM p LEFT JOIN k ON k.payload_digest = p.payload_digest AND p.payload_bytes >= 1000
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_warc_segments": op1_warc_segments}
ORACLES: dict[str, str] = {"op1_warc_segments": ORACLE}
