"""WARC archives: records cut into segments, read back and put together again.

Writing. Each page becomes a record. Of pages with equal payloads of at least
``MIN_REVISIT`` bytes the one with the largest ``page_id`` is a ``response``, the
others are ``revisit`` records that refer to it by its address and date (and by its
``page_id``, in a field of our own) and carry no payload. A response
holds an HTTP message in chunked transfer framing; a block longer than
``segment_bytes`` is cut into segments, the first with number 1, the rest as
``continuation`` records with the origin's identifier, the last with the total
length. A file holds at most ``FILE_RECORDS`` records, each of bounded size, so a file
fits in a task; Spark's text writer ends each record with the two line breaks that the
format asks for, so files go wherever Spark can write.

Reading. Files are parsed record by record. Whole records are decoded where they are;
segments are grouped by origin identifier, ordered by number, checked for gaps and
against the total length, joined, and their chunked framing decoded. Only segments are
shuffled, and a group is one page's payload.

Cases: a null html is an empty payload. A null ``page_id`` or ``url`` stays null; pages
that all lack an id never revisit each other. Repeated rows get a record each; if they
share the largest id, each is a response. An empty table gives an archive without
records. Other columns are ignored. A segment that is missing, repeated or cut short
raises an error that names the record.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.arrow import map_slices, slices
from skyledger.sources.scratch import materialize, scratch_root

MIN_REVISIT = 1000
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4096
FILE_RECORDS = 4096
DATE = "2000-01-01T00:00:00Z"
CRLF = b"\r\n"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def chunked(data: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``data`` in HTTP/1.1 chunked transfer framing."""
    parts = []
    for at in range(0, len(data), size):
        chunk = data[at : at + size]
        parts += [b"%x" % len(chunk), CRLF, chunk, CRLF]
    return b"".join([*parts, b"0", CRLF, CRLF])


def unchunked(data: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = data.index(CRLF, at)
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        chunk = data[at : at + size]
        if len(chunk) != size or data[at + size : at + size + 2] != CRLF:
            raise ValueError("a chunk is cut short")
        out.append(chunk)
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP message."""
    head, _, body = block.partition(CRLF + CRLF)
    if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head):
        return unchunked(body)
    return body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line breaks that end it."""
    lines = [VERSION]
    for name, value in [*fields, ("Content-Length", len(block))]:
        if value is not None:
            clean = re.sub(r"[\r\n]+", " ", str(value))
            lines.append(f"{name}: {clean}".encode())
    return CRLF.join(lines) + CRLF + CRLF + block


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, names in lower case, and block of each record of a file."""
    at = 0
    while at < len(data):
        end = data.index(CRLF + CRLF, at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in lines:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        start = end + 4
        at = start + int(fields["content-length"])
        block = data[start:at]
        if data[at : at + 4] != CRLF + CRLF:
            raise ValueError(f"a record is cut short: {fields.get('warc-record-id')}")
        at += 4
        yield fields, block


def _referred(pages: DataFrame) -> DataFrame:
    """Pages with digest, size and ``refers_to``: null for those that are responses."""
    keyed = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).select(
        "*",
        F.sha1("payload").alias("digest"),
        F.octet_length("payload").cast("long").alias("size"),
    )
    # Only digests are shuffled here, after a partial count in each task.
    shared = materialize(
        keyed.where(F.col("size") >= MIN_REVISIT)
        .groupBy("digest", "size")
        .agg(
            F.count("page_id").alias("_n"),
            F.max("page_id").alias("_last"),
            F.max_by("url", "page_id").alias("refers_url"),
        )
        .where("_n > 1")
        .drop("_n"),
        "warc-shared",
    )
    refers = F.when(F.col("page_id") != F.col("_last"), F.col("_last"))
    return keyed.join(shared, ["digest", "size"], "left").select(
        "page_id", "url", "payload", "digest", "size", refers.alias("refers_to"), "refers_url"
    )


def write_archive(
    pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES
) -> None:
    """Write a record for each row of ``page_id``, ``url``, ``html``."""
    schema = pa.schema([("record", pa.binary())])

    def make():
        task, count = TaskContext.get().partitionId(), 0

        def apply(part):
            nonlocal count
            out = []
            for page_id, url, payload, digest, size, refers_to, refers_url in zip(
                *(c.to_pylist() for c in part.columns)
            ):
                # The same on a retry: it follows from the split and the place in it.
                name = uuid.uuid5(uuid.NAMESPACE_URL, f"{task}/{count}/{page_id}")
                count += 1
                ident = f"<urn:uuid:{name}>"
                about = [
                    ("WARC-Target-URI", url),
                    ("WARC-Date", DATE),
                    ("WARC-Payload-Digest", f"sha1:{digest}"),
                    ("X-Page-Id", page_id),
                    ("X-Payload-Length", size),
                ]
                if refers_to is not None:
                    fields = [
                        ("WARC-Type", "revisit"),
                        ("WARC-Record-ID", ident),
                        *about,
                        ("WARC-Profile", PROFILE),
                        ("WARC-Refers-To-Target-URI", refers_url),
                        ("WARC-Refers-To-Date", DATE),
                        ("X-Refers-To-Page-Id", refers_to),
                        ("Content-Type", "application/http; msgtype=response"),
                    ]
                    out.append(record(fields, HTTP_HEAD + CRLF))
                    continue
                block = HTTP_HEAD + b"Transfer-Encoding: chunked" + CRLF + CRLF
                block += chunked(payload)
                cuts = range(0, len(block), segment_bytes)
                kind = [
                    ("WARC-Type", "response"),
                    ("WARC-Record-ID", ident),
                    *about,
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                if len(cuts) > 1:
                    kind.append(("WARC-Segment-Number", 1))
                out.append(record(kind, block[:segment_bytes]))
                for number, at in enumerate(cuts[1:], 2):
                    own = uuid.uuid5(name, str(number))
                    last = at + segment_bytes >= len(block)
                    fields = [
                        ("WARC-Type", "continuation"),
                        ("WARC-Record-ID", f"<urn:uuid:{own}>"),
                        ("WARC-Target-URI", url),
                        ("WARC-Date", DATE),
                        ("WARC-Segment-Origin-ID", ident),
                        ("WARC-Segment-Number", number),
                        ("WARC-Segment-Total-Length", len(block) if last else None),
                    ]
                    out.append(record(fields, block[at : at + segment_bytes]))
            return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], schema=schema)

        return apply

    made = map_slices(_referred(pages), make, "record binary", "payload")
    # A string column is written byte by byte, whatever the bytes are.
    (
        made.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\r\n\r\n")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(path)
    )


PAGE_FIELDS = (
    "page_id long, url string, record_type string, refers_to long, "
    "declared_bytes long, declared_digest string"
)
SEGMENT_FIELDS = (
    f"{PAGE_FIELDS}, origin string, number int, total long, block binary"
)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _records(files: DataFrame, segmented: bool) -> DataFrame:
    """A row for each record that is, or is not, a segment of a longer one."""
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("declared_bytes", pa.int64()),
            ("declared_digest", pa.string()),
            ("origin", pa.string()),
            ("number", pa.int32()),
            ("total", pa.int64()),
            ("block", pa.binary()),
        ]
    )

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "content", rows=1):
                rows, held = [], 0
                for fields, block in records(part.column("content")[0].as_py()):
                    if ("warc-segment-number" in fields) != segmented:
                        continue
                    get = fields.get
                    rows.append(
                        (
                            _number(get("x-page-id")),
                            get("warc-target-uri"),
                            get("warc-type"),
                            _number(get("x-refers-to-page-id")),
                            _number(get("x-payload-length")),
                            (get("warc-payload-digest") or "").removeprefix("sha1:"),
                            get("warc-segment-origin-id") or get("warc-record-id"),
                            _number(get("warc-segment-number")),
                            _number(get("warc-segment-total-length")),
                            block,
                        )
                    )
                    held += len(block)
                    if held > 4 << 20:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)

    return files.select("content").mapInArrow(parse, SEGMENT_FIELDS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """A row per page with its payload; null for revisits, whose payload is another's."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    # Parsing twice is cheaper than storing or shuffling what is whole already.
    whole = _records(files, segmented=False).select(*PAGE_COLUMNS, "block")
    first = F.col("number") == 1
    joined = (
        _records(files, segmented=True)
        .groupBy("origin")
        .agg(
            *(F.max(F.when(first, F.col(c))).alias(c) for c in PAGE_COLUMNS),
            F.sort_array(F.collect_list(F.struct("number", "block"))).alias("_parts"),
            F.max("total").alias("_total"),
        )
        .select(*PAGE_COLUMNS, _joined("_parts", "_total", "origin").alias("block"))
    )
    return _decoded(whole.unionByName(joined))


PAGE_COLUMNS = [f.split()[0] for f in PAGE_FIELDS.split(", ")]


def _joined(parts: str, total: str, origin: str) -> Column:
    """The blocks of all segments in order, or an error."""
    numbers = F.transform(parts, lambda p: p["number"])
    # As strings of raw bytes, which are joined in one go.
    block = F.array_join(F.transform(parts, lambda p: p["block"].cast("string")), "")
    complete = (numbers == F.sequence(F.lit(1), F.size(parts))) & (
        F.octet_length(block) == F.col(total)
    )
    wrong = F.concat(F.lit("segments are missing or cut short: "), F.col(origin))
    return F.when(complete, block.cast("binary")).otherwise(
        F.raise_error(wrong).cast("binary")
    )


def _decoded(blocks: DataFrame) -> DataFrame:
    """Payload, its size and digest in place of the block."""
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
        ]
    )

    def make():
        def apply(part):
            rows = []
            for page_id, url, kind, refers, size, digest, block in zip(
                *(c.to_pylist() for c in part.columns)
            ):
                payload = None
                if kind != "revisit":
                    payload = payload_of(block)
                    found = len(payload), sha1(payload).hexdigest()
                    if found != (size, digest):
                        raise ValueError(f"payload of page {page_id} is damaged")
                rows.append((page_id, url, kind, refers, payload, size, digest))
            return _batch(rows, schema)

        return apply

    return map_slices(
        blocks,
        make,
        "page_id long, url string, record_type string, refers_to long, "
        "payload binary, payload_bytes long, payload_digest string",
        "block",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to a new archive in the shared folder and read it."""
    spark = pages.sparkSession
    path = f"{scratch_root(spark)}/archive-{uuid.uuid4().hex[:8]}"
    write_archive(pages, path)
    return read_archive(spark, path)
