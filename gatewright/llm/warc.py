"""WARC archives of pages: written as one gzip stream per file, normalised to one member per record, read by index.

Writing gives monolithic archives, the form most producers hand over: a whole
file is a single gzip stream, so nothing in it can be reached without inflating
all before it. The normaliser inflates such a stream exactly once, in bounded
chunks, and rewrites every record as a gzip member of its own; a sidecar index
lists offset, length, type, id and digest of each member. Readers then seek.

Pages with equal payloads of at least ``MIN_REVISIT_BYTES`` become one response
(the smallest ``page_id``) and revisits of it, which carry no payload. Payload
digests are joined, payloads are shuffled once, and a skewed digest is split by AQE.

Defined cases: a null html is an empty payload. A null ``page_id`` loses to any
other; if all ids of a payload are null, all its records are responses. Rows
repeated with the smallest ``page_id`` are responses too. Line breaks in a URL
are percent-encoded, a null URL is left out. An empty table writes no archive. A
long payload is one record; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.llm.common import staged
from gatewright.llm.files import reading, shared_uri, writing

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 20
LEVEL = 3
DATE = "2026-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "uri STRING, records BIGINT"
GZIP = 31


def record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, payload_digest, payload_bytes, refers_to`` of every row; ``refers_to`` is null for responses."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("bigint").alias("payload_bytes")
    )
    same = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("same_digest"))
    firsts = same.agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    joined = rows.join(firsts.hint("merge"), (F.col("payload_digest") == F.col("same_digest")) & (F.col("payload_bytes") >= min_bytes), "left")
    other = F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return joined.select("page_id", "url", "payload", "payload_digest", "payload_bytes", other.alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    number = identifier.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def render(page_id, url, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    revisit = refers_to is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    body = b"" if revisit else payload
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Monolithic archives of rows from :func:`record_types`: ``uri, records`` per file, as a written table."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        row = next(rows, None)
        while row is not None:
            uri, size, count = f"{folder}/raw/{part:06d}-{number:04d}.warc.gz", 0, 0
            with writing(uri) as out:
                deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                while row is not None and size < archive_bytes:
                    data = render(*row)
                    out.write(deflate.compress(data))
                    size, count, row = size + len(data), count + 1, next(rows, None)
                out.write(deflate.flush())
            number += 1
            yield pa.RecordBatch.from_pydict({"uri": [uri], "records": [count]})

    columns = ["page_id", "url", "payload", "payload_digest", "payload_bytes", "refers_to"]
    return staged(records.select(columns).mapInArrow(write, FILES), "warc-raw")


def inflated(uri: str) -> Iterator[bytes]:
    """The content of a gzip file in chunks, whether it has one member or many."""
    with reading(uri) as file:
        inflate = zlib.decompressobj(GZIP)
        while data := file.read(CHUNK):
            while data:
                yield inflate.decompress(data, CHUNK)
                data = inflate.unconsumed_tail
                if inflate.eof:
                    data, inflate = inflate.unused_data or data, zlib.decompressobj(GZIP)


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Head and whole bytes of each record of an inflated stream; at most a record and a chunk are in memory."""
    held = bytearray()

    def more() -> bool:
        for chunk in chunks:
            held.extend(chunk)
            return True
        return False

    while True:
        scanned = 0
        while (end := held.find(b"\r\n\r\n", scanned)) < 0:
            scanned = max(0, len(held) - 3)
            if not more():
                if held:
                    raise ValueError("the archive ends within a record")
                return
        head = parse_head(bytes(held[:end]))
        size = end + 4 + int(head["content-length"]) + 4
        while len(held) < size:
            if not more():
                raise ValueError("the archive ends within a record")
        yield head, bytes(held[:size])
        del held[:size]


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with one gzip member per record and a sidecar index; ``uri, records`` per file, as a written table."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                target, index, at = f"{folder}/members/{uri.rpartition('/')[2]}", [], 0
                with writing(target) as out:
                    for head, record in split_records(inflated(uri)):
                        deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                        member = deflate.compress(record) + deflate.flush()
                        out.write(member)
                        index.append([at, len(member), head["warc-type"], head["warc-record-id"], head["warc-payload-digest"]])
                        at += len(member)
                with writing(f"{target}.index") as side:
                    side.write(zlib.compress(json.dumps(index).encode()))
                yield pa.RecordBatch.from_pydict({"uri": [target], "records": [len(index)]})

    spread = archives.repartition(max(1, archives.count()))
    return staged(spread.mapInArrow(rewrite, FILES), "warc-members")


def read_index(uri: str) -> list[list]:
    with reading(f"{uri}.index") as side:
        return json.loads(zlib.decompress(side.read()))


def read_member(uri_file: pa.NativeFile, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Head and payload of the record at an indexed place."""
    uri_file.seek(offset)
    data = zlib.decompress(uri_file.read(length), GZIP)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = parse_head(head)
    return fields, rest[: int(fields["content-length"])]


def read_archives(files: DataFrame) -> DataFrame:
    """Every record, through the index: ``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to``.

    A response's payload must match its digest; a revisit has no payload and states the size and digest of what it repeats.
    """

    schema = "page_id BIGINT, url STRING, payload BINARY, payload_bytes BIGINT, payload_digest STRING, record_type STRING, refers_to BIGINT"
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with reading(uri) as file:
                    rows, held = [], 0
                    for offset, length, kind, identifier, digest in read_index(uri):
                        head, payload = read_member(file, offset, length)
                        found = digest.partition(":")[2]
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != found:
                            raise ValueError(f"{uri}: the record at {offset} is damaged")
                        size = len(payload) if kind == "response" else int(head["x-payload-length"])
                        other = page_of(head["warc-refers-to"]) if kind == "revisit" else None
                        rows.append((page_of(identifier), head.get("warc-target-uri"), payload if kind == "response" else None, size, found, kind, other))
                        held += len(payload)
                        if held > CHUNK * 16:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return files.repartition(max(1, files.count())).mapInArrow(read, schema)


def archive_pages(spark: SparkSession, pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write, normalise and read back; the rows of :func:`read_archives`."""
    folder = shared_uri(spark, "warc")
    raw = write_archives(record_types(pages), folder, archive_bytes)
    return read_archives(normalise(raw, folder))
