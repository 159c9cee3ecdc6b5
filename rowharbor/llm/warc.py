"""WARC archives as tables of chunks: a record is one or more rows of bounded size.

A payload of more than ``chunk_bytes`` becomes several segments, each a WARC record
of its own (WARC-Segment-Number), so that no task holds a whole record's text twice
or writes it in one piece. Every segment carries the digest of its own bytes and the
digest of the payload up to its end; the last one thus carries that of the whole.
Archives are written by Spark's text sink, whose line separator is what ends a WARC
record, and hold about ``archive_bytes`` each. They are read back as binary files,
unpacked bit by bit, and every digest is checked; segments of one record meet sorted
by number and are digested one after the other.

Payloads of at least ``MIN_REVISIT_BYTES`` bytes that several pages have are stored
once, at the least page id; the other pages get revisit records.

Defined results: a null html is an empty payload; a null url has no target header;
line breaks in a url are percent-encoded; a null page id is read back as null and is
never referred to, nor is its payload revisited if no other page has it; repeated
rows are records of their own and, being of the least id, all responses; an empty
table writes no archive and gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowharbor.llm.scan import text_column
from rowharbor.llm.tables import settled

MIN_REVISIT_BYTES = 100
CHUNK_BYTES = 1 << 20
ARCHIVE_BYTES = 8 << 20
#: Payloads that repeat are broadcast up to this many (some 100 bytes each).
BROADCAST_ROWS = 200_000
END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _cut(payload: memoryview, size: int) -> Iterator[memoryview]:
    """Pieces of at most ``size`` bytes that end between characters."""
    at = 0
    while len(payload) - at > size:
        end = at + size
        while end > at + 1 and payload[end] & 0xC0 == 0x80:
            end -= 1
        yield payload[at:end]
        at = end
    yield payload[at:]


def _header(fields: dict[str, object]) -> str:
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines]) + END


def _segments(page_id, url, payload: memoryview, digest, refers_to, name: str, chunk_bytes: int):
    """The WARC records of one page, each with the size of its text."""
    target = url and url.replace("\r", "%0D").replace("\n", "%0A")
    common = {
        "WARC-Target-URI": target,
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Page-Id": page_id,
        "X-Payload-Length": len(payload),
    }
    if refers_to is not None:
        yield _header(
            {
                "WARC-Type": "revisit",
                "WARC-Record-ID": f"<urn:page:{name}>",
                "WARC-Refers-To": f"<urn:page-id:{refers_to}>",
                "WARC-Profile": PROFILE,
                **common,
                "Content-Length": 0,
            }
        )
        return
    running = hashlib.sha256()
    whole = len(payload) <= chunk_bytes
    for number, piece in enumerate(_cut(payload, chunk_bytes), 1):
        running.update(piece)
        yield _header(
            {
                "WARC-Type": "response" if number == 1 else "continuation",
                "WARC-Record-ID": f"<urn:page:{name}>" if number == 1 else f"<urn:page:{name}:{number}>",
                "WARC-Segment-Number": None if whole else number,
                "WARC-Segment-Origin-ID": None if number == 1 else f"<urn:page:{name}>",
                **common,
                "WARC-Block-Digest": f"sha256:{hashlib.sha256(piece).hexdigest()}",
                "X-Running-Digest": f"sha256:{running.hexdigest()}",
                "Content-Type": "text/html; charset=utf-8",
                "Content-Length": len(piece),
            }
        ) + str(piece, "utf-8")


def _write_batches(chunk_bytes: int, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        n = archive = filled = 0
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            payloads = text_column(batch, "html").cast(pa.large_binary())
            rows = zip(*(column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")))
            numbers, values, held = [], [], 0
            for k, (page_id, url, digest, refers_to) in enumerate(rows):
                payload = memoryview(payloads[k].as_buffer())
                n += 1
                for value in _segments(page_id, url, payload, digest, refers_to, f"{task}-{n}", chunk_bytes):
                    numbers.append(archive)
                    values.append(value)
                    filled += len(value)
                    held += len(value)
                    if filled >= archive_bytes:
                        archive, filled = archive + 1, 0
                    if held >= archive_bytes:
                        yield _archived(numbers, values)
                        numbers, values, held = [], [], 0
            yield _archived(numbers, values)

    return run


def _archived(numbers: list[int], values: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(values, pa.string())], ["archive", "value"]
    )


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Writes a WARC record for each page to gzip archives in ``path``."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        payload.alias("html"),
        F.sha2(payload, 256).alias("digest"),
    )
    firsts = settled(
        rows.where(F.octet_length("html") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # pages stay where they are; if too many payloads repeat to be sent, the join has
    # shuffles of its own, so that Spark can split the pages of a payload that many have
    few = firsts.count() <= BROADCAST_ROWS
    placed = rows.join(F.broadcast(firsts) if few else firsts, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    )
    archived = placed.mapInArrow(_write_batches(chunk_bytes, archive_bytes), "archive int, value string")
    archived.write.partitionBy("archive").option("lineSep", END).option("compression", "gzip").text(path)


_CHUNKS = (
    "page_id bigint, record string, chunk_no int, record_type string, payload_bytes bigint, "
    "payload_digest string, refers_to bigint, target string, data binary"
)


def _unpacked(content: bytes) -> Iterator[bytes]:
    stream = zlib.decompressobj(31)
    rest = content
    while rest:
        yield stream.decompress(rest, CHUNK_BYTES)
        rest = stream.unconsumed_tail
        if not rest and stream.unused_data:
            rest, stream = stream.unused_data, zlib.decompressobj(31)
    yield stream.flush()


def _records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, one at a time."""
    pieces, buffer = _unpacked(content), bytearray()
    end = END.encode()

    def fill(size: int) -> bool:
        while len(buffer) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while True:
        at = -1
        while (at := buffer.find(end)) < 0:
            if not fill(len(buffer) + 1):
                if buffer:
                    raise ValueError("an archive ends within a record")
                return
        lines = bytes(buffer[:at]).decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        del buffer[: at + 4]
        if not fill(size + 4) or buffer[size : size + 4] != end:
            raise ValueError("a record's length is wrong")
        yield headers, bytes(buffer[:size])
        del buffer[: size + 4]


def _tail(value: str | None, mark: str) -> str | None:
    return value and value.strip("<>").removeprefix(mark)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _CHUNKS.split(", ")]
    types = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for k in range(batch.num_rows):
            rows: list[list] = [[] for _ in names]
            held = 0
            for headers, block in _records(batch.column(0)[k].as_py()):
                number = headers.get("WARC-Segment-Number")
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                revisit = headers["WARC-Type"] == "revisit"
                if not revisit:
                    own = headers["WARC-Block-Digest" if number else "WARC-Payload-Digest"]
                    if "sha256:" + hashlib.sha256(block).hexdigest() != own:
                        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
                page = headers.get("X-Page-Id")
                refers = _tail(headers.get("WARC-Refers-To"), "urn:page-id:")
                row = (
                    None if page is None else int(page),
                    _tail(headers.get("WARC-Segment-Origin-ID") or headers["WARC-Record-ID"], "urn:page:"),
                    int(number or 0),
                    "revisit" if revisit else "response",
                    int(headers["X-Payload-Length"]),
                    digest,
                    None if refers is None else int(refers),
                    headers.get("WARC-Target-URI"),
                    block if number else None,
                )
                for column, value in zip(rows, row):
                    column.append(value)
                held += len(block) if number else 0
                if held > ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types)], names)
                    rows, held = [[] for _ in names], 0
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types)], names)


def _joined_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from chunks that come in order, digested as they come."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target", "n_chunks"]
    record, running, size, chunks = None, None, 0, 0
    for batch in batches:
        out: list[dict] = []
        for row in batch.to_pylist():
            if row["chunk_no"]:
                if row["record"] != record:
                    if record is not None:
                        raise ValueError(f"chunks of {record} are missing")
                    record, running, size, chunks = row["record"], hashlib.sha256(), 0, 0
                chunks += 1
                if row["chunk_no"] != chunks:
                    raise ValueError(f"chunk {chunks} of {record} is missing")
                running.update(row["data"])
                size += len(row["data"])
                if size < row["payload_bytes"]:
                    continue
                if running.hexdigest() != row["payload_digest"]:
                    raise ValueError(f"damaged record {record}")
                row["n_chunks"], record = chunks, None
            else:
                row["n_chunks"] = 1 if row["record_type"] == "response" else 0
            out.append({n: row[n] for n in names})
        yield pa.RecordBatch.from_pylist(
            out,
            pa.schema(
                [
                    ("page_id", pa.int64()),
                    ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()),
                    ("record_type", pa.string()),
                    ("refers_to", pa.int64()),
                    ("target", pa.string()),
                    ("n_chunks", pa.int32()),
                ]
            ),
        )
    if record is not None:
        raise ValueError(f"chunks of {record} are missing")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of the archives: a row for each record or segment. Only
    segments carry their bytes on; whole records are checked where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(_read_batches, _CHUNKS)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, target and
    n_chunks of every record of the archives, digests checked."""
    return (
        read_chunks(spark, path)
        .repartition("record")
        .sortWithinPartitions("record", "chunk_no")
        .mapInArrow(
            _joined_batches,
            "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
            "refers_to bigint, target string, n_chunks int",
        )
    )
