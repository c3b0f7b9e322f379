"""WARC archives: a writer with revisit records, and a reader that splits gzip files by byte ranges."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The first bytes of a gzip member and of a WARC record.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Bytes read at once, and those of a candidate that are decoded at once.
CHUNK = 1 << 20
PROBE = 1 << 10

# Bytes of the buffer that are looked at and decoded at once: what decoding leaves is copied.
PIECE = 1 << 14

RECORDS = (
    "file string, offset bigint, record_type string, record_id string, refers_to string, "
    "url string, payload_digest string, payload_bytes bigint, payload binary, intact boolean"
)


def place(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the path in it."""
    if "://" not in address and not address.startswith("file:"):
        return fs.LocalFileSystem(), address
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", address))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_warc(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
) -> list[tuple[str, int]]:
    """Writes one record per row to gzip files below ``folder``: their addresses and sizes.

    The payload is the text in UTF-8, NULL the empty one. Of equal payloads of
    at least ``least_bytes`` bytes the row with the largest page_id is a
    response, others are revisits of it, with the payload's digest and length
    but not its bytes; smaller ones are all responses. Rows that repeat the
    largest id are all responses. Record ids are ``urn:page:<page_id>``, with
    nothing after the colon for a NULL id. No rows, no files.

    Digests are grouped before they are shuffled, and pages joined with the
    groups, so copies that a third of all rows are get split. Every task
    writes a file of its own, named by its attempt, and reports it when done:
    what a lost or repeated task left is in no report and is never read.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    firsts = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    revisit = ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    records = rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to")
    )
    files = records.mapInArrow(_writer(folder), "path string, bytes bigint").collect()
    return sorted((row["path"], row["bytes"]) for row in files)


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
        system, root = place(folder)
        out, size = None, 0
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                member = _member(_record(page_id, url, payload.encode(), refers_to))
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size]})

    return write


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = answer + payload if refers_to is None else answer
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {safe}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def read_warc(
    spark: SparkSession, files: list[tuple[str, int]], split_bytes: int = 32 << 20
) -> DataFrame:
    """The records of gzip WARC files (address, size): RECORDS, one row each.

    Files are cut into ranges of ``split_bytes``, a task each, wherever that
    falls. A task looks for gzip magic in its range, takes a candidate for a
    record if it decodes to a WARC version at first, and owns the records that
    start in its range; the last may end beyond. After a record it goes on
    where the member ended, so bytes inside compressed data are looked at only
    before a range's first record. A member that holds a stored, uncompressed
    copy of another gzip WARC member could be mistaken there, text cannot.

    ``payload_bytes`` and ``payload_digest`` are of the full payload, for
    revisits as their heads say; ``intact`` is whether a stored payload has the
    digest and the length that its head says. Heads may have any length.
    Records that end early, or have no whole head with a type, are errors. No
    files, no rows.
    """
    ranges = spark.createDataFrame(files, "file string, size bigint").select(
        "file",
        "size",
        F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(split_bytes))).alias("start"),
    )
    n = sum(-(-size // split_bytes) for _, size in files)
    dealt = ranges.repartition(max(1, min(n, 100_000)), "file", "start")
    return dealt.mapInArrow(_reader(split_bytes), RECORDS)


def _reader(split_bytes: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, start in zip(*[c.to_pylist() for c in batch.columns]):
                rows, held = [], 0
                for row in records_in(file, size, start, min(start + split_bytes, size)):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return read


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [part.split() for part in RECORDS.split(", ")]
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])
    return pa.RecordBatch.from_pylist(rows, schema=schema)


@dataclass
class Window:
    """A file seen through one buffer that moves forward."""

    file: pa.NativeFile
    size: int
    at: int = 0
    held: bytes = b""

    def view(self, offset: int, least: int = 1) -> bytes:
        """Up to PIECE bytes from an offset on, ``least`` of them at least unless the file ends.

        Only the piece is copied; the buffer is read anew where it ends.
        """
        low = offset - self.at
        if low < 0 or low + least > len(self.held) and self.at + len(self.held) < self.size:
            self.file.seek(offset)
            self.at, self.held, low = offset, self.file.read(CHUNK), 0
        return self.held[low : low + PIECE]


def records_in(file: str, size: int, start: int, end: int) -> Iterator[dict]:
    """The records that start in a byte range."""
    system, path = place(file)
    with system.open_input_file(path) as opened:
        window, at = Window(opened, size), start
        while at < end:
            seen = window.view(at, len(MAGIC))
            found = seen.find(MAGIC, 0, min(len(seen), end - at + len(MAGIC) - 1))
            if found < 0:
                at += max(1, len(seen) - len(MAGIC) + 1)
                continue
            at += found
            if not _starts_record(window, at):
                at += 1
                continue
            record, after = _whole(window, at)
            parsed = _parsed(record)
            if b"\r\n\r\n" not in record or parsed["record_type"] is None:
                raise ValueError(f"a record without a whole head at byte {at}")
            yield {"file": file, "offset": at, **parsed}
            at = after


def _starts_record(window: Window, at: int) -> bool:
    """Whether a gzip member starts here that decodes to a WARC version at first."""
    unpack, head = zlib.decompressobj(31), b""
    try:
        while len(head) < len(VERSION) and not unpack.eof and (seen := window.view(at)):
            head += unpack.decompress(seen[:PROBE], len(VERSION) - len(head))
            at += len(seen[:PROBE])
    except zlib.error:
        return False
    return head == VERSION


def _whole(window: Window, at: int) -> tuple[bytes, int]:
    """A member's bytes, and where it ends."""
    unpack, parts = zlib.decompressobj(31), []
    while not unpack.eof:
        seen = window.view(at)
        if not seen:
            raise ValueError(f"a record ends early at byte {at}")
        parts.append(unpack.decompress(seen))
        at += len(seen) - len(unpack.unused_data)
    return b"".join(parts), at


def _parsed(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[: int(fields.get("content-length", 0))]
    kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "")
    payload, length = block, None
    if fields.get("content-type", "").startswith("application/http"):
        answer, _, payload = block.partition(b"\r\n\r\n")
        told = re.search(rb"(?im)^content-length:\s*(\d+)", answer)
        length = int(told[1]) if told else None
    bare = digest.partition(":")[2] or None
    stored = kind != "revisit"
    own = base32_sha1(payload) if stored else None
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id"),
        "refers_to": fields.get("warc-refers-to"),
        "url": fields.get("warc-target-uri"),
        "payload_digest": own if stored else bare,
        "payload_bytes": len(payload) if stored else length,
        "payload": payload if stored else None,
        "intact": own in (None, bare) and (length in (None, len(payload)) or not stored) if bare else None,
    }


def list_warc(folder: str) -> list[tuple[str, int]]:
    """The gzip WARC files right below a folder: addresses and sizes."""
    system, root = place(folder)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(
        (f"{folder.rstrip('/')}/{info.base_name}", info.size)
        for info in found
        if info.is_file and info.base_name.endswith(".warc.gz")
    )
