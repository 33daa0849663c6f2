"""WARC archives: a writer that compresses record by record, and a reader that splits files by byte ranges.

A record is one gzip member, so a reader that is given any range of bytes can
look for the gzip magic, try to decode a WARC header there, and go on member by
member. A record belongs to the range it starts in, wherever it ends.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import col, shuffle_width, table
from tarnwork.llm.registry import query
from tarnwork.llm.storage import open_store
from tarnwork.session import scratch_dir, settle

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HEADER_LIMIT = 1 << 20
CHUNK = 1 << 18
FILES = "file string, bytes long, records long"
RECORDS = "file string, offset long, record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(record_id: str, uri: str | None, date: str, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which keeps the HTTP header and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    head = [VERSION.decode(), f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {quote(uri, safe=';/?:@&=+$,#[]%~!*()')}")
    if refers_to:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_warc(df: DataFrame, folder: str, date: str, level: int = 6, file_bytes: int = 1 << 30) -> DataFrame:
    """Write rows ``record_id, target_uri, payload, refers_to`` (strings; payload in UTF-8, NULL: empty) and return the files.

    Each task writes files of its own under another name and renames them when they are
    whole, so a task that is run again replaces them. Result: ``file, bytes, records``.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        part, done, out, number = TaskContext.get().partitionId(), [], None, 0

        def close():
            out[0].close()
            store.move(out[1], out[2])
            done.append((f"{folder}/{out[2].rpartition('/')[2]}", out[3], out[4]))

        for batch in batches:
            for row_id, uri, payload, refers in zip(*(batch.column(c).to_pylist() for c in ("record_id", "target_uri", "payload", "refers_to")), strict=True):
                if out is None:
                    name = f"part-{part:05d}-{number:03d}.warc.gz"
                    hidden = f"{root}/.{name}-{uuid.uuid4().hex}"
                    out, number = [store.open_output_stream(hidden, compression=None), hidden, f"{root}/{name}", 0, 0], number + 1
                data = member(record(row_id, uri, date, (payload or "").encode(), refers), level)
                out[0].write(data)
                out[3] += len(data)
                out[4] += 1
                if out[3] >= file_bytes:
                    close()
                    out = None
        if out:
            close()
        names = ["file", "bytes", "records"]
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names)

    return settle(df.select("record_id", "target_uri", "payload", "refers_to").mapInArrow(write, FILES), "warc-files")


def decode(read, at: int, first: bytes) -> tuple[bytes, int] | None:
    """The member that starts at ``at`` and where it ends; None where no WARC record does. ``read(at)`` gives the next bytes."""
    unpack, data, whole, checked = zlib.decompressobj(31), first, bytearray(), False
    at += len(first)
    while not unpack.eof:
        if not data:
            return None  # cut off
        try:
            # The first bytes are enough to refuse what only looks like a member.
            whole += unpack.decompress(data) if checked else unpack.decompress(data, 64)
        except zlib.error:
            return None
        if not checked and len(whole) >= len(VERSION):
            if not whole.startswith(b"WARC/1."):
                return None
            checked = True
        data = unpack.unconsumed_tail
        if not data and not unpack.eof:
            data = read(at)
            at += len(data)
    return bytes(whole), at - len(unpack.unused_data)


def headers(block: bytes) -> tuple[dict[str, str], int]:
    """Fields by lower-case name, and where the body starts."""
    end = block.find(b"\r\n\r\n", 0, HEADER_LIMIT)
    if end < 0:
        raise ValueError("no end of header")
    fields = (line.partition(b":") for line in block[:end].split(b"\r\n")[1:])
    return {k.decode().strip().lower(): v.decode("utf-8", "replace").strip() for k, _, v in fields}, end + 4


def parse(whole: bytes) -> dict:
    """A record's fields; the digest of a response is taken from its payload and must equal the stated one."""
    head, start = headers(whole)
    block = whole[start : start + int(head["content-length"])]
    found = {
        "record_type": head["warc-type"],
        "record_id": head["warc-record-id"].strip("<>"),
        "target_uri": head.get("warc-target-uri"),
        "refers_to": head.get("warc-refers-to", "").strip("<>") or None,
        "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload_bytes": None,
        "payload": None,
    }
    if "application/http" in head.get("content-type", ""):
        http, body = headers(block)
        if found["record_type"] == "revisit":
            found["payload_bytes"] = int(http["content-length"]) if "content-length" in http else None
            return found
        block = block[body:]
    own = digest_of(block)
    if found["payload_digest"] not in (None, own):
        raise ValueError(f"payload of {found['record_id']} does not match its digest")
    return found | {"payload": block, "payload_bytes": len(block), "payload_digest": own}


def records_in(store, path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each record that starts in ``[start, end)``."""
    with store.open_input_file(path) as source:
        size = source.size()
        # One window over the file moves forward; ``base`` is the place of its first byte.
        base, window = start, b""

        def read(at: int, n: int = CHUNK) -> bytes:
            return source.read_at(max(0, min(n, size - at)), at)

        at = start
        while at < end:
            if not base <= at < base + len(window) - len(MAGIC):
                base, window = at, read(at)
            found = window.find(MAGIC, at - base)
            if found < 0:
                if base + len(window) >= size:
                    return
                at = base + len(window) - len(MAGIC) + 1
                window = b""
                continue
            at = base + found
            if at >= end:
                return
            if got := decode(read, at, window[found:]):
                yield at, got[0]
                at = got[1]
            else:
                at += 1


def read_warc(files: DataFrame, split_bytes: int = 64 << 20, with_payload: bool = True) -> DataFrame:
    """Records of the archives in ``files`` (``file, bytes``), read by byte ranges of ``split_bytes``.

    Result: ``file, offset, record_type, record_id, target_uri, refers_to,
    payload_digest, payload_bytes`` and, if asked for, ``payload``. Bytes that are no WARC
    record are passed over; a response whose payload does not match its digest stops the job.
    An archive without records, or no archive at all, gives no rows.
    """
    schema = RECORDS + (", payload binary" if with_payload else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64() if n in ("offset", "payload_bytes") else pa.binary() if n == "payload" else pa.string() for n in names]

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names)

        for batch in batches:
            for file, start, end in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "end")), strict=True):
                store, path = open_store(file)
                rows, held = [], 0
                for at, whole in records_in(store, path, start, end):
                    rows.append({"file": file, "offset": at} | parse(whole))
                    held += len(whole)
                    if held > (8 << 20):
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    splits = files.where("bytes > 0").select("file", F.explode(starts).alias("start"), "bytes")
    splits = splits.select("file", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("end"))
    # A round robin over rows that a written table holds; one task for a few splits.
    return splits.repartition(shuffle_width(files.sparkSession)).mapInArrow(read, schema)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows ``page_id, url, html`` with ``refers_to``: the smallest ``page_id`` with an equal payload where that is another.

    Payloads are compared by SHA-1 and length. Only payloads that occur under several ids
    are joined back, so the hottest one is a single row of the smaller side. Rows that
    share the smallest id are all responses; a NULL id is never referred to, and NULL ids alone refer to nothing.
    Payloads under ``least_bytes`` are all responses.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", payload.alias("html")).withColumns({"sha": F.sha1(F.col("html").cast("binary")), "n_bytes": F.octet_length("html")})
    repeated = keyed.where(F.col("n_bytes") >= least_bytes).groupBy("sha", "n_bytes").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = keyed.join(repeated, ["sha", "n_bytes"], "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))


def record_id(page_id) -> F.Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def page_of(name: str) -> F.Column:
    number = F.regexp_extract(col(name), r"^urn:page:(-?\d+)$", 1)
    return F.when(number != "", number.cast("long")).alias("page_id" if name == "record_id" else name)


def archive_pages(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) as WARC files under ``folder``; other columns are ignored. Returns the files."""
    linked = with_revisits(pages, least_bytes)
    rows = linked.select(
        record_id(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.col("html").alias("payload"),
        F.when(F.col("refers_to").isNotNull(), record_id(F.col("refers_to"))).alias("refers_to"),
    )
    return write_warc(rows, folder, date)


# Base32 by hand: five hex digits are twenty bits, which are four letters.
SHA1_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + CAST((CAST('0x' || substr(sha1(coalesce(html, '')), 1 + 5 * CAST(i // 4 AS INT), 5) AS BIGINT) >> (15 - 5 * CAST(i % 4 AS INT))) & 31 AS INT), 1)), '')"""


@query(
    "op1_warc",
    f"""
SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, {SHA1_BASE32} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)
""",
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back by byte ranges of 8 MB."""
    files = archive_pages(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    found = read_warc(files, split_bytes=8 << 20, with_payload=False)
    return found.select(page_of("record_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to"))
