"""WARC archives: write pages as records with an index, and read selected records back by byte ranges.

Every task writes its records, each a gzip member of its own, to archives in the shared folder and returns one index
row per record: archive, offset, length, URL, digest and what else selects records. The index is the commit record:
it is staged through Spark, so archives left behind by a lost or repeated task are never referred to. Readers take
any selection of index rows, order it by archive and offset, join neighbouring ranges and fetch each run with one read.
Records are checked against their digest.

Equal payloads are stored once: the record with the largest id is the response, the others revisit it. The deciding
aggregate moves digests and ids only.

Defined cases: null html is an empty payload; rows that share the largest id of equal payloads are all responses; a null id
counts as smaller than any other; a null URL is left out of the record; line breaks and blanks in a URL are percent-encoded
in the record. Extra columns are ignored. Archives are opened through ``pyarrow.fs``, which reaches local paths
and the usual object stores.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.scratch import scratch_dir, stage

ARCHIVE_BYTES = 1 << 30
GAP_BYTES = 64 << 10
RUN_BYTES = 16 << 20
READ_BYTES = 64 << 20  # of stored records, read by one task
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

INDEX = ("archive string, offset long, length long, url string, page_id long, payload_digest string, payload_bytes long,"
         " record_type string, refers_to long")
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long,"
          " payload binary")


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column; 40 bits of the digest make 8 characters."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _BASE32_HEX, _BASE32)


def _sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def decide(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds payload, its digest and size, record_type and refers_to to (page_id, url, html)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.select("*", payload_digest(F.col("payload")).alias("payload_digest"),
                       F.octet_length("payload").cast("long").alias("payload_bytes"))
    newest = rows.groupBy("payload_digest").agg(F.max("page_id").alias("newest"))
    own = (F.col("payload_bytes") < least_bytes) | F.col("page_id").eqNullSafe(F.col("newest"))
    return rows.join(newest, "payload_digest").select(
        "page_id", "url", "payload", "payload_digest", "payload_bytes",
        F.when(own, "response").otherwise("revisit").alias("record_type"),
        F.when(~own, F.col("newest")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None,
           date: str) -> bytes:
    """One WARC record, uncompressed. A revisit has no block; the payload's full size is in its own header."""
    block = b"" if kind == "revisit" else (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload)
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=-._~"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head += [f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes | None]:
    """Headers and payload of one uncompressed record; a revisit has no payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    if len(block) != int(headers["Content-Length"]):
        raise ValueError("the record is cut short")
    return headers, None if headers["WARC-Type"] == "revisit" else block.partition(b"\r\n\r\n")[2]


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
          date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write all pages below ``folder`` and return the staged index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        archive, name, sink = None, "", None
        size = 0
        try:
            for batch in batches:
                rows = batch.to_pylist()
                index = []
                for r in rows:
                    if sink is None or size >= archive_bytes:
                        if sink is not None:
                            sink.close()
                        # Every attempt of a task writes files of its own.
                        archive = f"{uuid.uuid4().hex}.warc.gz"
                        name, sink, size = f"{folder}/{archive}", system.open_output_stream(f"{root}/{archive}", compression=None), 0
                    member = gzip.compress(record(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["record_type"],
                                                  r["refers_to"], date), mtime=0)
                    sink.write(member)
                    index.append((name, size, len(member), r["url"], r["page_id"], r["payload_digest"], r["payload_bytes"],
                                  r["record_type"], r["refers_to"]))
                    size += len(member)
                columns = list(zip(*index, strict=True)) or [()] * 9
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 names=[c.split()[0] for c in INDEX.split(", ")])
        finally:
            if sink is not None:
                sink.close()

    return stage(decide(pages, least_bytes).mapInArrow(run, INDEX), "warc-index")


def runs(ranges: list[tuple[str, int, int]], gap: int = GAP_BYTES, longest: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Slices of the ordered ranges (archive, offset, length) that one read fetches: close by and not too long."""
    first = 0
    for i in range(1, len(ranges) + 1):
        if i < len(ranges):
            (archive, offset, length), (last, at, size) = ranges[i], ranges[i - 1]
            if archive == last and offset - (at + size) <= gap and offset + length - ranges[first][1] <= longest:
                continue
        yield first, i
        first = i


def read(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of any selection of index rows, verified.

    The number of tasks follows from the bytes of the records; those of the index itself are a fiftieth of them.
    """
    size = index.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]
    ordered = (index.select("archive", "offset", "length").repartitionByRange(1 + size // READ_BYTES, "archive", "offset")
               .sortWithinPartitions("archive", "offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = list(zip(*[batch.column(c).to_pylist() for c in ("archive", "offset", "length")], strict=True))
            out = []
            for first, end in runs(ranges):
                archive, start = ranges[first][:2]
                system, path = _open(archive)
                with system.open_input_file(path) as source:
                    data = source.read_at(max(o + n for _, o, n in ranges[first:end]) - start, start)
                for _, offset, length in ranges[first:end]:
                    headers, payload = parse(zlib.decompress(data[offset - start:offset - start + length], wbits=31))
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(headers["X-Payload-Length"])
                    if payload is not None and (len(payload) != size or _sha1(payload) != digest):
                        raise ValueError(f"{archive} at {offset}: the payload does not match its digest")
                    page, target = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
                    out.append((None if page is None else int(page), headers.get("WARC-Target-URI"), size, digest,
                                headers["WARC-Type"], None if target is None else int(target),
                                payload if with_payload else None))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=[c.split()[0] for c in RECORD.split(", ")])

    found = ordered.mapInArrow(run, RECORD)
    return found if with_payload else found.drop("payload")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages to archives in the shared folder and read every record back."""
    return read(write(pages, scratch_dir(pages.sparkSession, "warc"), least_bytes))
