"""WARC archives: written with an index, read back by byte ranges.

Writing: each task appends its pages to archive files in the shared folder, every
record a gzip member of its own, and returns an index row per record (file, offset,
length, URL, digest).  A file's name is drawn anew by each attempt of a task and only the
index names it, so a lost executor or a second attempt leaves at most files that
nothing reads.  Of pages with equal payloads the one with the largest page_id is a
response and the others are revisits without payload.  Payloads are
shuffled only if a bounded bitmap says that another page may have the same.

Reading goes by the index: the selected records are sorted by file and offset, near
ranges are read in one go, and each payload's digest is checked.

Nulls: a null html is an empty payload, a null url is left out, a null page_id is
written as such and comes back null.  Line breaks in a url are percent-encoded.
Rows that repeat the largest page_id of their payload are all responses.  An
empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, folder, join_spread, seen_in, slices, written

DATE = "2024-01-01T00:00:00Z"
MOST_FILE = 1 << 30          # bytes after which a task starts another file
GAP = 1 << 16                # unread bytes between two records that are read in one go all the same
MOST_RANGE = 8 << 20         # bytes read in one go (one longer record: alone)
TASK_BYTES = 16 << 20        # of archives read by one task
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
LEAST_BYTES = 0              # smaller payloads are all responses
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("page_id long, file string, offset long, length long, url string, payload_bytes long, "
         "payload_digest string, record_type string")


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by URI (or by a plain local path)."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, uncompressed."""
    block = HTTP if revisit else HTTP + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    return headers, block[len(HTTP):]


def page_number(urn: str) -> int | None:
    """The page of <urn:x-page:N>."""
    number = urn[len("<urn:x-page:"):-1]
    return int(number) if number else None


def with_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to, revisit)."""
    # equal SHA-256 (and length): there are known pairs of payloads of one SHA-1 and one length
    sha = F.sha2(F.coalesce("html", F.lit("")), 256)
    size = F.octet_length(F.coalesce("html", F.lit("")))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), sha.alias("sha"), size.alias("size"))
    counted = rows.filter(F.col("size") >= least_bytes).groupBy("sha", "size")
    groups = written(counted.agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")), "payloads")
    several = groups.filter("n > 1")
    marked = seen_in(rows, F.xxhash64("sha", "size"), several.select(F.xxhash64("sha", "size").alias("key")))
    alone = (marked.filter("not __sm_seen")
             .select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to"), F.lit(False).alias("revisit")))
    total = groups.agg(F.sum("n")).first()[0] or 0
    hot = several.filter(F.col("n") * HOT_SHARE > total).select("sha", "size")
    found = join_spread(marked.filter("__sm_seen"), several.drop("n"), ["sha", "size"], hot)
    revisit = F.coalesce(F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest")), F.lit(False))
    found = found.select("page_id", "url", "html", F.when(revisit, F.col("largest")).alias("refers_to"),
                         revisit.alias("revisit"))
    return alone.unionByName(found)


def write_archives(pages: DataFrame, to: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write a record for every page into files under ``to``; returns the index (written once)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(to)
        out = name = None
        at = 0
        try:
            for batch in slices(batches, "html"):
                rows = []
                for page_id, url, html, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= MOST_FILE:
                        if out is not None:
                            out.close()
                        store.create_dir(base, recursive=True)
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    payload = html.encode()
                    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = pack.compress(record(page_id, url, payload, refers_to, revisit)) + pack.flush()
                    out.write(data)
                    rows.append((page_id, name, at, len(data), url, len(payload), digest(payload),
                                 "revisit" if revisit else "response"))
                    at += len(data)
                if rows:
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
                    names = [field.split()[0] for field in INDEX.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        finally:
            if out is not None:
                out.close()

    rows = with_revisits(pages, least_bytes).withColumn("page_id", F.col("page_id").cast("long"))
    return written(rows.mapInArrow(run, INDEX), "warc-index")


def ranges(rows: list[tuple], gap: int = GAP, most: int = MOST_RANGE) -> Iterator[tuple[str, int, int, list[tuple]]]:
    """(file, start, end, rows): near records of sorted index rows (page_id, file, offset, length) in one go."""
    held: list[tuple] = []
    for row in rows:
        if held and (row[1] != held[0][1] or row[2] - (held[-1][2] + held[-1][3]) > gap
                     or row[2] + row[3] - held[0][2] > most):
            yield held[0][1], held[0][2], held[-1][2] + held[-1][3], held
            held = []
        held.append(row)
    if held:
        yield held[0][1], held[0][2], held[-1][2] + held[-1][3], held


def read_records(index: DataFrame, at: str) -> DataFrame:
    """(page_id, payload, payload_bytes, payload_digest, record_type, refers_to) of the records of ``index``.

    ``index`` may be any selection of rows; ``at`` is the folder they were written to.
    A response whose payload does not match its digest raises.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(at)
        file, name = None, None
        for batch in batches:                                    # sorted by file and offset
            for part, start, end, rows in ranges(list(zip(*(c.to_pylist() for c in batch.columns)))):
                if part != name:
                    if file is not None:
                        file.close()
                    file, name = store.open_input_file(f"{base}/{part}"), part
                data = memoryview(file.read_at(end - start, start))
                out = []
                for _, _, offset, length in rows:
                    headers, payload = parse(zlib.decompress(data[offset - start:offset - start + length], 31))
                    kind, sha = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and digest(payload) != sha:
                        raise ValueError(f"{part} at {offset}: the payload does not match its digest")
                    refers = headers.get("WARC-Refers-To")
                    out.append((page_number(headers["WARC-Record-ID"]), payload if kind == "response" else None,
                                int(headers["X-Payload-Length"]), sha, kind, page_number(refers) if refers else None))
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ["page_id", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
        if file is not None:
            file.close()

    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-size // TASK_BYTES))                       # the index itself is too small to tell
    wanted = (index.select("page_id", "file", "offset", "length")
              .repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset"))
    return wanted.mapInArrow(run, "page_id long, payload binary, payload_bytes long, payload_digest string, "
                                  "record_type string, refers_to long")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read all archives back: one row per page, without the payload."""
    to = folder(pages.sparkSession, "warc")
    return read_records(write_archives(pages, to), to).drop("payload")
