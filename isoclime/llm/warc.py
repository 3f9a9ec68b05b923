"""WARC archives with a two-level capture index.

Writing: pages meet the first page of their payload in one join on the payload digest; tasks then append
gzipped WARC records, one member a record, to archive files of their own in the shared folder and report
where each record lies. Files are named by partition and attempt, so a task that is run again writes
another file, and only the one reported is ever read.

Index: captures are range-sorted by reversed-host URL key; every partition becomes one index file of
zlib-compressed blocks of lines followed by a sparse directory with the first key of each block. A lookup
finds its index file among the files' first keys (one row a file, at most ``MAX_INDEX_FILES``: the only thing
that is collected), binary-searches the directory, and inflates one block. Lookups are grouped by index
file and sorted, fetches by archive file and offset, so both read forward. Equal keys are told apart by
capture number: no URL or host is bound to one task.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, new_folder, partitions, table

MIN_REVISIT_BYTES, BLOCK_LINES, ARCHIVE_BYTES, MAX_INDEX_FILES, GZIP_LEVEL = 100, 1024, 1 << 28, 4096, 3
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


#: Schemes of Hadoop's connectors and of the same stores in Arrow. Fixed values.
STORES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfss": "abfss", "abfs": "abfs"}


def store_uri(path: str) -> str:
    """A Spark path as Arrow names it: file URIs become plain paths, connectors' schemes those of their stores."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    scheme, parted, rest = path.partition("://")
    return f"{STORES.get(scheme, scheme)}://{rest}" if parted else path


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or plain path and the path in it, on the store of the shared folder."""
    return fs.FileSystem.from_uri(store_uri(path))


def url_key(url: str | None) -> str:
    """Reversed-host key: scheme, user, default port and fragment dropped, host lower-cased; null: empty."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    where = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{where}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _clean(text: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record, gzipped. A revisit keeps the HTTP header, with the length of the payload it leaves out."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {date}"]
    head.append(f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """(header fields, payload length by the HTTP header, payload) of one gzipped record."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(h.split(b": ")[1]) for h in http.split(b"\r\n") if h.startswith(b"Content-Length: "))
    return fields, length, payload


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to): the least page_id of an equal payload of ``min_bytes`` or more, where that is another page."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digest = F.when(F.octet_length("html") >= min_bytes, F.sha2("html", 256))
    firsts = rows.select(digest.alias("_d"), "page_id").filter("_d IS NOT NULL").groupBy("_d")
    firsts = materialize(firsts.agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n"), "first_pages")
    alone = F.concat_ws(":", F.lit("short"), F.xxhash64("page_id", "url"))  # meets no digest, so short payloads spread instead of sharing a null
    joined = rows.withColumn("_d", F.coalesce(digest, alone)).join(firsts, "_d", "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first")).alias("refers_to"))


def write_archives(rows: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, html, refers_to) rows as WARC files; returns one capture a row: url_key, capture, page_id, file, offset, length."""
    folder = new_folder(rows.sparkSession, "warc")
    names = ["url_key", "capture", "page_id", "file", "offset", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, number, out, at, path = TaskContext.get(), 0, 0, None, 0, ""
        store, root = open_fs(folder)
        try:
            for b in batches:
                found = []
                for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        store.create_dir(root, recursive=True)
                        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{n:04d}-{uuid.uuid4().hex[:8]}.warc.gz"
                        path, out, at, n = f"{folder}/{name}", store.open_output_stream(f"{root}/{name}", compression=None), 0, n + 1
                    data = record(page_id, url, html.encode(), refers_to)
                    out.write(data)
                    found.append((url_key(url), (task.partitionId() << 33) + number, page_id, path, at, len(data)))
                    at, number = at + len(data), number + 1
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                columns = list(zip(*found, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        finally:
            if out is not None:
                out.close()

    schema = "url_key string, capture long, page_id long, file string, offset long, length long"
    return materialize(rows.mapInArrow(run, schema), "captures")


@dataclass
class CaptureIndex:
    """First keys and paths of the index files, in key order."""

    firsts: list[tuple[str, int]]
    files: list[str]


def build_index(captures: DataFrame, block_lines: int = BLOCK_LINES, files: int | None = None) -> CaptureIndex:
    """Sort captures by (url_key, capture) into index files of compressed blocks with a sparse directory."""
    spark = captures.sparkSession
    folder = new_folder(spark, "cdx")
    n = min(files or partitions(spark), MAX_INDEX_FILES)
    order = ["url_key", "capture"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, lines, directory, at, first = TaskContext.get(), [], [], 0, None
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.cdx"
        store, root = open_fs(folder)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:

            def close_block() -> None:
                nonlocal at, lines
                data = zlib.compress("\n".join(map(json.dumps, lines)).encode())
                directory.append((lines[0][0], lines[0][1], at, len(data)))
                out.write(data)
                at, lines = at + len(data), []

            for b in batches:
                for line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    first = first or line[:2]
                    lines.append(line)
                    if len(lines) == block_lines:
                        close_block()
            if lines:
                close_block()
            data = zlib.compress(json.dumps(directory).encode())
            out.write(data + at.to_bytes(8, "big") + len(data).to_bytes(8, "big"))
        if first is not None:
            columns = [[first[0]], [first[1]], [f"{folder}/{name}"]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["url_key", "capture", "file"])

    sorted_rows = captures.select(*order, "page_id", "file", "offset", "length").repartitionByRange(n, *order).sortWithinPartitions(*order)
    shards = sorted_rows.mapInArrow(run, "url_key string, capture long, file string").collect()  # one row an index file
    shards.sort(key=lambda r: (r.url_key, r.capture))
    return CaptureIndex([(r.url_key, r.capture) for r in shards], [r.file for r in shards])


class IndexFile:
    """The directory of one index file; blocks are read and inflated when asked for."""

    def __init__(self, path: str):
        store, at = open_fs(path)
        self.file = store.open_input_file(at)
        end = self.file.size()
        tail = self.read(end - 16, 16)
        start, n = int.from_bytes(tail[:8], "big"), int.from_bytes(tail[8:], "big")
        self.blocks = [((k, c), o, n) for k, c, o, n in json.loads(zlib.decompress(self.read(start, n)))]
        self.held: tuple[int, dict] = (-1, {})

    def read(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def find(self, key: tuple[str, int]) -> list | None:
        """[page_id, file, offset, length] of a capture, or None."""
        at = bisect_right(self.blocks, key, key=lambda b: b[0]) - 1
        if at < 0:
            return None
        if self.held[0] != at:
            lines = map(json.loads, zlib.decompress(self.read(*self.blocks[at][1:])).decode().split("\n"))
            self.held = at, {(line[0], line[1]): line[2:] for line in lines}
        return self.held[1].get(key)


def lookup(index: CaptureIndex, keys: DataFrame) -> DataFrame:
    """(page_id, file, offset, length) of every (url_key, capture) row of ``keys`` that the index has."""
    firsts, files = index.firsts, index.files

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = [bisect_right(firsts, k) - 1 for k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard, pa.int32())], ["url_key", "capture", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = -1, None
        for b in batches:
            found = []
            for key, capture, shard in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if shard >= 0 and shard != number:
                    number, held = shard, IndexFile(files[shard])
                if shard >= 0 and (line := held.find((key, capture))):
                    found.append(line)
            columns = list(zip(*found, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "file", "offset", "length"])

    routed = keys.select("url_key", "capture").mapInArrow(route, "url_key string, capture long, shard int")
    routed = routed.repartition(partitions(keys.sparkSession), "shard").sortWithinPartitions("shard", "url_key", "capture")
    return routed.mapInArrow(run, "page_id long, file string, offset long, length long")


def fetch(places: DataFrame) -> DataFrame:
    """Range-read and parse records: page_id, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits).

    A response whose payload doesn't have the recorded digest or length raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for b in batches:
            found = []
            for page_id, name, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if name != path:
                    store, at = open_fs(name)
                    path, file = name, store.open_input_file(at)
                file.seek(offset)
                fields, size, payload = parse(file.read(length))
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                refers_to = int(fields["WARC-Refers-To"].rpartition(":")[2][:-1]) if kind == "revisit" else None
                if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"damaged record in {name} at {offset}")
                found.append((page_id, size, digest, kind, refers_to, payload if kind == "response" else None))
            columns = list(zip(*found, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    places = places.repartition(partitions(places.sparkSession), "file").sortWithinPartitions("file", "offset")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return places.mapInArrow(run, schema)


def archive_and_read(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Archive pages (page_id, url, html), index the captures, look every one up and read it back.

    Null html is an empty payload, null urls share the empty key, and rows that repeat the first page_id of
    a payload are responses like it. A page without an id that shares its payload with one that has an id
    revisits that one. Empty input gives an empty result; other columns are ignored.
    """
    captures = write_archives(with_revisits(pages, min_bytes))
    return fetch(lookup(build_index(captures), captures))


def op2_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(table(spark, sf_dir, "pages")).drop("payload")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
f AS (SELECT *, CASE WHEN strlen(t) >= 100 THEN min(page_id) OVER (PARTITION BY t) ELSE page_id END AS first FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, sha256(t) AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""
