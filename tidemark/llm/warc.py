"""WARC archives with a two-level capture index.

Writing: every task appends one gzip member per record to an archive of its own. Of records with equal payloads (of
`min_revisit_bytes` or more) the one with the smallest page id is a response with the payload, the others are revisit
records that refer to it. Payload digests are computed first, so no page is shuffled: the repeated digests are joined
to the pages (broadcast if they are few, by their number).

Index: one line per record, keyed by the URL with the host's labels reversed ("com,example,www)/path?query"). The lines
are range-partitioned by key and cut into compressed blocks; every index file ends with a sparse directory of its
blocks' first keys, and the manifest has each file's first and last key. A lookup bisects the manifest, then the directory,
fetches one block by range, bisects its lines, and fetches the record by range.

Nulls: a null payload is empty, a null URL has the key "-". Records of repeated rows are alike: all are responses, or
all revisits. A group in which no row has an id has responses only.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, few_rows, work_folder, written
from tidemark.llm.storage import open_ranges, whole_file

DATE, LEVEL, BLOCK_LINES, PART_LINES, BROADCAST_ROWS = "2024-01-01T00:00:00Z", 6, 1000, 2_000_000, 300_000
_ID, _PROFILE = "urn:page:", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_TAIL, _TAIL_BYTES = "<Q8s", 16
_MAGIC = b"CDXBLKS1"


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host labels, port if it isn't the scheme's own, path and query."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return "-" + url.strip()
    usual = {"http": 80, "https": 443}.get(parts.scheme)
    port = f":{port}" if port and port != usual else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}"


def _gzip(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _record_id(page_id: int | None) -> str:
    return f"<{_ID}{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    digits = record_id.strip("<>").removeprefix(_ID)
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """A response record, or a revisit record of the page `refers_to`."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record; a response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
    body = rest[:int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    sizes = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in http.decode().split("\r\n")[1:])}
    digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    return {"page_id": _page_id(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload": payload if kind == "response" else None, "payload_bytes": int(sizes["content-length"]), "payload_digest": digest,
            "refers_to": _page_id(fields["warc-refers-to"]) if "warc-refers-to" in fields else None}


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit_bytes: int = 0, level: int = LEVEL, date: str = DATE) -> DataFrame:
    """Write the archives below `folder` (a URI) and return the capture lines: key, page_id, record_type, file, offset, length."""
    spark = pages.sparkSession
    bounded_batches(spark, 500)
    folder = folder or work_folder(spark, "warc")
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"), F.unhex(F.sha1(payload)).alias("digest"))
    own = rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    repeated = few_rows(written(own.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "repeated"), BROADCAST_ROWS)
    marked = rows.join(repeated, "digest", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")
    schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        uri, at = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", 0
        with whole_file(uri) as out:
            while first is not None:
                lines = []
                for page, url, data, sha, to in zip(*(first.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                    packed = _gzip(record(page, url, data, base64.b32encode(sha).decode(), to, date), level)
                    out.write(packed)
                    lines.append((url_key(url), page, "response" if to is None else "revisit", uri, at, len(packed)))
                    at += len(packed)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines, strict=True), schema.types, strict=True)], schema=schema)
                first = next(batches, None)

    captures = marked.mapInArrow(write, "key string, page_id bigint, record_type string, file string, offset bigint, length bigint")
    return written(captures, "captures")


def build_index(captures: DataFrame, folder: str | None = None, block_lines: int = BLOCK_LINES, part_lines: int = PART_LINES) -> DataFrame:
    """Write the index files below `folder` and return the manifest: file, part, first_key, last_key, blocks, lines."""
    spark = captures.sparkSession
    folder = folder or work_folder(spark, "cdx")
    parts = max(1, -(-captures.count() // part_lines))
    schema = pa.schema([("file", pa.string()), ("part", pa.int32()), ("first_key", pa.string()), ("last_key", pa.string()), ("blocks", pa.int64()), ("lines", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, directory, block, at, count, last = TaskContext.get().partitionId(), [], [], 0, 0, None
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        uri = f"{folder}/cdx-{part:06d}.gz"
        with whole_file(uri) as out:
            def flush() -> int:
                packed = _gzip(b"".join(line for _, line in block), LEVEL)
                out.write(packed)
                directory.append((block[0][0], at, len(packed), len(block)))
                block.clear()
                return len(packed)

            while first is not None:
                for row in first.to_pylist():
                    block.append((row["key"], json.dumps(row, ensure_ascii=False, separators=(",", ":")).encode() + b"\n"))
                    count, last = count + 1, row["key"]
                    if len(block) == block_lines:
                        at += flush()
                first = next(batches, None)
            if block:
                at += flush()
            sparse = _gzip(json.dumps(directory).encode(), LEVEL)
            out.write(sparse)
            out.write(struct.pack(_TAIL, len(sparse), _MAGIC))
        yield pa.RecordBatch.from_pydict({"file": [uri], "part": [part], "first_key": [directory[0][0]], "last_key": [last], "blocks": [len(directory)], "lines": [count]}, schema=schema)

    ordered = captures.repartitionByRange(parts, "key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")
    return written(ordered.mapInArrow(write, "file string, part int, first_key string, last_key string, blocks bigint, lines bigint"), "index")


class IndexFile:
    """One index file: its directory in memory, blocks by range."""

    def __init__(self, uri: str):
        self._file = open_ranges(uri)
        end = self._file.size()
        size, magic = struct.unpack(_TAIL, self._file.read_at(_TAIL_BYTES, end - _TAIL_BYTES))
        if magic != _MAGIC:
            raise ValueError(f"{uri} is no index file")
        self.directory = json.loads(zlib.decompress(self._file.read_at(size, end - _TAIL_BYTES - size), 31))
        self.keys = [entry[0] for entry in self.directory]

    def block(self, k: int) -> list[dict]:
        _, at, size, _ = self.directory[k]
        return [json.loads(line) for line in zlib.decompress(self._file.read_at(size, at), 31).split(b"\n") if line]

    def find(self, key: str) -> list[dict]:
        """All lines of a key: bisect the directory, then the lines of a block; a key may go on in the next blocks."""
        found, k = [], max(0, bisect_left(self.keys, key) - 1)
        while k < len(self.keys) and self.keys[k] <= key:
            lines = self.block(k)
            keys = [line["key"] for line in lines]
            found += lines[bisect_left(keys, key):bisect_right(keys, key)]
            k += 1
        return found

    def close(self) -> None:
        self._file.close()


def lookup(manifest: list, url: str) -> list[dict]:
    """The parsed records of a URL, read by range. `manifest`: the rows of build_index, one per index file, ordered by part."""
    key, found = url_key(url), []
    for k in range(bisect_left([m["last_key"] for m in manifest], key), bisect_right([m["first_key"] for m in manifest], key)):
        index = IndexFile(manifest[k]["file"])
        for line in index.find(key):
            with open_ranges(line["file"]) as file:
                found.append(parse_record(zlib.decompress(file.read_at(line["length"], line["offset"]), 31)))
        index.close()
    return found


def read_index(manifest: DataFrame) -> DataFrame:
    """The capture lines again, block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, block in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True):
                index = IndexFile(uri)
                yield pa.RecordBatch.from_pylist(index.block(block), schema=pa.schema([
                    ("key", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
                index.close()

    blocks = manifest.select("file", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))
    tasks = manifest.sparkSession.sparkContext.defaultParallelism * 2
    return blocks.repartition(tasks).mapInArrow(run, "key string, page_id bigint, record_type string, file string, offset bigint, length bigint")


def read_archives(manifest: DataFrame, payloads: bool = True, span_bytes: int = 8 << 20) -> DataFrame:
    """Every record that the index lists. Lines are dealt out by archive and stretch, so that each task reads neighbours together."""
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    types = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64()}
    names = [n for n in names if payloads or n != "payload"]
    schema = pa.schema([(n, types[n]) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            lines = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            k = 0
            while k < len(lines):
                to, size = k, 0
                while to < len(lines) and lines[to][0] == lines[k][0] and lines[to][1] == lines[k][1] + size and (to == k or size + lines[to][2] <= span_bytes):
                    size += lines[to][2]
                    to += 1
                if lines[k][0] != name:
                    if file is not None:
                        file.close()
                    name, file = lines[k][0], open_ranges(lines[k][0])
                span, rows = memoryview(file.read_at(size, lines[k][1])), []
                for _, offset, length in lines[k:to]:
                    at = offset - lines[k][1]
                    rows.append({n: v for n, v in parse_record(zlib.decompress(span[at:at + length], 31)).items() if n in types and (payloads or n != "payload")})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                k = to
        if file is not None:
            file.close()

    ddl = ", ".join(f"{n} {'binary' if n == 'payload' else 'string' if types[n] == pa.string() else 'bigint'}" for n in names)
    lines = read_index(manifest).select("file", "offset", "length", F.floor(F.col("offset") / span_bytes).alias("stretch"))
    return lines.repartition("file", "stretch").sortWithinPartitions("file", "offset").mapInArrow(run, ddl)
