"""WARC archives with a two-level capture index.

Archives are gzip members, one WARC record each, written by the tasks.  The index is
sorted by reversed-host URL keys and cut into compressed blocks of lines; each index
file ends with a sparse directory of its blocks' first keys.  A lookup finds the index
file by its first key, binary-searches the directory, decompresses one block,
binary-searches its lines and reads the record's byte range from the archive.

Files are opened through pyarrow's file systems, below a folder that all executors see.
A task's files have names of their own and are made known only by the rows of the
attempt that Spark commits, so a repeated task leaves nothing that is read twice.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, column, scratch, slices

#: Lines of an index block; index files at most, so that their list stays small.
BLOCK_LINES, INDEX_FILES, FILE_LINES = 256, 2048, 4096
#: Level of the gzip members.
LEVEL = 5
_ENTRY = "key string, page_id long, file string, offset long, length long, kind string, digest string"
_FOUND = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def file_system(path: str):
    """pyarrow's file system of a path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the right, then path and query."""
    try:
        parts = urlsplit(url or "")
        host, port = parts.hostname or "", parts.port
    except ValueError:  # no URL: sorted by its text
        return ")" + quote(url or "", safe="/?&=;:@!$'()*,+~%#")
    tail = parts.path + ("?" + parts.query if parts.query else "") + ("#" + parts.fragment if parts.fragment else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + quote(tail, safe="/?&=;:@!$'()*,+~%#")


def _urn(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> tuple[bytes, str, str]:
    """One record with its digest and type; a revisit keeps the HTTP head, and with it the length of the payload it leaves out."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    kind = "response" if refers_to is None else "revisit"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", _urn(page_id, url)), ("WARC-Date", date), ("WARC-Target-URI", quote(url or "", safe="/?&=;:@!$'()*,+~%#[]")),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", "" if page_id is None else str(page_id)), ("X-Page-Url", json.dumps(url)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-Id", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return text.encode("utf-8") + block + b"\r\n\r\n", digest, kind


def parse(raw: bytes) -> dict:
    """A record read back; the payload of a response must match its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    number = lambda x: int(x) if x else None
    return {
        "page_id": number(fields["X-Page-Id"]), "url": json.loads(fields["X-Page-Url"]), "record_type": fields["WARC-Type"], "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "payload_digest": digest, "refers_to": number(fields.get("X-Refers-To-Page-Id")), "payload": payload if response else None,
    }


def write_archives(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for each page and the capture index below ``out``; returns the index files.

    Of equal payloads of at least ``least_bytes`` bytes the page with the least id is the
    response and the others refer to it.  A null html is the empty payload.  Pages with
    a null id are responses; repeated rows of the least id are all responses.  Other
    columns are ignored.
    """
    spark = pages.sparkSession
    rows = pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).alias("url"), F.coalesce(col(html_col), F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    small = rows.filter(F.octet_length("html") >= least_bytes).select("page_id", "sha").distinct()
    least = small.groupBy("sha").agg(F.min("page_id").alias("first"))
    later = small.join(least, "sha").filter(F.col("page_id") > F.col("first"))
    joined = rows.join(later, ["page_id", "sha"], "left").select("page_id", "url", "html", "first")
    target = out

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = file_system(target)
        files.create_dir(base, recursive=True)
        name = f"pages-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        at = 0
        with files.open_output_stream(f"{base}/{name}", compression=None) as sink:
            for batch in batches:
                for part in slices(batch, "html"):
                    entries = []
                    for row in part.to_pylist():
                        raw, digest, kind = record(row["page_id"], row["url"], row["html"].encode("utf-8"), row["first"], date)
                        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        data = packer.compress(raw) + packer.flush()
                        sink.write(data)
                        entries.append((url_key(row["url"]), row["page_id"], name, at, len(data), kind, digest))
                        at += len(data)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*entries), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=[x.split()[0] for x in _ENTRY.split(", ")])

    joined.mapInArrow(write, _ENTRY).write.parquet(f"{out}/captures")
    captures = spark.read.schema(_ENTRY).parquet(f"{out}/captures")
    parts = max(1, min(INDEX_FILES, captures.count() // FILE_LINES))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = file_system(target)
        name = f"index-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.cdx"
        lines, directory, at, total, lowest = [], [], 0, 0, None
        with files.open_output_stream(f"{base}/{name}", compression=None) as sink:

            def flush() -> int:
                data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), LEVEL)
                sink.write(data)
                directory.append((lines[0][0], lines[0][1], at, len(data)))
                lines.clear()
                return len(data)

            for batch in batches:
                for row in batch.to_pylist():
                    lowest = lowest or (row["key"], row["page_id"])
                    lines.append((row["key"], row["page_id"], row["file"], row["offset"], row["length"], row["kind"], row["digest"]))
                    total += 1
                    if len(lines) == BLOCK_LINES:
                        at += flush()
            if lines:
                at += flush()
            data = zlib.compress(json.dumps(directory).encode(), LEVEL)
            sink.write(data + at.to_bytes(8, "little") + len(data).to_bytes(8, "little"))
        if total:
            yield pa.RecordBatch.from_pydict({"key": [lowest[0]], "page_id": pa.array([lowest[1]], pa.int64()), "file": [name], "lines": pa.array([total], pa.int64())})

    ordered = captures.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")
    ordered.mapInArrow(index, "key string, page_id long, file string, lines long").write.parquet(f"{out}/files")
    return spark.read.parquet(f"{out}/files")


def _rank(key: str, page_id: int | None) -> tuple[str, int]:
    return key, -(1 << 63) if page_id is None else page_id


class Reader:
    """Looks captures up in one index file; keeps the last block and some open archives."""

    def __init__(self, base: str, name: str):
        self.files, self.base = file_system(base)
        self.source = self.files.open_input_file(f"{self.base}/{name}")
        size = self.source.size()
        tail = self.source.read_at(16, size - 16)
        at, n = int.from_bytes(tail[:8], "little"), int.from_bytes(tail[8:], "little")
        self.directory = json.loads(zlib.decompress(self.source.read_at(n, at)))
        self.firsts = [_rank(k, i) for k, i, _, _ in self.directory]
        self.block, self.lines, self.ranks = -1, [], []
        self.archives: dict[str, object] = {}

    def _load(self, block: int) -> None:
        if block != self.block:
            _, _, at, n = self.directory[block]
            self.lines = [json.loads(x) for x in zlib.decompress(self.source.read_at(n, at)).decode().split("\n")]
            self.ranks, self.block = [_rank(x[0], x[1]) for x in self.lines], block

    def captures(self, key: str, page_id: int | None) -> Iterator[list]:
        """Index lines of a key and id, from the block that they begin in to the one that they end in."""
        want = _rank(key, page_id)
        block = max(0, bisect_right(self.firsts, (want[0], want[1] - 1)) - 1)
        while block < len(self.directory) and self.firsts[block] <= want:
            self._load(block)
            for i in range(bisect_right(self.ranks, (want[0], want[1] - 1)), len(self.ranks)):
                if self.ranks[i] != want:
                    break
                yield self.lines[i]
            block += 1

    def read(self, line: list) -> dict:
        name, offset, length = line[2:5]
        if name not in self.archives:
            if len(self.archives) >= 32:
                self.archives.pop(next(iter(self.archives))).close()
            self.archives[name] = self.files.open_input_file(f"{self.base}/{name}")
        return parse(zlib.decompress(self.archives[name].read_at(length, offset), 31))

    def close(self) -> None:
        for x in (self.source, *self.archives.values()):
            x.close()


def lookup(spark: SparkSession, out: str, wanted: DataFrame, id_col: str = "page_id", url_col: str = "url", payload: bool = True) -> DataFrame:
    """Reads the captures of the wanted (id, url) pairs from the archives below ``out``.

    Each distinct pair is looked up once and gives every capture of it; a pair without
    captures gives no row.
    """
    shards = sorted((_rank(r.key, r.page_id), r.file) for r in spark.read.parquet(f"{out}/files").collect())  # INDEX_FILES rows at most
    firsts, names = [x for x, _ in shards], [x for _, x in shards]
    target, with_payload = out, payload

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [url_key(u) for u in column(batch, "url").to_pylist()]
            shard = [max(0, bisect_right(firsts, _rank(k, i)) - 1) for k, i in zip(keys, column(batch, "page_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(keys, pa.string()), column(batch, "page_id")], names=["shard", "key", "page_id"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader = -1, None
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                found = []
                for row in batch.slice(start, 512).to_pylist():
                    if row["shard"] != at:
                        if reader:
                            reader.close()
                        at, reader = row["shard"], Reader(target, names[row["shard"]])
                    found += [reader.read(x) for x in reader.captures(row["key"], row["page_id"])]
                if not with_payload:
                    found = [x | {"payload": None} for x in found]
                yield pa.RecordBatch.from_pylist(found, schema=schema)
        if reader:
            reader.close()

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    pairs = wanted.select(col(id_col).cast("long").alias("page_id"), col(url_col).alias("url"))
    if not shards:
        return spark.createDataFrame([], _FOUND)
    routed = pairs.mapInArrow(route, "shard int, key string, page_id long").distinct()
    return routed.repartition(len(shards), "shard").sortWithinPartitions("shard", "key", "page_id").mapInArrow(read, _FOUND)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes all pages into the shared folder and reads every capture back through the index."""
    spark = pages.sparkSession
    out = scratch(spark, "warc")
    write_archives(pages, out, id_col, url_col, html_col, least_bytes)
    return lookup(spark, out, pages, id_col, url_col, payload=False)
