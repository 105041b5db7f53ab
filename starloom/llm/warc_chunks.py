"""WARC archives written from pages and read back as a table of payload chunks.

One record per page, each its own gzip member, in files of a bounded size. Of the pages with equal
payloads of at least `REVISIT_BYTES`, that with the least id is a response record with the payload;
the others are revisit records, which hold headers only. Writing tasks name their files themselves
and return the names, so that a task that ran twice leaves files that no manifest lists.

The reader never holds a record: it passes blocks of `BLOCK` bytes through the decompressor and
emits a row (record id, chunk number) for each `CHUNK` bytes of payload. Every row carries the
length and SHA-256 of the payload up to its end, so the last row of a record has those of the whole
payload and no aggregation is needed.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.texts import pieces
from starloom.session import materialise, prepare, work_path

REVISIT_BYTES = 100
BLOCK = 1 << 18
CHUNK = 1 << 16
FILE_BYTES = 64 << 20
ROWS = 64
_GZIP = 31

# Fixed values of the format: the version line, and the profile of a revisit with an equal payload.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{digest}')}>"


def _head(lines: dict[str, object]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in lines.items() if v is not None)


def record(page_id: int | None, url: str | None, size: int, digest: str, refers_to: int | None, date: str) -> tuple[bytes, int]:
    """The headers of a record up to its payload, and how many payload bytes follow them."""
    http = b"HTTP/1.1 200 OK\r\n" + _head({"Content-Type": "text/html; charset=utf-8", "Content-Length": size}) + b"\r\n"
    follows = size if refers_to is None else 0
    revisit = {} if refers_to is None else {
        "WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "X-Refers-To-Page": refers_to}
    warc = VERSION + b"\r\n" + _head({
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": date, "WARC-Target-URI": None if url is None else quote(url, safe="/:?#[]@!$&'()*+,;=~"),
        "WARC-Payload-Digest": f"sha256:{digest}", "X-Page": page_id, **revisit,
        "Content-Type": "application/http; msgtype=response", "Content-Length": len(http) + follows,
    }) + b"\r\n"
    return warc + http, follows


class _Archive:
    """Files of about `FILE_BYTES`, started one after the other in a folder that all tasks reach."""

    def __init__(self, folder: str):
        self.folder, (self.files, self.root) = folder, fs.FileSystem.from_uri(folder)
        self.out, self.done = None, []

    def add(self, head: bytes, payload: memoryview) -> None:
        if self.out is None:
            self.name, self.size, self.records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
            self.out = self.files.open_output_stream(f"{self.root}/{self.name}", compression=None)
        press = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
        self._write(press.compress(head))
        for i in range(0, len(payload), BLOCK):
            self._write(press.compress(payload[i:i + BLOCK]))
        self._write(press.compress(b"\r\n\r\n") + press.flush())
        self.records += 1
        if self.size >= FILE_BYTES:
            self.close()

    def _write(self, part: bytes) -> None:
        self.out.write(part)
        self.size += len(part)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.folder}/{self.name}", self.records, self.size))  # with the store's scheme
            self.out = None


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives into the shared `folder`; returns their manifest (path, records, bytes).

    A null payload is empty. A page without an id is a response only if no page with an id has its
    payload. Pages that share id and payload are all responses; an empty table writes no file.
    """
    prepare(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    sizes = rows.select("page_id", "digest", F.octet_length("payload").alias("size"))
    shared = sizes.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null")
    shared = materialise(shared.select(F.col("digest").alias("d"), "first"))
    marked = rows.join(shared, F.col("digest") == F.col("d"), "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    date = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Archive(folder)
        for batch in pieces(batches):
            ids, urls, payloads, digests, firsts = (batch.column(i) for i in range(5))
            for i in range(batch.num_rows):
                body = memoryview(payloads[i].as_buffer())  # no copy of the payload
                head, follows = record(ids[i].as_py(), urls[i].as_py(), len(body), digests[i].as_py(), firsts[i].as_py(), date)
                archive.add(head, body[:follows])
        archive.close()
        columns = list(zip(*archive.done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            ["path", "records", "bytes"])

    return materialise(marked.mapInArrow(run, "path string, records bigint, bytes bigint"))


class _Stream:
    """Decompressed bytes of a file of gzip members, a block at a time."""

    def __init__(self, file):
        self.file, self.unpack, self.raw, self.held, self.at = file, zlib.decompressobj(_GZIP), b"", b"", 0
        self.inside = False  # a member

    def more(self) -> bool:
        """Whether there were more bytes; a file that ends inside a member is an error."""
        while True:
            if self.unpack.eof:
                self.raw, self.unpack, self.inside = self.unpack.unused_data, zlib.decompressobj(_GZIP), False
            self.raw = self.raw or self.file.read(BLOCK)
            if not self.raw:
                if self.inside:
                    raise EOFError("the archive ends inside a record")
                return False
            self.inside = True
            data = self.unpack.decompress(self.raw, BLOCK)
            self.raw = self.unpack.unconsumed_tail
            if data:
                self.held, self.at = self.held[self.at:] + data, 0
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (end := self.held.find(mark, self.at)) < 0:
            if not self.more():
                if self.at < len(self.held):
                    raise EOFError("the archive ends inside a record's headers")
                return None
        found, self.at = self.held[self.at:end], end + len(mark)
        return found

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if self.at == len(self.held) and not self.more():
                raise EOFError("the archive ends inside a record")
            part = self.held[self.at:self.at + n]
            self.at, n = self.at + len(part), n - len(part)
            yield part


def _fields(block: bytes) -> dict[str, str]:
    lines = (line.partition(": ") for line in block.decode().split("\r\n")[1:])
    return {name.lower(): value for name, _, value in lines}


def _records(stream: _Stream) -> Iterator[tuple]:
    """(headers, chunk number, chunk, bytes so far, digest so far, whether it is the record's last)."""
    while (head := stream.until(b"\r\n\r\n")) is not None:
        warc = _fields(head)
        http = stream.until(b"\r\n\r\n")
        if http is None:
            raise EOFError("the archive ends inside a record's headers")
        left = int(warc["content-length"]) - len(http) - 4
        if warc["warc-type"] == "revisit":
            size, digest = int(_fields(http)["content-length"]), warc["warc-payload-digest"].partition(":")[2]
            yield warc, 0, b"", size, digest, True
        else:
            digest, size, number, chunk = hashlib.sha256(), 0, 0, bytearray()
            for part in stream.take(left):
                for i in range(0, len(part), CHUNK):
                    if len(chunk) >= CHUNK:
                        yield warc, number, bytes(chunk), size, digest.hexdigest(), False
                        number, chunk = number + 1, bytearray()
                    piece = part[i:i + CHUNK]
                    digest.update(piece)
                    size += len(piece)
                    chunk += piece
            yield warc, number, bytes(chunk), size, digest.hexdigest(), True
        for _ in stream.take(4):
            pass


def chunks(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per chunk of the archives in the manifest; a record has at least one.

    record_id, chunk, last, page_id, url, record_type, refers_to (page id), stated_digest, bytes and
    digest (of the payload up to this chunk's end; of a revisit as its headers state) and, unless
    left out, the chunk's `data`. Chunks hold `CHUNK` bytes to twice that, the last one fewer. A file
    that ends inside a record, or has another number of records than its manifest says, is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, stated in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = 0
                files, name = fs.FileSystem.from_uri(path)
                with files.open_input_stream(name, compression=None) as file:
                    rows = []
                    for warc, number, data, size, digest, last in _records(_Stream(file)):
                        page, refers, url = warc.get("x-page"), warc.get("x-refers-to-page"), warc.get("warc-target-uri")
                        row = (warc["warc-record-id"], number, last, None if page is None else int(page),
                               None if url is None else unquote(url), warc["warc-type"], None if refers is None else int(refers),
                               warc["warc-payload-digest"].partition(":")[2], size, digest)
                        rows.append(row + (data,) * payloads)
                        seen += last
                        if len(rows) == ROWS:
                            yield _batch(rows, schema)
                            rows = []
                    if rows:
                        yield _batch(rows, schema)
                if seen != stated:
                    raise EOFError(f"{path} has {seen} records, its manifest says {stated}")

    text, number = pa.string(), pa.int64()
    schema = pa.schema([("record_id", text), ("chunk", number), ("last", pa.bool_()), ("page_id", number), ("url", text),
                        ("record_type", text), ("refers_to", number), ("stated_digest", text), ("bytes", number),
                        ("digest", text)] + [("data", pa.binary())] * payloads)
    columns = ("record_id string, chunk bigint, last boolean, page_id bigint, url string, record_type string, "
               "refers_to bigint, stated_digest string, bytes bigint, digest string" + ", data binary" * payloads)
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "records").repartition(tasks, "path").mapInArrow(run, columns)  # a few names become many rows


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read one row per record back."""
    folder = f"{work_path(pages.sparkSession)}.warc"
    if "://" not in folder:
        folder = re.sub(r"^file:/*", "/", folder)
    path = pages.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(pages.sparkSession.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    manifest = write(pages, folder)
    read = chunks(manifest, payloads=False).filter("last")
    return read.withColumn("intact", F.col("digest") == F.col("stated_digest"))


def sql(table: str = "pages") -> str:
    """What the round trip must give, as DuckDB SQL over the pages."""
    return f"""
    with payloads as (
        select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from {table}
    ), firsts as (
        select payload_digest, min(page_id) as first from payloads where payload_bytes >= {REVISIT_BYTES} group by 1
    )
    select page_id, cast(payload_bytes as bigint) as payload_bytes, p.payload_digest,
           if(first is null or first is not distinct from page_id, 'response', 'revisit') as record_type,
           if(first is distinct from page_id, first, null) as refers_to, true as intact
    from payloads p left join firsts f on f.payload_digest = p.payload_digest"""
