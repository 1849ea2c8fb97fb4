"""Deterministic sharded WARC writing, and reading back.

Records are range-sorted by page_id, so shards hold rising, disjoint ranges. A
task writes its range as WARC 1.1 files of one gzip member a record, and starts a
new file when the compressed size passes ``ROLL_BYTES``. Headers are made anew:
digests from the payload, record ids and dates from the page alone, so the same
table gives the same bytes. A file is written under a temporary name of its own
and renamed when complete; a repeated or doubled task replaces a file by an equal one.
The archive is committed by its manifest: a table of the complete files, written by
Spark's own commit protocol after all tasks ended. Readers go by the manifest
only, so left-over files of failed attempts are never read.

Duplicates: of records whose payloads are equal (by SHA-1 and length) and have at
least ``MIN_BYTES`` bytes, the one with the smallest page_id is a response and the
others revisit it.

Files are written by executors through Arrow's file systems (local and shared
mounts, HDFS, S3, GCS), in the folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import base64
import hashlib
import io
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import fields, stored
from tidegate.workspace import fresh_folder

MIN_BYTES = 0
ROLL_BYTES = 256 * 1024 * 1024
#: Tasks that read files at most.
READERS = 10_000
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
EOL = b"\r\n"

MANIFEST = "file string, records bigint, bytes bigint, first_id bigint, last_id bigint, sha256 string"


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def target_uri(url: str | None) -> str:
    """The URL as one header value: control characters and spaces percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "about:blank")


def record_id(page_id: int | None, at: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{at}')}>"


def headers(lines: dict[str, object]) -> bytes:
    return EOL.join(f"{k}: {v}".encode() for k, v in lines.items() if v is not None) + EOL + EOL


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, at: int) -> bytes:
    """One WARC record, as a gzip member of its own. ``at`` tells repeated rows apart."""
    http = b"HTTP/1.1 200 OK\r\n" + headers(
        {"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)}
    )
    block = http if refers_to is not None else http + payload
    first = refers_to is None
    head = b"WARC/1.1\r\n" + headers(
        {
            "WARC-Type": "response" if first else "revisit",
            "WARC-Record-ID": record_id(page_id, at),
            "WARC-Date": DATE,
            "WARC-Target-URI": target_uri(url),
            "WARC-Page-ID": page_id,
            "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
            "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
            "WARC-Profile": None if first else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": None if first else record_id(refers_to, 0),
            "WARC-Refers-To-Page-ID": refers_to,
            "Content-Type": "application/http;msgtype=response",
            "Content-Length": len(block),
        }
    )
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head + block + EOL + EOL) + packer.flush()


class Roller:
    """One open file of a shard; rolled by compressed size, renamed when complete."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.store, self.path = file_system(folder)
        self.store.create_dir(self.path, recursive=True)
        self.shard, self.roll_bytes, self.part = shard, roll_bytes, 0
        self.stream = None

    def add(self, page_id: int | None, data: bytes) -> dict | None:
        """Write a record; the manifest row of the file that this completed, if any."""
        done = None
        if self.stream is not None and self.size + len(data) > self.roll_bytes:
            done = self.close()
        if self.stream is None:
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = posixpath.join(self.path, f".{self.name}.{uuid.uuid4().hex}.tmp")
            self.stream = self.store.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.digest = 0, 0, hashlib.sha256()
            self.first = page_id
        self.stream.write(data)
        self.digest.update(data)
        self.size += len(data)
        self.records += 1
        self.last = page_id
        return done

    def close(self) -> dict | None:
        if self.stream is None:
            return None
        self.stream.close()
        self.stream = None
        self.store.move(self.temporary, posixpath.join(self.path, self.name))
        self.part += 1
        return {
            "file": self.name,
            "records": self.records,
            "bytes": self.size,
            "first_id": self.first,
            "last_id": self.last,
            "sha256": self.digest.hexdigest(),
        }


def revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, refers_to): the rows whose payload occurs with a smaller page_id."""
    payload = F.coalesce("html", F.lit(""))
    hashed = (
        fields(pages, "page_id", "html")
        .where("page_id IS NOT NULL")
        .select(
            "page_id",
            F.unhex(F.sha1(F.encode(payload, "UTF-8"))).alias("digest"),
            F.octet_length(payload).alias("size"),
        )
        .where(F.col("size") >= min_bytes)
    )
    first = (
        hashed.groupBy("digest", "size")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return (
        hashed.join(first, ["digest", "size"])
        .where("page_id > refers_to")
        .select("page_id", "digest", "refers_to")
    )


def write(
    pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, roll_bytes: int = ROLL_BYTES
) -> DataFrame:
    """Write the archive under ``folder`` and return its manifest, read from its committed table.

    One record a row; a null html is an empty payload, a null url about:blank.
    Rows without page_id sort first and are always responses. Rows that repeat a
    page_id each give a record. An empty table gives an empty manifest. Columns
    other than page_id, url and html are ignored.
    """
    chosen = fields(pages, "page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    known = stored(revisits(chosen, min_bytes), "revisits")
    rows = chosen.select(
        "page_id", F.lit(1).alias("part"), F.lit(None).cast("long").alias("refers_to"),
        F.lit(None).cast("binary").alias("digest"), "url", "html",
    )
    marks = known.select(
        "page_id", F.lit(0).alias("part"), "refers_to", "digest",
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"),
    )
    # A mark travels just ahead of its page, so the pages are shuffled once.
    ordered = (
        rows.unionByName(marks)
        .repartitionByRange("page_id")
        .sortWithinPartitions("page_id", "part", "url", "html")
        .withColumn("shard", F.spark_partition_id())
    )
    at_folder = f"{folder}/records"

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, roller, marked, before, repeat = [], None, {}, None, 0
        schema = pa.schema(
            [("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()),
             ("first_id", pa.int64()), ("last_id", pa.int64()), ("sha256", pa.string())]
        )
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "part", "refers_to", "digest", "url")]
            payloads = batch.column("html").cast(pa.binary())
            shard = batch.column("shard")[0].as_py() if batch.num_rows else 0
            for i, (page_id, part, refers_to, digest, url) in enumerate(zip(*columns, strict=True)):
                if page_id != before:
                    marked, before, repeat = {}, page_id, 0
                if part == 0:
                    marked[digest] = refers_to
                    continue
                payload = payloads[i].as_py() or b""
                roller = roller or Roller(at_folder, shard, roll_bytes)
                refers = marked.get(hashlib.sha1(payload).digest()) if marked else None
                done = roller.add(page_id, record(page_id, url, payload, refers, repeat))
                repeat += 1
                if done:
                    files.append(done)
        if roller:
            files.append(roller.close())
        if files:
            yield pa.RecordBatch.from_pylist(files, schema=schema)

    ordered.mapInArrow(archive, MANIFEST).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def members(stream: io.RawIOBase) -> Iterator[bytes]:
    """The gzip members of a file, unpacked one at a time."""
    packed, unpacker, out = b"", zlib.decompressobj(31), []
    while True:
        if not packed:
            packed = stream.read(1 << 20)
            if not packed:
                break
        out.append(unpacker.decompress(packed))
        packed = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(out)
            unpacker, out = zlib.decompressobj(31), []
    if any(out):
        raise ValueError("a record is cut short")


def parse(data: bytes) -> dict:
    """The fields of one record; its digests and length are checked."""
    head, _, rest = data.partition(EOL + EOL)
    version, *lines = head.decode().split("\r\n")
    named = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(named["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != EOL + EOL:
        raise ValueError("not a whole WARC record")
    if named["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("a block does not match its digest")
    http, _, payload = block.partition(EOL + EOL)
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
    first = named["WARC-Type"] == "response"
    if first and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError("a payload does not match its digest")
    ids = [named.get("WARC-Page-ID"), named.get("WARC-Refers-To-Page-ID")]
    page_id, refers_to = (int(x) if x is not None else None for x in ids)
    return {
        "page_id": page_id,
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": named["WARC-Type"],
        "refers_to": refers_to,
        "url": named["WARC-Target-URI"],
        "payload": payload if first else None,
    }


RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, url string, payload binary"
)


def read(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the files in ``manifest``; ``payloads=False`` leaves the bodies out.

    Each file is a task's work, up to ``READERS`` tasks. File names weigh nothing, so the number
    is given: by their size alone all would be read in one task.
    """
    at_folder = f"{folder}/records"
    names = [c.split()[0] for c in RECORDS.split(", ")][: None if payloads else -1]
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
         ("payload", pa.binary())][: len(names)]
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(at_folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                held, size = [], 0
                with store.open_input_stream(posixpath.join(path, name), compression=None) as stream:
                    for data in members(stream):
                        row = parse(data)
                        held.append({n: row[n] for n in names})
                        size += len(data) if payloads else 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    chosen = manifest.select("file").repartition(max(1, min(READERS, manifest.count())))
    return chosen.mapInArrow(unpack, ", ".join(RECORDS.split(", ")[: len(names)]))


def round_trip(
    pages: DataFrame, min_bytes: int = MIN_BYTES, roll_bytes: int = ROLL_BYTES, payloads: bool = False
) -> DataFrame:
    """Write all pages to a fresh folder that all executors share, and read the archive back."""
    folder = fresh_folder(pages.sparkSession, "warc")
    return read(write(pages, folder, min_bytes, roll_bytes), folder, payloads)
