"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle ends with a
skippable frame that holds the seek table (the published seekable format:
compressed and decompressed size of each frame). An index maps each record to
its bundle, frame and offset within the decompressed frame, so one record costs
one frame. Pages with equal payloads are stored once: the smallest page_id is a
response, the others are revisit records that refer to it.

Only digests are grouped; pages are then dealt by page_id, so a payload that
very many pages share is no hot key. A bundle's name follows from its task, place and
content, so a task that runs again writes the same file; bundles that no index row names
are leftovers. Where the shared folder isn't a mounted path the bundles are
kept as rows of the index table instead of files.

Edge cases: a null html is an empty payload, and payloads of at least
``min_payload`` bytes (0: also empty ones) take part; a null page_id is always
a response, a null url has no target; rows that repeat page_id and html repeat
their record.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, new_path

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Spec:
    min_payload: int = 0
    #: Bytes of records in a frame before it is closed, and of frames in a bundle.
    frame_bytes: int = 256_000
    bundle_bytes: int = 32_000_000
    level: int = 3
    date: str = "1970-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    return int(x) if (x := record_id.removeprefix("<urn:x-page:").removesuffix(">")) else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, spec: Spec) -> bytes:
    """One WARC record; a revisit holds the HTTP header alone, which still tells the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {spec.date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers in lower case, block, end) of the record at a place."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    start = end + 4
    stop = start + int(head["content-length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("the record is cut off")
    return head, data[start:stop], stop + 4


def facts(head: dict[str, str], block: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a parsed record; a response's payload must fit its digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError("the payload does not fit its digest")
    refers = _page_id(head["warc-refers-to"]) if head["warc-type"] == "revisit" else None
    return _page_id(head["warc-record-id"]), size, digest, head["warc-type"], refers


class BundleWriter:
    """Collects records into frames and frames into one bundle."""

    def __init__(self, spec: Spec):
        self.spec, self.packer = spec, zstandard.ZstdCompressor(level=spec.level)
        self.out, self.table, self.frame, self.index = bytearray(), [], bytearray(), []

    def add(self, page_id: int | None, data: bytes) -> None:
        self.index.append((page_id, len(self.table), len(self.frame), len(data)))
        self.frame += data
        if len(self.frame) >= self.spec.frame_bytes:
            self.close_frame()

    def close_frame(self) -> None:
        if self.frame:
            packed = self.packer.compress(bytes(self.frame))
            self.table.append((len(packed), len(self.frame)))
            self.out += packed
            self.frame = bytearray()

    def finish(self) -> bytes:
        self.close_frame()
        entries = b"".join(struct.pack("<II", *x) for x in self.table)
        self.out += struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        return bytes(self.out)


class BundleReader:
    """Frames of a bundle by number; ``read(start, n)`` returns n bytes of it."""

    def __init__(self, read, size: int):
        self.read = read
        count, _, magic = struct.unpack("<IBI", read(size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("the bundle has no seek table")
        entries = read(size - 9 - 8 * count, 8 * count)
        self.frames, at = [], 0
        for i in range(count):
            packed, plain = struct.unpack_from("<II", entries, 8 * i)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, plain = self.frames[i]
        return zstandard.ZstdDecompressor().decompress(self.read(at, packed), max_output_size=plain)

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for i in range(len(self.frames)):
            data, at = self.frame(i), 0
            while at < len(data):
                head, block, at = parse(data, at)
                yield head, block


def open_bundle(path: str, data: bytes | None) -> BundleReader:
    if data is not None:
        return BundleReader(lambda at, n: data[at : at + n], len(data))
    f = open(path, "rb")  # noqa: SIM115

    def read(at: int, n: int) -> bytes:
        f.seek(at)
        return f.read(n)

    return BundleReader(read, os.path.getsize(path))


def revisits(pages: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a smaller page_id has; digest is hexadecimal."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    each = pages.select(F.col("page_id").cast("long"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n")).filter((F.col("n") >= spec.min_payload) & F.col("page_id").isNotNull())
    first = each.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).filter("refers_to < last").select("digest", "refers_to")
    return each.join(first, "digest").filter("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()


def mounted(spark: SparkSession, folder: str) -> str | None:
    """The path of a folder that Spark too takes for a local file's (where it is shared, a mount), else None."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(place).toUri().getPath() if system.getScheme() == "file" else None


INDEX = "bundle string, page_id long, frame int, offset int, length int, data binary"


def write(pages: DataFrame, folder: str, spec: Spec = Spec()) -> DataFrame:
    """Writes the archives of pages(page_id, url, html) below a folder and returns their index, itself a table there."""
    spark = pages.sparkSession
    local = mounted(spark, folder)
    if local:
        os.makedirs(f"{local}/bundles", exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(w: BundleWriter) -> pa.RecordBatch:
            data = w.finish()
            name = f"{TaskContext.get().partitionId():06d}-{next(number):05d}-{hashlib.sha1(data).hexdigest()}.warc.zst"
            if local:
                path = f"{local}/bundles/{name}"
                with open(f"{path}.{os.getpid()}.{id(w)}", "wb") as f:
                    f.write(data)
                os.replace(f.name, path)
                name = path
            rows = [(name, *x, None) for x in w.index]
            if not local:
                rows.append((name, None, None, None, None, data))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [x.split()[0] for x in INDEX.split(", ")])

        w, number = BundleWriter(spec), itertools.count()
        for b in batches:
            for page_id, url, payload, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                w.add(page_id, record(page_id, url, payload, refers, spec))
                if len(w.out) >= spec.bundle_bytes:
                    yield close(w)
                    w = BundleWriter(spec)
        if w.index:
            yield close(w)

    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).join(revisits(pages, spec), ["page_id", "digest"], "left").select("page_id", "url", "payload", "refers_to")
    rows.transform(mapped, run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in the bundles of an index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = [facts(*x) for x in open_bundle(path, data).records()]
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    bundles = index.groupBy("bundle").agg(F.max("data").alias("data"))
    return bundles.transform(mapped, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def fetch(index: DataFrame, page_ids: DataFrame) -> DataFrame:
    """page_id, record binary for the wanted page_ids: of each bundle only the frames that hold them are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, frame, reader, data = None, None, None, b""
        for b in batches:
            out = []
            for p, f, offset, length, page_id, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p != path:
                    path, frame, reader = p, None, open_bundle(p, raw)
                if f != frame:
                    frame, data = f, reader.frame(f)
                out.append((page_id, data[offset : offset + length]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["page_id", "record"])

    wanted = index.filter("frame is not null").drop("data").join(page_ids.select("page_id").distinct(), "page_id")
    wanted = wanted.join(index.filter("data is not null").select("bundle", "data"), "bundle", "left").select("bundle", "frame", "offset", "length", "page_id", "data")
    return wanted.repartition("bundle").sortWithinPartitions("bundle", "frame", "offset").transform(mapped, run, "page_id long, record binary")


def archived(spark: SparkSession, pages: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """Writes the archives of pages to the shared folder and reads them back."""
    return read(write(pages, new_path(spark, "warc"), spec))
