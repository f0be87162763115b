"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with some records, and a seek table in a
skippable frame at its end (the public seekable format): any reader of Zstandard reads the whole file, and
a reader that knows the table reads one frame. An index maps each record to bundle, frame and the record's
offset within the uncompressed frame. Records are read back through it: each bundle that it names is opened,
its seek table read from its end, and only the frames that hold records of the index are fetched.

Payloads that recur are written once. Spark groups the SHA-1 digests, never the payloads; the record with
the largest page_id of a group is the `response`, the others are `revisit` records that refer to it. The
table of revisits is broadcast if its counted rows are few and joined by shuffle otherwise. Each task
writes its bundles under names of its own attempt, first under another name, then renamed. What a lost or
repeated attempt leaves behind is in no index row, so it is never read.

Defined cases: null html is an empty payload, and all empty payloads are equal. Payloads shorter than
min_bytes are all responses. If the largest page_id of a group has several rows, each is a response. A row
without page_id is written under the id `null`; it is a response only if no row of its group has an id,
and it is read back with a null page_id. A null url is written as an empty target. A very long payload is a
frame of its own, and a bundle may be longer than bundle_bytes by one record. Ids are integers or strings
without `>` and line ends. Other columns are never read. An empty table gives no bundles and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import shared_path, small_side, stage

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 1 << 23, 3
MIN_BYTES = 0
#: There is no capture time in the data, so all records carry this one.
DATE = "1970-01-01T00:00:00Z"

# Magic numbers of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_ID = "urn:page:"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool, date: str = DATE) -> bytes:
    """One WARC 1.1 record. Fields that begin with X- are extensions for what a revisit leaves out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if is_revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", f"<{_ID}{'null' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if is_revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{_ID}{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_records(data: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, block) of each record in uncompressed data, from a record's offset on."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if head[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        fields = dict(x.split(": ", 1) for x in head[1:])
        size = int(fields["Content-Length"])
        yield at, fields, data[end + 4 : end + 4 + size]
        at = end + 8 + size


class BundleWriter:
    """Collects records into frames; finish() gives the bundle's bytes."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.frame_bytes, self.compressor = frame_bytes, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.open, self.size = bytearray(), 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and offset in it of the record."""
        if self.open and len(self.open) + len(data) > self.frame_bytes:
            self._close()
        at = len(self.frames), len(self.open)
        self.open += data
        return at

    def _close(self) -> None:
        packed = self.compressor.compress(bytes(self.open))
        self.frames.append((len(packed), len(self.open)))
        self.parts.append(packed)
        self.size += len(packed)
        self.open = bytearray()

    def finish(self) -> bytes:
        if self.open:
            self._close()
        table = b"".join(struct.pack("<II", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        return b"".join([*self.parts, struct.pack("<II", SKIPPABLE, len(table)), table])


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, uncompressed size) of each frame, from the end of the bundle."""
    count, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    table = bundle[len(bundle) - 9 - count * entry : len(bundle) - 9]
    out, at = [], 0
    for k in range(count):
        packed, size = struct.unpack_from("<II", table, k * entry)
        out.append((at, packed, size))
        at += packed
    return out


class BundleReader:
    """Reads records of a bundle in a seekable file; the seek table is read once, and each frame when it is wanted."""

    def __init__(self, file):
        self.file, self.codec = file, zstandard.ZstdDecompressor()
        size = file.seek(0, os.SEEK_END)
        # The footer tells the table's length.
        file.seek(max(0, size - 9))
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        length = count * (12 if flags & 0x80 else 8) + 9
        file.seek(size - length)
        self.table = seek_table(file.read(length))
        self.open: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        if self.open[0] != number:
            at, packed, size = self.table[number]
            self.file.seek(at)
            self.open = number, self.codec.decompress(self.file.read(packed), max_output_size=size)
        return self.open[1]

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        """The record that the index has at this frame and offset; only that frame is decompressed."""
        _, fields, block = next(parse_records(self.frame(frame), offset))
        return fields, block


def _system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if urlsplit(folder).scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), urlsplit(folder).path
    return pyarrow.fs.FileSystem.from_uri(folder)


def _put(folder: str, name: str, data: bytes) -> None:
    fs, base = _system(folder)
    fs.create_dir(base, recursive=True)
    hidden = f"{base}/_{name}.{os.getpid()}-{os.urandom(4).hex()}"
    with fs.open_output_stream(hidden) as f:
        f.write(data)
    fs.move(hidden, f"{base}/{name}")


def write_bundles(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes pages (page_id, url, html) to folder; the index: page_id, bundle, frame, record_offset, record_bytes."""
    kind = dict(pages.dtypes)["page_id"]
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    pages = pages.select("page_id", "url", payload.alias("payload"))
    digests = stage(pages.select("page_id", F.unhex(F.sha1("payload")).alias("digest"), F.length("payload").alias("n")), "warc-digests")
    groups = digests.filter(F.col("n") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("size"))
    groups = stage(groups.filter("size > 1 and refers_to is not null").drop("size"), "warc-groups")
    again = digests.join(groups, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to").distinct()
    again = small_side(stage(again, "warc-revisits"))
    # A page_id may have several rows with different payloads, so the digest is compared as well.
    same = pages["page_id"].eqNullSafe(again["again_id"]) & (F.unhex(F.sha1(pages["payload"])) == again["again_digest"])
    marked = pages.join(again, same, "left").select("page_id", "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = f"{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId():08d}", 0
        writer, rows = BundleWriter(frame_bytes), []

        def close() -> pa.RecordBatch:
            name = f"part-{part}-{number:06d}.warc.zst"
            _put(folder, name, writer.finish())
            ids, places, sizes = zip(*rows, strict=True)
            columns = [pa.array(ids), pa.array([name] * len(rows)), pa.array([x[0] for x in places], pa.int32()), pa.array([x[1] for x in places], pa.int64()), pa.array(sizes, pa.int64())]
            columns[0] = columns[0].cast(id_type[0])
            return pa.RecordBatch.from_arrays(columns, names=["page_id", "bundle", "frame", "record_offset", "record_bytes"])

        id_type = []
        for batch in batches:
            id_type[:] = [batch.schema.field("page_id").type]
            for page_id, url, data, refers in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                target = refers.as_py()
                made = record(page_id.as_py(), url.as_py(), data.as_py(), target, target is not None)
                rows.append((page_id.as_py(), writer.add(made), len(made)))
                if writer.size + len(writer.open) >= bundle_bytes:
                    yield close()
                    writer, rows, number = BundleWriter(frame_bytes), [], number + 1
        if rows:
            yield close()

    return marked.mapInArrow(run, f"page_id {kind}, bundle string, frame int, record_offset long, record_bytes long")


_READ = "payload_bytes long, payload_digest string, record_type string, refers_to {kind}, payload binary"


def read_bundles(folder: str, index: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per row of the index (page_id, bundle, frame, record_offset), from the records that it names.

    Digests and lengths of responses are computed from the payloads that were read. The index is staged, and a
    bundle's part of it is one row: it is bounded by the bundle's size.
    """
    kind = dict(index.dtypes)["page_id"]
    as_id = (lambda x: x) if kind == "string" else int
    per_bundle = index.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("frame", "record_offset", "page_id"))).alias("places"))
    per_bundle = stage(per_bundle, "warc-places")
    per_bundle = per_bundle.repartition(max(1, per_bundle.count()))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if payloads else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _system(folder)
        id_type = pa.string() if kind == "string" else pa.int64()
        types = (id_type, pa.int64(), pa.string(), pa.string(), id_type, pa.binary())[: len(names)]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for part in batches:
            for name, places in zip(part.column("bundle").to_pylist(), part.column("places").to_pylist(), strict=True):
                with fs.open_input_file(f"{base}/{name}") as file:
                    reader, rows, size = BundleReader(file), [], 0
                    for place in places:
                        fields, block = reader.record(place["frame"], place["record_offset"])
                        payload = block.split(b"\r\n\r\n", 1)[1]
                        page, refers = (None if x in ("", "null") else as_id(x) for x in (fields[k][len(_ID) + 1 : -1] if k in fields else "" for k in ("WARC-Record-ID", "WARC-Refers-To")))
                        if page != place["page_id"]:
                            raise ValueError(f"{name} has {page!r} where the index has {place['page_id']!r}")
                        revisit = fields["WARC-Type"] == "revisit"
                        digest, length = (fields["WARC-Payload-Digest"][5:], int(fields["X-Payload-Length"])) if revisit else (digest_of(payload), len(payload))
                        rows.append((page, length, digest, fields["WARC-Type"], refers, None if revisit else payload)[: len(names)])
                        size += len(payload) if payloads else 0
                        if size > FRAME_BYTES or len(rows) >= 4096:
                            yield batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch(rows)

    schema = f"page_id {kind}, " + _READ.format(kind=kind)
    return per_bundle.mapInArrow(run, schema if payloads else schema.removesuffix(", payload binary"))


def lookup(folder: str, index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of some ids (page_id), payloads included: only their frames are read."""
    return read_bundles(folder, index.join(ids.select("page_id").distinct(), "page_id", "left_semi"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages to a new folder of bundles and reads them back through the index, without the payloads."""
    folder = shared_path(pages.sparkSession, "warc")
    return read_bundles(folder, stage(write_bundles(pages, folder), "warc-index"), payloads=False)
