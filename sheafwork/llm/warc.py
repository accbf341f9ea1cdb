"""WARC records in seekable Zstandard bundles.

A bundle's bytes are independent Zstandard frames of several records each, then the seek table of the seekable format as a
skippable frame. An index maps each record's identifier to its frame and the offset in that frame, so one record costs
one frame. Identifiers are the bundle's name and the record's number in it; bundles are named by run, task and number, so
no two records share one, whatever the page ids. Bundles are rows of a table in the shared folder, so Spark commits them
and any store serves them; ``export_archives`` puts them down as files that other WARC tools open. Payloads of at least
``LEAST_REVISIT`` bytes are stored once: the record of the smallest id holds it, the others are revisits of that one.

Defined cases: a null payload counts as empty; records of a null id are written without one, and are never the one that
others revisit unless all have none; rows that repeat the smallest id are all responses; an empty table gives no bundle;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

LEAST_REVISIT = 100
#: Bytes of records in a frame and in a bundle, about; a longer record has a frame of its own.
FRAME, BUNDLE = 1 << 17, 1 << 22
#: Fixed values of the seekable format: the skippable frame's magic number and the footer's.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1

BUNDLES = "bundle string, content binary, records array<struct<record_id:string,page_id:bigint,frame:int,offset:int,length:int>>"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
_RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
_INDEX = pa.list_(pa.struct([("record_id", pa.string()), ("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())]))


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Each page with its payload's digest and, for a revisit, the id that holds the payload."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    firsts = rows.where(F.octet_length("payload") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    again = written(firsts.where(F.col("n") > 1).drop("n"), "payload-copies")  # a table, so that the join can split a payload of very many copies
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(again, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _record(record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
        payload = b""
    return "\r\n".join([*head, f"Content-Length: {len(payload)}", "", ""]).encode() + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


class BundleWriter:
    """Collects records; ``take`` gives the bundle's bytes and index."""

    def __init__(self, level: int = 3):
        import zstandard

        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self.reset()

    def reset(self) -> None:
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.buffer = bytearray()
        self.index: list[dict] = []
        self.size = 0

    def add(self, record_id: str, record: bytes, page_id: int | None = None) -> None:
        if self.buffer and len(self.buffer) + len(record) > FRAME:
            self.cut()
        self.index.append({"record_id": record_id, "page_id": page_id, "frame": len(self.frames), "offset": len(self.buffer), "length": len(record)})
        self.buffer += record
        self.size += len(record)

    def cut(self) -> None:
        frame = self.compress(bytes(self.buffer))
        self.sizes.append((len(frame), len(self.buffer)))
        self.frames.append(frame)
        self.buffer = bytearray()

    def take(self) -> tuple[bytes, list[dict]]:
        if self.buffer:
            self.cut()
        entries = b"".join(struct.pack("<II", *x) for x in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, _SEEKABLE)
        seek = struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer
        found = b"".join(self.frames) + seek, self.index
        self.reset()
        return found


class BundleReader:
    """Reads records of a bundle by frame and offset, by its seek table."""

    def __init__(self, content: bytes):
        import zstandard

        n, _, magic = struct.unpack("<IBI", content[-9:])
        if magic != _SEEKABLE:
            raise ValueError("no seek table")
        entries = content[-9 - 8 * n : -9]
        if struct.unpack("<II", content[-17 - 8 * n : -9 - 8 * n]) != (_SKIPPABLE, 8 * n + 9):
            raise ValueError("the seek table's frame is damaged")
        self.content, self.decompress = content, zstandard.ZstdDecompressor().decompress
        self.starts, at = [], 0
        for packed, size in struct.iter_unpack("<II", entries):
            self.starts.append((at, packed, size))
            at += packed
        self.current: tuple[int, bytes] = (-1, b"")

    def record(self, frame: int, offset: int, length: int) -> bytes:
        if self.current[0] != frame:
            at, packed, size = self.starts[frame]
            self.current = frame, self.decompress(self.content[at : at + packed], max_output_size=size)
        return self.current[1][offset : offset + length]


def write_bundles(records: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Bundles of ``plan_records``' rows."""
    run_id = uuid.uuid4().hex[:12]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, writer = TaskContext.get().partitionId(), 1, BundleWriter()
        name = lambda: f"{run_id}-{part:05d}-{n:05d}.warc.zst"

        def bundle() -> pa.RecordBatch:
            content, index = writer.take()
            return pa.RecordBatch.from_arrays([pa.array([name()]), pa.array([content], pa.binary()), pa.array([index], _INDEX)], names=["bundle", "content", "records"])

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                record_id = f"urn:bundle:{name()}:{len(writer.index)}"
                writer.add(record_id, _record(record_id, page_id, url, payload.encode(), digest, refers_to, date), page_id)
                if writer.size >= BUNDLE:
                    yield bundle()
                    n += 1
        if writer.size:
            yield bundle()

    return records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, BUNDLES)


def read_record(bundles: DataFrame, record_id: str) -> tuple[dict[str, str], bytes] | None:
    """Header and payload of one record: its bundle by name, its place by the index, one frame's bytes."""
    bundle = record_id.removeprefix("urn:bundle:").rpartition(":")[0]
    entry = F.get(F.filter("records", lambda r: r["record_id"] == record_id), F.lit(0))
    found = bundles.where(F.col("bundle") == bundle).select("content", entry.alias("e")).where("e IS NOT NULL").first()
    return found and parse_record(BundleReader(bytes(found["content"])).record(found["e"]["frame"], found["e"]["offset"], found["e"]["length"]))


def export_archives(bundles: DataFrame, uri: str) -> None:
    """Each bundle as a file in the folder ``uri`` of a store that all executors reach (file, hdfs, s3, ...). A file is put down
    under another name first and moved when it is whole, so a task that runs again or twice leaves the same files."""

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(uri)
        store.create_dir(folder, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = f"{folder}/_{name}-{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(content.as_py())
                store.move(part, f"{folder}/{name}")
            yield batch.select(["bundle"])

    bundles.select("bundle", "content").mapInArrow(put, "bundle string").write.format("noop").mode("overwrite").save()


def read_bundles(bundles: DataFrame) -> DataFrame:
    """One row per record, from its frame; digests of responses are taken from the payload that is read."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, index in zip(batch.column(0), batch.column(1)):
                reader, rows = BundleReader(content.as_py()), []
                for entry in index.as_py():
                    fields, payload = parse_record(reader.record(entry["frame"], entry["offset"], entry["length"]))
                    if fields["WARC-Record-ID"] != f"<{entry['record_id']}>":
                        raise ValueError("the index points to another record")
                    response = fields["WARC-Type"] == "response"
                    digest = hashlib.sha256(payload).hexdigest() if response else fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    page_id, refers_to = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                    rows.append({
                        "page_id": None if page_id is None else int(page_id),
                        "payload_bytes": len(payload) if response else int(fields["X-Payload-Length"]),
                        "payload_digest": digest,
                        "record_type": fields["WARC-Type"],
                        "refers_to": None if refers_to is None else int(refers_to),
                    })
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)

    return bundles.select("content", "records").mapInArrow(run, RECORDS)
