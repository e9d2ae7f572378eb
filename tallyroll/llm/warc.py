"""Web archives in seekable Zstandard bundles.

Pages become WARC records, grouped into independent frames of a bundle; a skippable frame at its
end, in the public seekable format, lists the frames' sizes. An index table maps each record to
its bundle, frame, and offset inside the frame, so one record costs one read of one frame. Equal
payloads are stored once: the page with the least id has it, the others are revisits of that page.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.batches import kept_table, text_slices
from tallyroll.session import scratch_path

# Record bytes from which a bundle, and at most of a frame, are closed, before compression.
BUNDLE_BYTES = 32 << 20
FRAME_BYTES = 1 << 20
# Bundles that a task reads back, one after another.
BUNDLES_A_TASK = 2
# Shorter payloads are never revisits.
SHORTEST_SHARED = 100
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the seekable format and of the archive format's revisit profile.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "bundle string, page_id long, record_id string, frame int, offset long, length long"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(identifier: str) -> int | None:
    value = identifier.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def to_record(
    page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, date: str = DATE
) -> bytes:
    """The bytes of a response record, or of a revisit record if there is no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}"]
    if url is not None:
        # A header's value is one line.
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda found: f"%{ord(found[0]):02X}", url))
    lines += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}"]
    if payload is None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    block = http + (payload or b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, at: int) -> tuple[dict[str, str], int]:
    end = data.index(b"\r\n\r\n", at)
    _, *lines = data[at:end].decode().split("\r\n")
    return dict(line.split(": ", 1) for line in lines), end + 4


def from_records(data: bytes) -> Iterator[tuple]:
    """The records of a frame: page id, url, type, page referred to, payload size, digest and payload.

    Size and digest of a stored payload are measured; a revisit gives those of the page it repeats.
    """
    at = 0
    while at < len(data):
        warc, block = _headers(data, at)
        end = block + int(warc["Content-Length"])
        http, body = _headers(data, block)
        kind = warc["WARC-Type"]
        url = warc.get("WARC-Target-URI")
        if url is not None:
            url = re.sub("%([01][0-9A-F]|20|7F|25)", lambda found: chr(int(found[1], 16)), url)
        payload = data[body:end] if kind == "response" else None
        if payload is None:
            size, digest = int(http["Content-Length"]), warc["WARC-Payload-Digest"].removeprefix("sha256:")
        else:
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        refers_to = _page_id(warc["WARC-Refers-To"]) if "WARC-Refers-To" in warc else None
        yield _page_id(warc["WARC-Record-ID"]), url, kind, refers_to, size, digest, payload
        at = end + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that lists compressed and plain sizes of all frames."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    footer = struct.pack("<IBI", len(frames), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer


def frame_places(file: pa.NativeFile) -> list[tuple[int, int]]:
    """Start and compressed size of every frame, from the table at the file's end."""
    size = file.size()
    count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != _SEEKABLE:
        raise ValueError("the bundle has no seek table")
    entries = file.read_at(8 * count, size - 9 - 8 * count)
    places, at = [], 0
    for compressed, _ in struct.iter_unpack("<II", entries):
        places.append((at, compressed))
        at += compressed
    return places


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class _Bundle:
    """A bundle being written: records fill a frame, frames follow each other, the table ends it.

    It is written beside its place and renamed, so a task that runs again leaves one whole file.
    """

    def __init__(self, folder: str, name: str, attempt: int, frame_bytes: int = FRAME_BYTES):
        self.frame_bytes = frame_bytes
        self.files, base = _store(folder)
        self.name, self.path, self.staged = name, f"{base}/{name}", f"{base}/.{name}.{attempt}"
        self.files.create_dir(base, recursive=True)
        self.out = self.files.open_output_stream(self.staged, compression=None)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.filled = self.size = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        if self.filled and self.filled + len(record) > self.frame_bytes:
            self._flush()
        place = (len(self.frames), self.filled)
        self.parts.append(record)
        self.filled += len(record)
        self.size += len(record)
        return place

    def _flush(self) -> None:
        data = b"".join(self.parts)
        packed = zstandard.ZstdCompressor().compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data)))
        self.parts, self.filled = [], 0

    def close(self) -> None:
        if self.filled:
            self._flush()
        self.out.write(seek_table(self.frames))
        self.out.close()
        if self.files.get_file_info(self.path).type == fs.FileType.NotFound:
            self.files.move(self.staged, self.path)
        else:
            self.files.delete_file(self.staged)


def planned(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, size, refers_to``: html is null where the page is a revisit."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html"),
    )
    rows = rows.withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html").cast("long")})
    # Payloads that occur once need no join; those that repeat are folded before the shuffle.
    shared = (
        rows.where(F.col("size") >= SHORTEST_SHARED)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    # An id that is the least is a response in every row that has it.
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(shared, "digest", "left").select(
        "page_id",
        "url",
        F.when(~revisit, F.col("html")).alias("html"),
        "digest",
        "size",
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def write_bundles(
    pages: DataFrame, folder: str | None = None, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> tuple[str, DataFrame]:
    """Write ``pages(page_id, url, html)`` as bundles under a shared folder: the folder and its index.

    A row each: ``bundle, page_id, record_id, frame, offset, length``. A null html is an empty
    payload, a null page_id is written as none, a null url is left out. Rows that repeat an id and
    its payload are responses if the id is the least. Other columns are ignored; an empty table
    makes no bundles.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    # A partition of the join makes its own bundles, so the payloads move once, if at all. In one
    # order, a task that runs again makes them anew as they were.
    rows = planned(pages).sortWithinPartitions("digest", "page_id", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        bundle, made = None, 0
        for batch in batches:
            for part in text_slices(batch, "html"):
                found = []
                for row in part.to_pylist():
                    if bundle is None or bundle.size >= bundle_bytes:
                        if bundle:
                            bundle.close()
                        name = f"pages-{task.partitionId():06d}-{made:04d}.warc.zst"
                        bundle, made = _Bundle(folder, name, task.taskAttemptId(), frame_bytes), made + 1
                    record = to_record(row["page_id"], row["url"], row["html"], row["size"], row["digest"], row["refers_to"])
                    frame, offset = bundle.add(record)
                    found.append((bundle.name, row["page_id"], record_id(row["page_id"]), frame, offset, len(record)))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
                columns = [pa.array(values, kind) for values, kind in zip(zip(*found, strict=True), kinds, strict=True)]
                names = ["bundle", "page_id", "record_id", "frame", "offset", "length"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if bundle:
            bundle.close()

    return folder, kept_table(rows.mapInArrow(run, _INDEX), "warc-index")


def read_bundles(folder: str, index: DataFrame) -> DataFrame:
    """Every record of the bundles an index names, read frame by frame."""
    bundles = kept_table(index.select("bundle").distinct(), "warc-bundles")
    # Under adaptive execution a set number of tasks stays, however small the names are.
    tasks = max(1, -(-bundles.count() // BUNDLES_A_TASK))
    bundles = bundles.repartition(tasks, "bundle")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _store(folder)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                with files.open_input_file(f"{base}/{name}") as file:
                    for start, size in frame_places(file):
                        data = zstandard.ZstdDecompressor().decompress(file.read_at(size, start))
                        columns = zip(*from_records(data), strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], names=names)

    return bundles.mapInArrow(run, _RECORD)


def read_record(folder: str, bundle: str, frame: int, offset: int, length: int) -> tuple:
    """One record by its place in the index: only its frame is read."""
    files, base = _store(folder)
    with files.open_input_file(f"{base}/{bundle}") as file:
        start, size = frame_places(file)[frame]
        data = zstandard.ZstdDecompressor().decompress(file.read_at(size, start))
    return next(from_records(data[offset : offset + length]))


def page_records(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` as read back from written bundles."""
    records = read_bundles(*write_bundles(pages))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
