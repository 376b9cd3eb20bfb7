"""Media columns: archives of images in the shared folder, read by a data source of our own.

Writing turns each payload into an 8-bit grey PNG (its samples are the payload
bytes) and packs the images of a partition into stored ZIP archives. Reading
plans byte ranges over the archives of a folder: the planner lists files and
sizes only, a task reads the directory at the end of its archive, takes the
members whose header starts inside its range, and streams them in Arrow
batches of bounded size. A member that fails to read or to check is fetched
again by its own offset, without touching its neighbours.
"""

from __future__ import annotations

import hashlib
import math
import struct
import time
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from foliary.llm.common import SLICE_BYTES, text_slices

#: Samples in a row of an image; payloads are padded with spaces to whole rows.
ROW = 192
#: An archive is closed when it has reached this size.
ARCHIVE_BYTES = 64 << 20
#: Fixed values of the file formats.
PNG_SIGN = b"\x89PNG\r\n\x1a\n"
ZIP_LOCAL, ZIP_ENTRY, ZIP_END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
ZIP64_END, ZIP64_SEEK = b"PK\x06\x06", b"PK\x06\x07"
LOCAL_HEAD = struct.Struct("<4s5H3I2H")
ENTRY_HEAD = struct.Struct("<4s6H3I5H2I")
END_HEAD = struct.Struct("<4s4H2IH")
END64 = struct.Struct("<4sQ2H2I4Q")
SEEK64 = struct.Struct("<4sIQI")


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def pad(raw: bytes) -> bytes:
    """Spaces up to a positive multiple of ROW."""
    return raw + b" " * (max(1, math.ceil(len(raw) / ROW)) * ROW - len(raw))


def encode_png(raw: bytes) -> bytes:
    """A grey image of ROW columns whose samples are the padded payload; a private chunk keeps the unpadded length."""
    samples = np.frombuffer(pad(raw), np.uint8).reshape(-1, ROW)
    lines = np.zeros((len(samples), ROW + 1), np.uint8)  # filter type 0 before each line
    lines[:, 1:] = samples
    head = struct.pack(">IIBBBBB", ROW, len(samples), 8, 0, 0, 0, 0)
    return PNG_SIGN + _chunk(b"IHDR", head) + _chunk(b"plEn", struct.pack(">Q", len(raw))) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def decode_png(data: bytes) -> tuple[bytes, int]:
    """The samples and the unpadded length; ValueError if anything does not check."""
    if data[:8] != PNG_SIGN:
        raise ValueError("not a PNG")
    at, parts, head, length = 8, [], None, None
    while at < len(data):
        (size,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"plEn":
            (length,) = struct.unpack(">Q", body)
        elif kind == b"IDAT":
            parts.append(body)
        at += size + 12
    if head is None or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit grey image without interlace")
    lines = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(head[1], head[0] + 1)
    if lines[:, 0].any():
        raise ValueError("filtered lines")
    samples = lines[:, 1:].tobytes()
    return samples, len(samples) if length is None else length


def feature(samples: bytes) -> str:
    """Dimensions, mean, deviation, entropy in bits, and edge energy along lines, from the stored samples."""
    n = len(samples)
    values = np.frombuffer(samples, np.uint8)
    counts = np.bincount(values, minlength=256)
    level = np.arange(256)
    mean = float(counts @ level) / n
    spread = math.sqrt(max(0.0, float(counts @ (level * level)) / n - mean * mean))
    p = counts[counts > 0] / n
    edges = float(np.abs(np.diff(values.reshape(-1, ROW).astype(np.int16), axis=1)).sum(dtype=np.int64)) / n
    return f"{ROW}x{n // ROW};mean={mean:.4f};sd={spread:.4f};entropy={float(-(p * np.log2(p)).sum()):.4f};edge={edges:.4f}"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, on whichever machine this runs."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


class ArchiveWriter:
    """Stored members one after another, then a directory; made under another name and moved when whole."""

    def __init__(self, uri: str, name: str):
        self.fs, root = open_fs(uri)
        self.final, self.temporary = f"{root}/{name}", f"{root}/_{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temporary)
        self.size, self.entries, self.count = 0, [], 0

    def add(self, name: bytes, data: bytes) -> None:
        crc = zlib.crc32(data)
        self.entries.append(ENTRY_HEAD.pack(ZIP_ENTRY, 20, 20, 0x800, 0, 0, 0x21, crc, len(data), len(data), len(name), 0, 0, 0, 0, 0, self.size) + name)
        head = LOCAL_HEAD.pack(ZIP_LOCAL, 20, 0x800, 0, 0, 0x21, crc, len(data), len(data), len(name), 0) + name
        self.out.write(head + data)
        self.size += len(head) + len(data)
        self.count += 1

    def close(self) -> tuple[str, int, int]:
        listing = b"".join(self.entries)
        many = self.count > 0xFFFE
        tail = b""
        if many:
            end64 = END64.pack(ZIP64_END, 44, 45, 45, 0, 0, self.count, self.count, len(listing), self.size)
            tail = end64 + SEEK64.pack(ZIP64_SEEK, 0, self.size + len(listing), 1)
        n = 0xFFFF if many else self.count
        self.out.write(listing + tail + END_HEAD.pack(ZIP_END, 0, 0, n, n, len(listing), self.size, 0))
        self.out.close()
        self.fs.move(self.temporary, self.final)
        return self.final, self.count, self.size


def write_media(docs: DataFrame, uri: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each text as an image in archives under ``uri``; returns the manifest (archive, members, bytes).

    Null texts are stored as the empty text. An archive's name follows from its
    partition, and it appears whole or not at all, so a task that runs again
    replaces what an attempt before it wrote. The manifest is lazy: an action
    on it writes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, writer, seq = TaskContext.get().partitionId(), [], None, 0
        for batch in batches:
            for piece in text_slices(batch, text_col):
                for key, text in zip(piece.column(id_col).to_pylist(), piece.column(text_col).to_pylist(), strict=True):
                    writer = writer or ArchiveWriter(uri, f"part-{part:06d}-{len(made):05d}.zip")
                    writer.add(f"{seq:09d}/{'' if key is None else key}.png".encode(), encode_png((text or "").encode("utf-8")))
                    seq += 1
                    if writer.size >= ARCHIVE_BYTES:
                        made.append(writer.close())
                        writer = None
        if writer:
            made.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())], ["archive", "members", "bytes"])

    fs, root = open_fs(uri)
    fs.create_dir(root, recursive=True)
    return docs.select(id_col, text_col).mapInArrow(run, "archive string, members bigint, bytes bigint")


class ByteRange(InputPartition):
    """Members of one archive whose header starts at start <= offset < stop."""

    def __init__(self, path: str, size: int, start: int, stop: int):
        super().__init__((path, start, stop))
        self.path, self.size, self.start, self.stop = path, size, start, stop


class MediaArchive(DataSource):
    """``spark.read.format("media_archive").load(folder)``: one row per member of the stored ZIP archives there.

    Options: ``splitBytes`` (size of a byte range, 16 MiB), ``retries`` (per
    member, 3). A member that still fails yields a row with null ``data`` and
    the reason in ``error``; it never fails its neighbours.
    """

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return "archive string, position bigint, key string, data binary, error string"

    def reader(self, schema) -> DataSourceReader:
        return MediaArchiveReader(self.options)


class MediaArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri = options["path"]
        self.split = int(options.get("splitBytes", 16 << 20))
        self.retries = int(options.get("retries", 3))

    def partitions(self) -> list[ByteRange]:
        fs, root = open_fs(self.uri)
        found = sorted((x.path, x.size) for x in fs.get_file_info(pafs.FileSelector(root)) if x.is_file and x.base_name.endswith(".zip") and not x.base_name.startswith("_"))
        return [ByteRange(path, size, at, min(at + self.split, size)) for path, size in found for at in range(0, size, self.split)] or [ByteRange("", 0, 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = open_fs(self.uri)
        with fs.open_input_file(partition.path) as source:
            rows, held = [], 0
            for name, offset, size, crc in members(source, partition.size, partition.start, partition.stop):
                data, error = self.fetch(fs, source, partition.path, name, offset, size, crc)
                rows.append((partition.path.rsplit("/", 1)[-1], offset, name.split("/", 1)[-1].rsplit(".", 1)[0] or None, data, error))
                held += size
                if held >= SLICE_BYTES:
                    yield _rows(rows)
                    rows, held = [], 0
            if rows:
                yield _rows(rows)

    def fetch(self, fs, source, path: str, name: str, offset: int, size: int, crc: int) -> tuple[bytes | None, str | None]:
        """One member by its offset; tries again with the file opened anew."""
        why = ""
        for attempt in range(self.retries + 1):
            try:
                if attempt:
                    time.sleep(0.05 * 2**attempt)
                    with fs.open_input_file(path) as again:
                        return member(again, offset, size, crc), None
                return member(source, offset, size, crc), None
            except (OSError, ValueError, struct.error) as e:
                why = f"{name} at {offset}: {e}"
        return None, why


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["archive", "position", "key", "data", "error"])


def member(source, offset: int, size: int, crc: int) -> bytes:
    source.seek(offset)
    head = LOCAL_HEAD.unpack(source.read(LOCAL_HEAD.size))
    if head[0] != ZIP_LOCAL:
        raise ValueError("no member starts here")
    source.seek(offset + LOCAL_HEAD.size + head[9] + head[10])
    data = source.read(size)
    if len(data) != size or zlib.crc32(data) != crc:
        raise ValueError("short or damaged member")
    return data


def members(source, size: int, start: int, stop: int) -> Iterator[tuple[str, int, int, int]]:
    """(name, offset, size, checksum) of the directory's entries within the range."""
    back = min(size, 65557 + SEEK64.size)
    source.seek(size - back)
    tail = source.read(back)
    at = tail.rfind(ZIP_END)
    if at < 0:
        raise ValueError("no archive directory")
    end = END_HEAD.unpack_from(tail, at)
    length, begin = end[5], end[6]
    if end[4] == 0xFFFF and at >= SEEK64.size and tail[at - SEEK64.size :][:4] == ZIP64_SEEK:
        source.seek(SEEK64.unpack_from(tail, at - SEEK64.size)[2])
        whole = END64.unpack(source.read(END64.size))
        length, begin = whole[8], whole[9]
    source.seek(begin)
    listing, at = source.read(length), 0
    while at < length:
        e = ENTRY_HEAD.unpack_from(listing, at)
        name = listing[at + ENTRY_HEAD.size : at + ENTRY_HEAD.size + e[10]]
        if start <= e[16] < stop:
            yield name.decode("utf-8"), e[16], e[8], e[7]
        at += ENTRY_HEAD.size + e[10] + e[11] + e[12]


def read_media(spark: SparkSession, uri: str, **options) -> DataFrame:
    """Rows of the archives under ``uri``."""
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").options(**{k: str(v) for k, v in options.items()}).load(uri)


def media_features(media: DataFrame) -> DataFrame:
    """Features of stored images: (key, payload binary, n_bytes, media_bytes, feature, error). Damaged images get a reason and nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, "data"):
                out = [[], [], [], [], []]
                for data, error in zip(piece.column("data").to_pylist(), piece.column("error").to_pylist(), strict=True):
                    try:
                        if error is not None or data is None:
                            raise ValueError(error or "no data")
                        samples, n = decode_png(data)
                        row = (samples, n, len(data), feature(samples), None)
                    except (ValueError, zlib.error, struct.error) as e:
                        row = (None, None, None, None, str(e))
                    for column, x in zip(out, row, strict=True):
                        column.append(x)
                yield pa.RecordBatch.from_arrays([piece.column("key"), piece.column("data"), *(pa.array(c, k) for c, k in zip(out, [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()], strict=True))], ["key", "data", "payload", "n_bytes", "media_bytes", "feature", "error"])

    return media.select("key", "data", "error").mapInArrow(run, "key string, data binary, payload binary, n_bytes bigint, media_bytes bigint, feature string, error string")


def sha256_hex(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def store_and_read(docs: DataFrame, uri: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the texts of ``docs`` to archives, then the rows of :func:`media_features` read back from them.

    Fails if fewer members can be planned than rows were written.
    """
    spark = docs.sparkSession
    written = write_media(docs, uri, id_col, text_col).agg(F.sum("members").alias("n")).first()["n"] or 0
    fs, root = open_fs(uri)
    if written and not any(x.base_name.endswith(".zip") for x in fs.get_file_info(pafs.FileSelector(root))):
        raise RuntimeError(f"the archives of {written} rows are not in {uri}, which driver and executors must share")
    return media_features(read_media(spark, uri))
