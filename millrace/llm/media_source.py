"""Media columns: texts as images in archives, and a Spark data source that reads archives by byte ranges.

`write_archives` turns each text into an image (8-bit grey samples, 192 to a row; the text's UTF-8 bytes padded with
spaces to a positive multiple of 192) and stores the images uncompressed in ZIP archives of about 32 MB in the shared
folder. `spark.read.format("millrace_archive")` plans a partition for each byte range of each archive; a partition
reads the members whose header lies in its range, streams them as Arrow batches of at most 8 MB, and opens a member
again at its own offset when reading it fails, so one bad read costs one member and not its partition. A member that
fails four times ends the job, or with the option damaged = null gives a row with null media and the reason in `error`.
The planner reads names and sizes from the table of names, a file of it at a time, and a task gets its own range only; an
archive's directory is read by the tasks.

Archives are named after the task attempt that writes them and a table of names is written by Spark, so archives of
failed or repeated attempts are never read.

Defined results: a null text counts as empty and gives one row of spaces; null doc_ids and repeated rows keep their
rows; an empty table gives no archive and an empty result; further columns are ignored. A store must be one that
both Hadoop and Arrow know (file, hdfs, s3a, gs).
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from millrace.llm._shared import fresh_path, slices, texts_of

ROW, ARCHIVE_BYTES, ARCHIVE_MEMBERS, RANGE_BYTES, BATCH_BYTES, TRIES = 192, 32 << 20, 50_000, 8 << 20, 8 << 20, 4
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_image(payload: bytes) -> bytes:
    """A PNG whose samples are the payload, a multiple of 192 bytes."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    lines = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1).tobytes()
    header = struct.pack(">IIBBBBB", ROW, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines, 1)) + _chunk(b"IEND", b"")


def from_image(image: bytes) -> bytes:
    """The samples of a PNG as `to_image` writes it."""
    if image[:8] != _SIGNATURE:
        raise ValueError("not a PNG")
    at, lines = 8, b""
    while at < len(image):
        size, kind = struct.unpack(">I4s", image[at : at + 8])
        body = image[at + 8 : at + 8 + size]
        if struct.unpack(">I", image[at + 8 + size : at + 12 + size])[0] != zlib.crc32(kind + body):
            raise ValueError("damaged chunk")
        lines += body if kind == b"IDAT" else b""
        at += 12 + size
    return np.frombuffer(zlib.decompress(lines), np.uint8).reshape(-1, ROW + 1)[:, 1:].tobytes()


#: What Hadoop calls a store, and what Arrow calls it.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    scheme, mark, rest = folder.partition(":")
    return fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + mark + rest)


def _qualified(spark: SparkSession, folder: str) -> str:
    """folder with its scheme; one without is in Hadoop's default file system, as for Spark's own readers."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString().replace("file:/", "file:///", 1)


def _again(action, failures: tuple, pause: float = 0.1):  # noqa: ANN001, ANN202
    """action(), up to TRIES times."""
    for attempt in range(TRIES):
        try:
            return action()
        except failures:
            if attempt == TRIES - 1:
                raise
            time.sleep(pause * 2**attempt)
    raise AssertionError


def write_archives(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> str:
    """Write the archives of df's texts; returns the folder of the table of their names."""
    spark = df.sparkSession
    folder = _qualified(spark, fresh_path(spark, "archives"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        buffer, members = io.BytesIO(), 0
        archive = zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED)

        def close() -> pa.RecordBatch:
            archive.close()
            name, body = f"{uuid.uuid4().hex}.zip", buffer.getvalue()
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(body)
            return pa.RecordBatch.from_pydict({"name": [f"{folder}/{name}"], "members": [members], "bytes": [len(body)]})

        for batch, data, offsets in slices(batches, "text"):
            for key, raw in zip(batch.column(0).to_pylist(), texts_of(data, offsets), strict=True):
                info = zipfile.ZipInfo(f"{members}.png")
                info.comment = json.dumps({"doc_id": key, "n_bytes": len(raw)}).encode()
                archive.writestr(info, to_image(raw + b" " * (-len(raw) % ROW or (0 if raw else ROW))))
                members += 1
                if buffer.tell() >= ARCHIVE_BYTES or members >= ARCHIVE_MEMBERS:
                    yield close()
                    buffer, members = io.BytesIO(), 0
                    archive = zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED)
        if members:
            yield close()

    names = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "name string, members long, bytes long")
    names.write.parquet(f"{folder}-names")
    return f"{folder}-names"


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, stop: int) -> None:
        self.path, self.start, self.stop = path, start, stop


class ArchiveReader(DataSourceReader):
    """Reads members (doc_id, n_bytes, media, error) of the archives in the table of names at the option `names`."""

    def __init__(self, options: dict) -> None:
        self.names = options["names"]
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.keep_damaged = options.get("damaged", "fail") == "null"

    def partitions(self) -> list[ByteRange]:
        store, base = _store(self.names)
        files = [f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet")]
        found = []
        for file in files:
            listed = pq.read_table(file, columns=["name", "bytes"], filesystem=store)
            for path, size in zip(listed["name"].to_pylist(), listed["bytes"].to_pylist(), strict=True):
                found += [ByteRange(path, at, at + self.range_bytes) for at in range(0, size, self.range_bytes)]
        return found or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        folder, name = partition.path.rsplit("/", 1)
        store, base = _store(folder)
        path = f"{base}/{name}"

        def directory() -> list[zipfile.ZipInfo]:
            with store.open_input_file(path) as whole, zipfile.ZipFile(whole) as listed:
                return listed.infolist()

        members = [m for m in _again(directory, (OSError, ValueError, zipfile.BadZipFile)) if partition.start <= m.header_offset < partition.stop]
        out: list[tuple] = []
        held, handle = 0, None

        def media_of(member: zipfile.ZipInfo) -> bytes:
            nonlocal handle
            try:
                if handle is None:
                    handle = store.open_input_file(path)
                return self.member(handle, member)
            except (OSError, ValueError):
                if handle is not None:
                    handle.close()
                    handle = None
                raise

        try:
            for member in members:
                tags, error = json.loads(member.comment), None
                try:
                    media = _again(lambda member=member: media_of(member), (OSError, ValueError))
                except (OSError, ValueError) as failure:
                    if not self.keep_damaged:
                        raise
                    media, error = None, f"{member.filename} at {member.header_offset}: {failure}"
                out.append((tags["doc_id"], tags["n_bytes"], media, error))
                held += len(media or b"")
                if held >= BATCH_BYTES or len(out) >= 2000:
                    yield self.batch(out)
                    out, held = [], 0
        finally:
            if handle is not None:
                handle.close()
        if out:
            yield self.batch(out)

    @staticmethod
    def member(handle: pa.NativeFile, member: zipfile.ZipInfo) -> bytes:
        """One stored member, by its own offset; a damaged one raises."""
        handle.seek(member.header_offset)
        header = handle.read(30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError("no member here")
        name, extra = struct.unpack("<HH", header[26:30])
        handle.seek(member.header_offset + 30 + name + extra)
        media = handle.read(member.compress_size)
        if zlib.crc32(media) != member.CRC:
            raise ValueError("damaged member")
        return media

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "media", "error"])


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "millrace_archive"

    def schema(self) -> str:
        return "doc_id long, n_bytes long, media binary, error string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, names: str, range_bytes: int = RANGE_BYTES, damaged: str = "fail") -> DataFrame:
    """doc_id, n_bytes, media, error of all members of the archives named in a table of `write_archives`.

    damaged: what a member that can't be read does: "fail" ends the job, "null" gives a row with null media and the error.
    """
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("millrace_archive").option("names", names).option("range_bytes", range_bytes).option("damaged", damaged).load()


def features_of(payload: bytes) -> str:
    """Mean and deviation of the samples, share of neighbours that differ by over 32, and the busiest sample."""
    x = np.frombuffer(payload, np.uint8).astype(np.float64)
    steps = np.abs(np.diff(x))
    return f"mean={x.mean():.4f};std={x.std():.4f};edges={(steps > 32).mean():.4f};mode={np.bincount(x.astype(np.int64)).argmax()};rows={len(x) // ROW}"


def media_columns(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature of each row's text, read back from the archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media = batch.column(2).to_pylist()
            payloads = [from_image(m) for m in media]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(p) for p in payloads], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
                    pa.array([zlib.crc32(p[-16:]) for p in payloads], pa.int64()),
                    pa.array([len(m) for m in media], pa.int64()),
                    pa.array([hashlib.sha256(m).hexdigest() for m in media]),
                    pa.array([features_of(p) for p in payloads]),
                ],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    stored = read_archives(df.sparkSession, write_archives(df, text, doc_id))
    return stored.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
