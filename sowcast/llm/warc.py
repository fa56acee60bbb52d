"""WARC archives as seekable Zstandard bundles.

An archive is a row of independent Zstandard frames, each with whole records, and
ends with a seek table in a skippable frame, so any Zstandard reader can unpack
it. An index table maps record identifiers to archive, frame and place inside the
frame; one record is read by unpacking one frame.

Of records with equal payloads of some size, that with the largest id is written as
a response and the others refer to it. Rows that repeat the largest id are all
responses; rows without an id refer to one that has it, if any. Null payloads are
empty. An empty table makes no archive.

Archives are written by tasks into a folder that all executors share, under names
of their own. The index is a table that Spark commits, so archives of attempts that
failed are never read.
"""

import hashlib
import math
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sowcast.sources.scratch import scratch_dir, stored

# Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("archive", T.StringType()),
        T.StructField("frame", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)
FRAMES = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("frame", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("packed", T.LongType()),
    ]
)
RECORDS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


# What Spark calls a scheme, and what the tasks' file systems call it.
SCHEMES = {
    "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs",
    "abfs": "abfs", "abfss": "abfss", "hdfs": "hdfs", "viewfs": "viewfs",
}


def task_uri(uri: str) -> str:
    """The place that Spark calls ``uri`` as tasks have to call it; raises where tasks
    can't write. HDFS takes its native library on the executors."""
    scheme, colon, rest = uri.partition(":")
    if uri.startswith("/"):
        scheme, rest = "file", uri
    elif not colon or "/" in scheme:
        raise ValueError(f"not an absolute place: {uri}")
    if scheme not in SCHEMES:
        raise ValueError(f"archives can't be written to {scheme}: use one of {', '.join(SCHEMES)}")
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    return f"{SCHEMES[scheme]}:{rest}"


def _file(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(task_uri(uri))


def record_bytes(record_id: str, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: str | None, date: str) -> bytes:
    """One record; a revisit holds the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer, from packed and unpacked sizes."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(source) -> list[tuple[int, int]]:
    """Start and packed size of each frame of an open file."""
    end = source.size()
    source.seek(end - 9)
    count, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the archive")
    source.seek(end - 9 - 8 * count)
    table, frames, start = source.read(8 * count), [], 0
    for packed, _ in struct.iter_unpack("<II", table):
        frames.append((start, packed))
        start += packed
    return frames


def parse_record(raw: bytes) -> dict:
    """The fields of one record, with the payload of a response checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, whole = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "response"
    if whole and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "record_id": fields["WARC-Record-ID"][1:-1],
        "record_type": fields["WARC-Type"],
        "target_uri": fields.get("WARC-Target-URI"),
        "refers_to": fields["WARC-Refers-To"][1:-1] if not whole else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if whole else None,
    }


class _Archive:
    """Writes one archive and yields index rows for the frames that are complete."""

    def __init__(self, folder: str, frame_bytes: int, level: int):
        import zstandard

        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        fs, path = _file(self.uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.pack, self.frame_bytes = fs.open_output_stream(path, compression=None), zstandard.ZstdCompressor(level=level).compress, frame_bytes
        self.frames: list[tuple[int, int]] = []
        self.buffer, self.rows, self.written = bytearray(), [], 0

    def add(self, record_id: str, raw: bytes) -> list[tuple]:
        done = self.flush() if self.buffer and len(self.buffer) + len(raw) > self.frame_bytes else []
        self.rows.append((record_id, self.uri, len(self.frames), len(self.buffer), len(raw)))
        self.buffer += raw
        return done

    def flush(self) -> list[tuple]:
        if self.buffer:
            packed = self.pack(bytes(self.buffer))
            self.out.write(packed)
            self.frames.append((len(packed), len(self.buffer)))
            self.written += len(packed)
        done, self.rows, self.buffer = self.rows, [], bytearray()
        return done

    def close(self) -> list[tuple]:
        done = self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return done


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    revisit_from: int = 1000,
    frame_bytes: int = 1 << 20,
    archive_bytes: int = 1 << 30,
    level: int = 3,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row into archives under ``folder`` and return the index."""
    task_uri(folder)  # a place that tasks can't write to is refused before any job
    payload = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_column).cast("string").alias("page"),
        F.col(id_column).alias("id"),
        F.col(url_column).alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("same"),
    )
    # one row per payload that repeats, found without moving payloads
    first = stored(
        rows.where(F.octet_length("payload") >= revisit_from)
        .groupBy("same")
        .agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND largest IS NOT NULL"),
        "repeats",
    )
    refers = F.when(~F.col("id").eqNullSafe(F.col("largest")) & F.col("largest").isNotNull(), F.col("largest").cast("string"))
    decided = rows.join(first, "same", "left").select(
        "page",
        "url",
        F.octet_length("payload").cast("long").alias("size"),
        F.sha1("payload").alias("digest"),
        refers.alias("refers"),
        F.when(refers.isNull(), F.col("payload")).alias("payload"),
    )
    types = to_arrow_schema(INDEX)

    def name(page: str | None) -> str:
        return f"urn:x-page:{page or ''}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            for page, url, size, digest, refers_to, body in zip(*(batch.column(i) for i in range(6))):
                archive = archive or _Archive(folder, frame_bytes, level)
                own = name(page.as_py())
                target = None if refers_to.as_py() is None else name(refers_to.as_py())
                raw = record_bytes(own, url.as_py(), body.as_py(), size.as_py(), digest.as_py(), target, date)
                done += archive.add(own, raw)
                if archive.written >= archive_bytes:
                    done, archive = done + archive.close(), None
            if done:
                yield _batch(done, types)
                done = []
        if archive:
            yield _batch(archive.close(), types)

    return stored(decided.mapInArrow(write, INDEX), "index")


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)


def archive_frames(archives: DataFrame) -> DataFrame:
    """Every frame of the archives, from their seek tables."""
    types = to_arrow_schema(FRAMES)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = _file(uri)
                with fs.open_input_file(path) as source:
                    rows = [(uri, i, *f) for i, f in enumerate(read_seek_table(source))]
                yield _batch(rows, types)

    return archives.select("archive").distinct().mapInArrow(look, FRAMES)


def _unpacked(frames: Iterator[tuple[str, int, int]]) -> Iterator[bytes]:
    import zstandard

    for uri, start, packed in frames:
        fs, path = _file(uri)
        with fs.open_input_file(path) as source:
            source.seek(start)
            yield zstandard.ZstdDecompressor().decompress(source.read(packed))


def _records(raw: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([parse_record(r) for r in raw], schema=to_arrow_schema(RECORDS))


def read_archives(spark: SparkSession, index: DataFrame, frames_per_task: int = 32) -> DataFrame:
    """All records of the archives that the index names, in whatever order."""
    frames = stored(archive_frames(index), "frames")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for frame in _unpacked(zip(*(batch.column(c).to_pylist() for c in ("archive", "start", "packed")))):
                raw, at = [], 0
                while at < len(frame):
                    head = frame.index(b"\r\n\r\n", at) + 4
                    end = head + int(re.search(rb"\r\nContent-Length: (\d+)\r\n", frame[at:head])[1]) + 4
                    raw.append(frame[at:end])
                    at = end
                yield _records(raw)

    tasks = max(1, math.ceil(frames.count() / frames_per_task))
    return frames.repartition(tasks).mapInArrow(read, RECORDS)


def fetch_records(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records with these identifiers (column ``record_id``): each frame that
    holds some of them is unpacked once, and no other."""
    frames = stored(archive_frames(index.join(record_ids.select("record_id").distinct(), "record_id")), "frames")
    wanted = (
        index.join(record_ids.select("record_id").distinct(), "record_id")
        .groupBy("archive", "frame")
        .agg(F.collect_list(F.struct("offset", "length")).alias("places"))
        .join(frames, ["archive", "frame"])
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("places").to_pylist()
            unpacked = _unpacked(zip(*(batch.column(c).to_pylist() for c in ("archive", "start", "packed"))))
            for frame, own in zip(unpacked, places):
                yield _records([frame[p["offset"] : p["offset"] + p["length"]] for p in own])

    return wanted.mapInArrow(read, RECORDS)


def page_records(pages: DataFrame, **options) -> DataFrame:
    """Write the pages, read the archives back, and report what each record says."""
    spark = pages.sparkSession
    id_type = pages.schema[options.get("id_column", "page_id")].dataType
    index = write_archives(pages, scratch_dir(spark, "warc"), **options)

    def page(record_id):
        return F.nullif(F.regexp_replace(record_id, "^urn:x-page:", ""), F.lit("")).cast(id_type)

    return read_archives(spark, index).select(
        page(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page(F.col("refers_to")).alias("refers_to"),
        F.col("target_uri"),
    )
