"""Operator 6: WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames; a bundle ends with a seek table in a
skippable frame (sizes of all frames, then their number and a magic number), so a
reader finds any frame from the end of the file.  The index table maps each record
to its bundle, frame and place within the frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm.frames import keep, prepare, small
from hiremart.session import scratch_path

#: Bytes of records in a frame and of frames in a bundle; Zstandard level.
FRAME_BYTES, BUNDLE_BYTES, LEVEL = 256 << 10, 64 << 20, 3

#: Neighbouring frames of a bundle read by one task (about 8 MB of records).
FRAMES_A_TASK = 32

#: Fixed values of the seekable format: skippable frame, footer.
SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1

_INDEX = pa.schema([("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int64()),
                    ("offset", pa.int64()), ("length", pa.int64())])


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI that driver and executors share."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def qualified(spark, path: str) -> str:
    """``path`` with the scheme that Spark resolves it by, so that tasks open the same place
    (a path without one is the cluster's default file system, not the executor's own disk)."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


def record_id(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    tail = record.strip("<>").rsplit(":", 1)[1]
    return None if tail == "null" else int(tail)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id, url: str | None, payload: bytes, first, revisit: bool) -> bytes:
    """One WARC/1.0 record; a revisit has the HTTP header (with the payload's length) only."""
    url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(first)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, length, headers, block)`` of the records of a frame."""
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at)
        lines = data[at:cut].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(head["Content-Length"])
        block = data[cut + 4:cut + 4 + size]
        end = cut + 4 + size + 4
        if len(block) != size or data[end - 4:end] != b"\r\n\r\n":
            raise ValueError(f"broken WARC record at {at}")
        yield at, end - at, head, block
        at = end


class BundleWriter:
    """One bundle file: frames, then the seek table.  ``close`` gives its index rows."""

    def __init__(self, folder: str):
        import zstandard
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, place = open_fs(self.path)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out, self.zstd = system.open_output_stream(place, compression=None), zstandard.ZstdCompressor(level=LEVEL)
        self.frames, self.rows, self.part, self.held, self.size = [], [], [], 0, 0

    def add(self, name: str, record: bytes) -> None:
        if self.held and self.held + len(record) > FRAME_BYTES:
            self.flush()
        self.rows.append((name, self.path, len(self.frames), self.held, len(record)))
        self.part.append(record)
        self.held += len(record)

    def flush(self) -> None:
        if self.part:
            packed = self.zstd.compress(b"".join(self.part))
            self.out.write(packed)
            self.frames.append((len(packed), self.held))
            self.size += len(packed)
            self.part, self.held = [], 0

    def close(self) -> list[tuple]:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        return self.rows


def seek_table(path: str) -> list[tuple[int, int, int]]:
    """``(position, compressed size, size)`` of every frame, read from the bundle's end."""
    system, place = open_fs(path)
    with system.open_input_file(place) as f:
        end = f.size()
        f.seek(end - 9)
        count, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEK_MAGIC:
            raise ValueError(f"{path}: no seek table")
        f.seek(end - 9 - 8 * count)
        sizes = list(struct.iter_unpack("<II", f.read(8 * count)))
    at, out = 0, []
    for packed, size in sizes:
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(path: str, entry: tuple[int, int, int]) -> bytes:
    import zstandard
    system, place = open_fs(path)
    with system.open_input_file(place) as f:
        f.seek(entry[0])
        return zstandard.ZstdDecompressor().decompress(f.read(entry[1]), max_output_size=entry[2])


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes a record per row of ``pages(page_id, url, html)`` and returns the index, a
    written table: ``record_id, bundle, frame, offset, length``.

    Of rows with equal payloads of at least ``least_bytes`` bytes those with the smallest
    page_id are responses, the others (null ids too) revisit it.  A null html is an
    empty payload; in a group of null ids only, all are responses.  Each task writes
    bundles of its own name into the shared folder and names them in the index, so a
    retried task leaves an unnamed file and no wrong record.
    """
    spark = prepare(pages.sparkSession)
    folder = qualified(spark, folder or scratch_path(spark, "warc"))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    long_enough = rows.where(F.octet_length("html") >= least_bytes)
    copies = keep(long_enough.select("page_id", F.sha1(F.col("html").cast("binary")).alias("h")).groupBy("h").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").drop("n"), "payloads")
    rows = rows.withColumn("h", F.sha1(F.col("html").cast("binary"))).join(small(copies, 500_000), "h", "left")
    rows = rows.select("page_id", "url", "html", "first", (
        F.col("first").isNotNull() & (F.octet_length("html") >= least_bytes)
        & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))

    def run(batches):
        out = None
        for b in batches:
            for page, url, text, first, revisit in zip(*(c.to_pylist() for c in b.columns)):
                out = out or BundleWriter(folder)
                out.add(record_id(page), make_record(page, url, text.encode("utf-8", "surrogatepass"), first, revisit))
                if out.size >= BUNDLE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out.close()), _INDEX)], schema=_INDEX)
                    out = None
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out.close()), _INDEX)], schema=_INDEX)

    return keep(rows.mapInArrow(run, "record_id string, bundle string, frame long, offset long, length long"), "warc_index")


_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string())])


def _record_row(head: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    cut = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:cut].decode().split("\r\n")[1:])
    kind, sha, payload = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:"), block[cut + 4:]
    if kind == "response" and (digest(payload) != sha or len(payload) != int(http["Content-Length"])):
        raise ValueError(f"{head['WARC-Record-ID']}: payload does not match its digest")
    return (page_of(head["WARC-Record-ID"]), int(http["Content-Length"]), sha, kind,
            page_of(head["WARC-Refers-To"]) if kind == "revisit" else None,
            payload.decode("utf-8", "replace") if with_payload and kind == "response" else None)


def read_archives(index: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of the bundles that the index names, read frame by frame through the seek
    tables: ``page_id, payload_bytes, payload_digest, record_type, refers_to`` (and the
    responses' ``payload``).  Payloads are checked against their digests.

    A task reads about ``FRAMES_A_TASK`` neighbouring frames: the number of tasks follows the
    index, whatever few bytes its rows have."""
    spark = index.sparkSession
    lots = keep(index.select("bundle", F.floor(F.col("frame") / FRAMES_A_TASK).alias("lot"), "frame").distinct()
                .groupBy("bundle", "lot").agg(F.sort_array(F.collect_list("frame")).alias("frames")), "warc_frames")
    tasks = max(1, lots.count())
    frames = lots.repartitionById(tasks, F.pmod(F.xxhash64("bundle", "lot"), F.lit(tasks)).cast("int")).select(
        "bundle", F.explode("frames").alias("frame"))
    schema = _RECORD if payloads else pa.schema(list(_RECORD)[:5])

    def run(batches):
        tables: dict[str, list] = {}
        for b in batches:
            for bundle, frame in zip(*(c.to_pylist() for c in b.columns)):
                if bundle not in tables:
                    if len(tables) > 256:
                        tables.clear()
                    tables[bundle] = seek_table(bundle)
                rows = [_record_row(head, block, payloads) for _, _, head, block in parse_records(read_frame(bundle, tables[bundle][frame]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return frames.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
                             + ", payload string" * payloads)


def fetch(index: DataFrame, records: DataFrame) -> DataFrame:
    """The raw records named in ``records(record_id)``: ``record_id, record`` (only their
    frames are read)."""
    schema = pa.schema([("record_id", pa.string()), ("record", pa.binary())])
    wanted = index.join(records.select("record_id").distinct(), "record_id", "left_semi")

    def run(batches):
        for b in batches:
            tables, rows = {}, []
            for name, bundle, frame, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                entry = tables.setdefault(bundle, seek_table(bundle) if bundle not in tables else None)[frame]
                rows.append((name, read_frame(bundle, entry)[offset:offset + length]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return wanted.select(*_INDEX.names).mapInArrow(run, "record_id string, record binary")
