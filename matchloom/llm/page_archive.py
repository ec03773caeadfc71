"""Web-archive (WARC) files of stored match and map pages, written and read back by index.

Records are the project's page snapshots: ``page_id``, ``url``, ``html``.

* A page is one gzip member per record, so any record can be read on its own.
* Every record's place is written first: file, offset, length, URL and digest
  form the index, and every later read starts from it.
* Equal payloads of at least ``min_shared`` bytes are stored once: the page with
  the largest ``page_id`` is the response and the others revisit it.
* Reads sort the selected index rows by file and offset and merge neighbours
  into ranges, so a selection costs few large reads instead of many small ones.

Defined results: null ``html`` is an empty payload; a null ``url`` writes no
target URI; a null ``page_id`` never becomes the response of a group that has a
known one; several rows with the winning ``page_id`` are all responses. Columns
besides the three are ignored. An empty table gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.session import Workspace

MIN_SHARED_BYTES = 1000
MAX_FILE_BYTES = 1 << 30
READ_BLOCK_BYTES = 16 << 20
MAX_GAP_BYTES = 64 << 10
MAX_RANGE_BYTES = 8 << 20

INDEX_SCHEMA = ("page_id long, url string, payload_digest string, payload_bytes long, record_type string, "
                "refers_to long, file string, offset long, length long")
RECORD_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to long, payload binary")


def plan_records(pages: DataFrame, work: Workspace, min_shared: int = MIN_SHARED_BYTES) -> DataFrame:
    """Give each page its payload, digest, record type and the response it refers to.

    Only payloads that occur more than once are joined, from a settled table:
    Spark splits the pages of a very common payload, and pages too small to be
    shared are spread by their id.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.length(payload).cast("long").alias("payload_bytes"),
                        F.sha1(payload).alias("payload_digest"))
    large = F.col("payload_bytes") >= min_shared
    shared = work.settle(
        rows.where(large).groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("pages")).where("pages > 1")
        .select(F.concat_ws("/", "payload_digest", "payload_bytes").alias("payload_key"), "holder"), "shared")
    keyed = rows.withColumn("payload_key", F.when(large, F.concat_ws("/", "payload_digest", "payload_bytes"))
                            .otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "payload_digest"))))
    revisit = F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("page_id"))
    return keyed.join(shared, "payload_key", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("holder")).alias("refers_to"))


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, as seen inside a task."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def record_id(page_id: int | None, digest: str) -> str:
    name = f"page/{page_id}" if page_id is not None else f"payload/{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def header(fields: list[tuple[str, object]]) -> bytes:
    lines = [f"{name}: {value}" for name, value in fields if value is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode()


def one_line(url: str | None) -> str | None:
    return None if url is None else url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def encode_record(row: dict, date: str) -> bytes:
    """One WARC record as a gzip member. A revisit keeps the headers only."""
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + row["payload"]
    head = header([
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", record_id(row["page_id"], row["payload_digest"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", one_line(row["url"])),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", record_id(row["refers_to"], row["payload_digest"]) if revisit else None),
        ("X-Page-Id", row["page_id"]),
        ("X-Refers-To-Page-Id", row["refers_to"]),
        ("X-Payload-Length", row["payload_bytes"]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ])
    return gzip_member(head + block + b"\r\n\r\n")


def decode_record(member: bytes) -> dict:
    """The inverse of ``encode_record``; a payload that misses its digest is an error."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    number = {name: int(fields[name]) if name in fields else None for name in ("X-Page-Id", "X-Refers-To-Page-Id")}
    url = fields.get("WARC-Target-URI")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    payload, size = None, int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"record {fields['WARC-Record-ID']} does not hold the payload of its digest")
    return {"page_id": number["X-Page-Id"],
            "url": None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
            "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": number["X-Refers-To-Page-Id"], "payload": payload}


class ArchiveWriter:
    """Archive files of one task attempt. A failed attempt leaves files that no index names."""

    def __init__(self, folder: str, date: str):
        self.fs, self.path = open_folder(folder)
        self.date, self.out, self.offset = date, None, 0
        self.fs.create_dir(self.path, recursive=True)

    def add(self, row: dict) -> tuple[str, int, int]:
        if self.out is None or self.offset >= MAX_FILE_BYTES:
            self.open()
        member = encode_record(row, self.date)
        self.out.write(member)
        place = self.name, self.offset, len(member)
        self.offset += len(member)
        return place

    def open(self) -> None:
        self.close()
        self.name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        info = b"software: matchloom\r\nformat: WARC File Format 1.1\r\n"
        member = gzip_member(header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                     ("WARC-Date", self.date), ("WARC-Filename", self.name),
                                     ("Content-Type", "application/warc-fields"), ("Content-Length", len(info))])
                             + info + b"\r\n\r\n")
        self.out.write(member)
        self.offset = len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def write_archives(pages: DataFrame, work: Workspace, folder: str, *, date: str = "1970-01-01T00:00:00Z",
                   min_shared: int = MIN_SHARED_BYTES) -> DataFrame:
    """Write all pages below ``folder`` (shared by all executors) and return the settled index."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, date)
        for batch in batches:
            places = [writer.add(row) for row in batch.to_pylist()]
            files, offsets, lengths = zip(*places, strict=True) if places else ((), (), ())
            kept = batch.drop_columns(["payload"])
            yield pa.RecordBatch.from_arrays(
                [*(kept.column(name) for name in ("page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to")),
                 pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                names=["page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to", "file", "offset", "length"])
        writer.close()
    return work.settle(plan_records(pages, work, min_shared).mapInArrow(write, INDEX_SCHEMA), "index")


def merged_ranges(places: list[tuple[int, int]], gap: int, limit: int) -> Iterator[tuple[int, int, list[int]]]:
    """Ranges (start, end, positions in ``places``) that cover sorted (offset, length) pairs."""
    start = end = 0
    members: list[int] = []
    for k, (offset, length) in enumerate(places):
        if members and (offset - end > gap or offset + length - start > limit):
            yield start, end, members
            members = []
        if not members:
            start = end = offset
        end = max(end, offset + length)
        members.append(k)
    if members:
        yield start, end, members


def read_archives(index: DataFrame, folder: str, *, with_payload: bool = True) -> DataFrame:
    """Read the records that ``index`` selects, by sorted and merged byte ranges.

    Index rows are dealt by file and block of the file, so a large file is read
    by many tasks, each going forward through its own part.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload", pa.binary())])
        for batch in batches:
            table = batch.to_pydict()
            by_file: dict[str, list[tuple[int, int]]] = {}
            for name, offset, length in zip(table["file"], table["offset"], table["length"], strict=True):
                by_file.setdefault(name, []).append((offset, length))
            for name, places in by_file.items():
                places.sort()
                with fs.open_input_file(f"{path}/{name}") as source:
                    for start, end, members in merged_ranges(places, MAX_GAP_BYTES, MAX_RANGE_BYTES):
                        source.seek(start)
                        data = source.read(end - start)
                        records = [decode_record(data[places[k][0] - start:places[k][0] - start + places[k][1]]) for k in members]
                        if not with_payload:
                            for record in records:
                                record["payload"] = None
                        yield pa.RecordBatch.from_pylist(records, schema=schema)
    block = F.floor(F.col("offset") / READ_BLOCK_BYTES)
    total = index.agg(F.sum("length")).first()[0] or 0
    # Index rows are small, so the number of tasks follows the bytes they stand for.
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, math.ceil(total / READ_BLOCK_BYTES))
    selected = index.select("file", "offset", "length").repartition(tasks, "file", block).sortWithinPartitions("file", "offset")
    return selected.mapInArrow(read, RECORD_SCHEMA)
