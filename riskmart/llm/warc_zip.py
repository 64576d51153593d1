"""WARC records inside ZIP packages: write with Spark, read records back by byte ranges.

A package is a ZIP file with two stored (not deflated) members: a WARC file of
gzip members, one per record, and an index with a line per record (offset and
length inside the WARC member). The reader takes the file's tail, finds the end
record (and the ZIP64 locator and end record where sizes or counts need them),
parses the central directory with its ZIP64 extra fields, finds the members'
data through their local headers, and then reads ranges only: nothing is
extracted, no member is read whole but the index.

Writing: records with equal payloads of at least ``least`` bytes are stored
once; the one with the largest id is the response, the others are revisits that
refer to it. The payload digest decides (SHA-1). A task writes packages of at
most about ``package_bytes`` under a temporary name and moves each to its final
name, so a repeated task replaces its files by equal ones.

Files are reached with Arrow file systems: the folder must be one that all
executors share (a Hadoop, object store or mounted path).

Defined results: a null payload is empty; a null id is never the largest, and a
group of null ids has no revisits; rows that repeat the largest id are all
responses; a null URL has no target header; an empty table writes no package and
reads no record; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

LEAST = 1000
PACKAGE_BYTES = 32 << 20
HOT = 64
LENGTH_FIELD = "X-Payload-Length"                # of a revisit: the length of the payload that it leaves out
WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
READ_BYTES = 4 << 20

RECORDS = ("page_id long, target_uri string, record_type string, payload_digest string, "
           "payload_bytes long, refers_to long, payload binary")


# ---------------------------------------------------------------- records

def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _from_urn(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def build_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit without one."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"{LENGTH_FIELD}: {len(payload)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Fields of a record; the payload is None for a revisit, its length None where the record does not give it."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    if len(block) != int(fields["content-length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    kind = fields["warc-type"]
    payload = None if kind == "revisit" else block.partition(b"\r\n\r\n")[2]
    length = fields.get(LENGTH_FIELD.lower()) if payload is None else len(payload)
    uri = fields.get("warc-target-uri")
    if uri is not None:
        uri = uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return {"page_id": _from_urn(fields["warc-record-id"]), "target_uri": uri, "record_type": kind,
            "digest": fields["warc-payload-digest"].removeprefix("sha1:"),
            "refers_to": _from_urn(fields.get("warc-refers-to")), "payload": payload,
            "payload_bytes": None if length is None else int(length)}


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# ---------------------------------------------------------------- packages

class PackageWriter:
    """Collects records in memory (bounded by the package size) and writes one ZIP package."""

    def __init__(self):
        self.warc, self.index = io.BytesIO(), []

    def add(self, page_id, url, payload: bytes, digest: str, refers_to) -> None:
        data = _gzip(build_record(page_id, url, payload, digest, refers_to))
        self.index.append(json.dumps({"id": page_id, "offset": self.warc.tell(), "length": len(data)}))
        self.warc.write(data)

    def write(self, sink) -> None:
        with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
            for name, data in ((WARC_MEMBER, self.warc.getbuffer()), (INDEX_MEMBER, "\n".join(self.index).encode())):
                # a fixed time stamp: a repeated task writes equal bytes
                with package.open(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True) as member:
                    member.write(data)


class PackageReader:
    """Stored members of a ZIP file through ``read(offset, length)`` and its size."""

    def __init__(self, read, size: int):
        self.read, self.size = read, size
        self.members = self._directory()

    def _end(self) -> tuple[int, int]:
        """Offset and length of the central directory."""
        tail = min(self.size, 22 + 0xFFFF + 20)
        data = self.read(self.size - tail, tail)
        at = data.rfind(b"PK\x05\x06")
        while at >= 0:
            if at + 22 <= len(data) and at + 22 + struct.unpack_from("<H", data, at + 20)[0] == len(data):
                break
            at = data.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end of central directory record: not a ZIP file")
        length, offset = struct.unpack_from("<II", data, at + 12)
        if at >= 20 and data[at - 20:at - 16] == b"PK\x06\x07":          # ZIP64 locator
            end64 = self.read(struct.unpack_from("<Q", data, at - 12)[0], 56)
            if end64[:4] != b"PK\x06\x06":
                raise ValueError("broken ZIP64 end record")
            length, offset = struct.unpack_from("<QQ", end64, 40)
        return offset, length

    def _directory(self) -> dict[str, tuple[int, int]]:
        """Name to (local header offset, size) of every stored member."""
        offset, length = self._end()
        data, at, members = self.read(offset, length), 0, {}
        while at + 46 <= len(data) and data[at:at + 4] == b"PK\x01\x02":
            flags, method = struct.unpack_from("<HH", data, at + 8)
            packed, size, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", data, at + 20)
            header = struct.unpack_from("<I", data, at + 42)[0]
            name = data[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[at + 46 + n_name:at + 46 + n_name + n_extra]
            wide, x = [v == 0xFFFFFFFF for v in (size, packed, header)], 0
            while x + 4 <= len(extra):
                kind, n = struct.unpack_from("<HH", extra, x)
                if kind == 1:            # ZIP64: only the fields that are full in the entry, in this order
                    values = iter(struct.unpack_from(f"<{sum(wide)}Q", extra, x + 4))
                    size, packed, header = (next(values) if w else v for w, v in zip(wide, (size, packed, header)))
                x += 4 + n
            if method == 0 and not flags & 1:
                members[name] = (header, packed)
            at += 46 + n_name + n_extra + n_note
        return members

    def member(self, name: str) -> tuple[int, int]:
        """First byte and length of a stored member's data."""
        if name not in self.members:
            raise ValueError(f"no stored member {name}")
        header, size = self.members[name]
        local = self.read(header, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("broken local header")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        return header + 30 + n_name + n_extra, size

    def records(self) -> Iterator[dict]:
        """Every indexed record, neighbours fetched by one read of about READ_BYTES."""
        start, size = self.member(INDEX_MEMBER)
        index = [json.loads(x) for x in self.read(start, size).decode().splitlines()]
        base, limit = self.member(WARC_MEMBER)
        lo = 0
        while lo < len(index):
            hi, first = lo + 1, index[lo]["offset"]
            while hi < len(index) and index[hi]["offset"] + index[hi]["length"] - first <= READ_BYTES:
                hi += 1
            last = index[hi - 1]["offset"] + index[hi - 1]["length"]
            if last > limit:
                raise ValueError("the index points past the member")
            data = self.read(base + first, last - first)
            for entry in index[lo:hi]:
                at = entry["offset"] - first
                yield parse_record(zlib.decompress(data[at:at + entry["length"]], 31))
            lo = hi


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


# ---------------------------------------------------------------- Spark

def with_revisits(pages: DataFrame, scratch: Scratch, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for a response).

    A payload with more than 1/64 of all copies (63 such at most) meets its response's id by
    broadcast; the rows of those and of short payloads are dealt evenly in the other join.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    copies = scratch.store(rows.where(F.octet_length("payload") >= least).groupBy("digest")
                           .agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
                           .where((F.col("n") > 1) & F.col("kept").isNotNull()), "copies")
    every = copies.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = copies.where(F.col("n") * HOT > every).select(F.col("digest").alias("_hot"), F.col("kept").alias("_kept"))
    rest = copies.where(F.col("n") * HOT <= every).select(F.col("digest").alias("_key"), "kept")
    alone = F.col("_kept").isNotNull() | (F.octet_length("payload") < least)
    keyed = (rows.join(F.broadcast(hot), F.col("digest") == F.col("_hot"), "left")
             .withColumn("key", F.when(alone, F.concat_ws("/", "digest", "page_id", "url")).otherwise(F.col("digest"))))
    first = F.coalesce("_kept", "kept")
    return (keyed.join(rest, F.col("key") == F.col("_key"), "left")
            .select("page_id", "url", "payload", "digest",
                    F.when(first.isNotNull() & ~F.col("page_id").eqNullSafe(first), first).alias("refers_to")))


def _write(folder: str, package_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _file_system(folder)
        context, made = TaskContext.get(), 0

        def close(writer: PackageWriter) -> pa.RecordBatch:
            nonlocal made
            name = f"{base}/package-{context.partitionId():06d}-{made:05d}.zip"
            temporary = f"{name}.{context.taskAttemptId()}"
            with files.open_output_stream(temporary, compression=None) as sink:
                writer.write(sink)
            files.move(temporary, name)
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(writer.index)], pa.int64())], names=["package", "records"])

        writer = PackageWriter()
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                writer.add(page_id, url, payload, digest, refers_to)
                if writer.warc.tell() >= package_bytes:
                    yield close(writer)
                    writer = PackageWriter()
        if writer.index:
            yield close(writer)
    return run


def write_packages(pages: DataFrame, folder: str, least: int = LEAST, package_bytes: int = PACKAGE_BYTES,
                   scratch: Scratch | None = None) -> DataFrame:
    """Write every page's record under ``folder``; returns (package, records) when run."""
    files, base = _file_system(folder)
    files.create_dir(base, recursive=True)
    scratch = scratch or Scratch(pages.sparkSession, "warc", until_exit=True)
    rows = with_revisits(pages, scratch, least).sortWithinPartitions("page_id", "digest")
    return rows.mapInArrow(_write(folder, package_bytes), "package string, records long")


def _read(folder: str, keep_payload: bool):
    names = ["page_id", "target_uri", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _file_system(folder)

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for package in batch.column(0).to_pylist():
                with files.open_input_file(package) as source:
                    def read(offset: int, length: int, source=source) -> bytes:
                        source.seek(offset)
                        return source.read(length)
                    rows, held = [], 0
                    for r in PackageReader(read, source.size()).records():
                        payload = r["payload"]
                        if payload is not None and hashlib.sha1(payload).hexdigest() != r["digest"]:
                            raise ValueError(f"payload of page {r['page_id']} does not match its digest")
                        rows.append((r["page_id"], r["target_uri"], r["record_type"], r["digest"],
                                     r["payload_bytes"], r["refers_to"],
                                     payload if keep_payload else None))
                        held += len(payload or b"") if keep_payload else 100
                        if held > READ_BYTES:
                            yield flush(rows)
                            rows, held = [], 0
                    if rows:
                        yield flush(rows)
    return run


def read_packages(packages: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """Every record of the listed packages (column ``package``), read once; payloads checked against their digests.

    A revisit's payload_bytes comes from its own record (null in archives that do not note it).
    """
    read = packages.select("package").repartition(packages.sparkSession.sparkContext.defaultParallelism)
    return read.mapInArrow(_read(folder, payload), RECORDS)


def round_trip(pages: DataFrame, scratch: Scratch | None = None, least: int = LEAST) -> DataFrame:
    """Write all pages, then read all records back."""
    scratch = scratch or Scratch(pages.sparkSession, "warc", until_exit=True)
    folder = scratch.path("packages")
    written = scratch.store(write_packages(pages, folder, least, scratch=scratch), "written")
    records = scratch.store(read_packages(written, folder), "records")
    return records
