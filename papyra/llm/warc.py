"""Deterministic, sharded WARC archives."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from bisect import bisect_right

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, stored, utf8

SHARD_BYTES = 32_000_000
ROLL_BYTES = 16_000_000
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
MANIFEST = "shard int, part int, name string, temporary string, records long, size long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (fs.LocalFileSystem(), path)


def digests(pages: DataFrame) -> DataFrame:
    """``(page_id, digest, size)`` of every payload."""

    def run(batches):
        for batch in batches:
            payloads = [p.as_buffer().to_pybytes() for p in batch.column("payload")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array([digest(p) for p in payloads], pa.string()), pa.array([len(p) for p in payloads], pa.int64())],
                names=["page_id", "digest", "size"],
            )

    return arrow_map(pages.select("page_id", "payload"), run, "page_id long, digest string, size long")


def revisits(keyed: DataFrame, min_bytes: int) -> DataFrame:
    """``(page_id, digest, first)`` of payloads that an earlier page already has.

    The first page of a payload is a minimum, combined before the shuffle, so
    a payload of very many pages costs no more than any other.
    """
    first = keyed.filter(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = first.filter("n > 1 AND first IS NOT NULL").drop("n")
    return keyed.join(first, "digest").filter(F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))).select("page_id", "digest", "first").distinct()


def boundaries(keyed: DataFrame, shard_bytes: int) -> list[tuple]:
    """First key of every shard after the first, in order of ``(page_id, digest)``.

    A shard begins where the running total of payload bytes, over the whole
    order, passes a multiple of ``shard_bytes``; that does not depend on how
    Spark deals the rows out. The driver gets one row per task and per shard.
    """
    order = ["page_id", "digest"]
    rows = stored(keyed.repartitionByRange(*order).withColumn("task", F.spark_partition_id()), "ordered")
    sums = sorted(rows.groupBy("task").agg(F.sum("size").alias("size")).collect())
    before, at = {}, 0
    for task, size in sums:
        before[task] = at
        at += size
    if not before:
        return []
    start = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("task")) if len(before) <= 1000 else None
    if start is None:
        starts = rows.sparkSession.createDataFrame(list(before.items()), "task int, before long")
        rows, start = rows.join(starts, "task"), F.col("before")
    running = start + F.sum("size").over(Window.partitionBy("task").orderBy(*order)) - F.col("size")
    shard = F.floor(running / shard_bytes)
    first = rows.withColumn("shard", shard).groupBy("shard").agg(F.min(F.struct(*order)).alias("key"))
    keys = sorted(first.collect())[1:]
    return [sort_key(k["key"]["page_id"], k["key"]["digest"]) for k in keys]


def sort_key(page_id: int | None, payload_digest: str) -> tuple:
    return (page_id is not None, page_id or 0, payload_digest)


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{payload_digest}')}>"


def header(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, first: int | None, date: str) -> bytes:
    """A response, or a revisit of page ``first`` without the payload."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else f"urn:page:{page_id}"
    fields = [
        ("WARC-Record-ID", record_id(page_id, payload_digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    if first is None:
        return header("response", fields, http + payload)
    fields += [
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", record_id(first, payload_digest)),
        ("X-Refers-To-Page-Id", str(first)),
    ]
    return header("revisit", fields, http)


class RollingFile:
    """Archives of one shard, written under temporary names and rolled by size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, date: str):
        self.fs, self.folder = opened(folder)
        self.shard, self.roll_bytes, self.date = shard, roll_bytes, date
        self.attempt = uuid.uuid4().hex
        self.part, self.out, self.done = 0, None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"_temporary/{self.attempt}-{self.name}"
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
            self.records, self.size, self.sha = 0, 0, hashlib.sha256()
            info = [("WARC-Record-ID", record_id(None, self.name)), ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
            self._put(header("warcinfo", info, b"format: WARC File Format 1.1\r\n"))
        self._put(record)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _put(self, record: bytes) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append((self.shard, self.part, self.name, self.temporary, self.records, self.size, self.sha.hexdigest()))
            self.part += 1


def manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in MANIFEST.split(", ")])


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, shard_bytes: int = SHARD_BYTES,
                   roll_bytes: int = ROLL_BYTES, date: str = DATE) -> DataFrame:
    """Write ``pages (page_id, url, html)`` as gzipped WARC files; returns the manifest.

    Rows are sorted by page and payload digest and cut into shards by payload
    bytes; a shard is one task, which rolls to the next file once a file's
    compressed size passes ``roll_bytes``. Names, record ids, dates and bytes
    depend on the rows alone. Payloads of at least ``min_bytes`` bytes that a
    smaller page id has are written as revisits. Null html is an empty payload.
    Repeated rows are repeated records: rows of the smallest id are all
    responses. A null page id is greater than any other for what it revisits,
    and is first in the archives.

    A task writes temporary names that no other attempt uses. The manifest,
    committed by Spark, names the files of the attempts that count; only those
    are moved to their final names, and a second move of the same file does
    nothing. Readers use what the manifest lists.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), utf8(F.col("html")).alias("payload"))
    keyed = stored(digests(pages), "digests")
    again = stored(revisits(keyed, min_bytes), "revisits")
    cuts = boundaries(keyed, shard_bytes)
    shards = len(cuts) + 1
    shared = pages.sparkSession.sparkContext.broadcast(cuts)

    def place(batches):
        cuts = shared.value
        for batch in batches:
            payloads = [p.as_buffer().to_pybytes() for p in batch.column("payload")]
            keys = [digest(p) for p in payloads]
            places = [bisect_right(cuts, sort_key(i, k)) for i, k in zip(batch.column("page_id").to_pylist(), keys)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int32()), batch.column("page_id"), pa.array(keys, pa.string()), pa.nulls(len(keys), pa.int64()), batch.column("url"), batch.column("payload")],
                names=["shard", "page_id", "digest", "first", "url", "payload"],
            )

    def place_revisits(batches):
        cuts = shared.value
        for batch in batches:
            ids, keys = batch.column("page_id").to_pylist(), batch.column("digest").to_pylist()
            places = [bisect_right(cuts, sort_key(i, k)) for i, k in zip(ids, keys)]
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), batch.column("page_id"), batch.column("digest"), batch.column("first")],
                                             names=["shard", "page_id", "digest", "first"])

    rows = arrow_map(pages, place, "shard int, page_id long, digest string, first long, url string, payload binary")
    marks = arrow_map(again, place_revisits, "shard int, page_id long, digest string, first long")
    marks = marks.withColumns({"url": F.lit(None).cast("string"), "payload": F.lit(None).cast("binary")})

    def write(batches):
        out, mark = None, None
        for batch in batches:
            for shard, page_id, key, first, url, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or out.shard != shard:
                    if out is not None:
                        out.close()
                        if out.done:
                            yield manifest_batch(out.done)
                    out, mark = RollingFile(folder, shard, roll_bytes, date), None
                if first is not None:
                    mark = page_id, key, first
                    continue
                known = mark[2] if mark is not None and mark[:2] == (page_id, key) else None
                out.add(page_record(page_id, url, payload, key, known, date))
        if out is not None:
            out.close()
            if out.done:
                yield manifest_batch(out.done)

    filesystem, local = opened(folder)
    filesystem.create_dir(f"{local}/_temporary", recursive=True)
    # A revisit's mark sorts before the page itself, so the writer meets it first.
    sorted_rows = rows.union(marks).repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "shard", "page_id", "digest", F.col("first").asc_nulls_last(), "url"
    )
    manifest = stored(arrow_map(sorted_rows, write, MANIFEST), "manifest")
    return commit(manifest, folder)


def commit(manifest: DataFrame, folder: str) -> DataFrame:
    """Move the manifest's files to their final names, then write it beside them."""

    def move(batches):
        filesystem, local = opened(folder)
        for batch in batches:
            for name, temporary, size in zip(*(batch.column(c).to_pylist() for c in ("name", "temporary", "size"))):
                if filesystem.get_file_info(f"{local}/{temporary}").type == fs.FileType.File:
                    filesystem.move(f"{local}/{temporary}", f"{local}/{name}")
                elif filesystem.get_file_info(f"{local}/{name}").size != size:
                    raise OSError(f"{name} is neither under its temporary nor its final name")
            yield batch

    moved = stored(arrow_map(manifest, move, MANIFEST), "moved")
    moved.orderBy("shard", "part").coalesce(1).write.json(f"{folder}/manifest")
    filesystem, local = opened(folder)
    filesystem.delete_dir(f"{local}/_temporary")
    return moved


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{folder}/manifest")


def records(stream: io.BufferedIOBase):
    """``(fields, block)`` of every record of a decompressed archive."""
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8").partition(": ")
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it should")
        yield fields, block


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """``RECORDS`` of all archives that ``manifest`` lists; digests are verified."""

    def run(batches):
        filesystem, local = opened(folder)
        for batch in batches:
            for name, n in zip(batch.column("name").to_pylist(), batch.column("records").to_pylist()):
                rows = []
                with filesystem.open_input_stream(f"{local}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for fields, block in records(stream):
                        if f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
                            raise ValueError(f"{name}: a block does not match its digest")
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2]
                        known, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                        if fields["WARC-Type"] == "response" and (digest(payload), len(payload)) != (known, size):
                            raise ValueError(f"{name}: a payload does not match its digest")
                        page_id, first = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
                        rows.append((int(page_id) if page_id else None, fields["WARC-Target-URI"], size, known, fields["WARC-Type"], int(first) if first else None))
                if len(rows) != n:
                    raise ValueError(f"{name} holds {len(rows)} pages instead of {n}")
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in RECORDS.split(", ")])

    # By number: adaptive execution would merge rows this small into one task.
    return arrow_map(manifest.repartition(max(1, manifest.count())), run, RECORDS)


def manifest_text(manifest: DataFrame) -> list[str]:
    """The manifest's lines without temporary names, for comparing two runs."""
    keep = ("shard", "part", "name", "records", "size", "sha256")
    return [json.dumps({k: r[k] for k in keep}) for r in manifest.orderBy("shard", "part").collect()]
