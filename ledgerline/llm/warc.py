"""WARC archives: write, normalise, index and read back.

``write`` stores every page as a WARC record in whole-file gzip archives. ``normalise`` inflates each archive's stream once,
rewrites every record as a gzip member of its own and writes a sidecar index of record offsets. ``read`` opens single
records through the index.

Scale: an archive is rolled at ``ROLL`` bytes, so no file grows with the data; tasks stream and hold one record and one
buffer. Archives go to the shared folder under names that no other attempt uses, and only a committed manifest
table (written by Spark) makes them part of the result, so a lost executor or a repeated task leaves no half file in use.
Duplicates are found by payload digest: partial aggregation first, then a join in which a hot digest can be split.

Defined results: a null html has an empty payload; a null url is written as ``about:blank``; repeated rows are
records of their own; of equal payloads of at least ``MIN_REVISIT`` bytes every row that carries the smallest ``page_id`` is
a response; rows without a ``page_id`` come last, and are responses where no equal payload has one. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import new_path, save, slices

MIN_REVISIT = 100
ROLL = 64 << 20
CHUNK = 1 << 20
#: Fixed: records carry a constant date, so that equal pages give equal archives.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, offset long, length long, page_id long, record_type string, payload_digest string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"


def with_duplicates(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: null for responses."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    groups = (
        rows.filter(F.octet_length("payload") >= MIN_REVISIT)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(groups, F.col("digest") == F.col("of"), "left").select(
        "page_id", "url", "payload", "digest", refers.alias("refers_to")
    )


def _uri(page_id: int | None, url: str | None) -> str:
    return "".join(c for c in (url or "about:blank") if c > " ")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit leaves the payload out and names the record that has it."""
    kind = "response" if refers_to is None else "revisit"
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_uri(page_id, url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and body of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """The records of an inflated archive, one at a time."""
    buffer = bytearray()
    need = None
    for chunk in stream:
        buffer += chunk
        while True:
            if need is None:
                end = buffer.find(b"\r\n\r\n")
                if end < 0:
                    break
                at = buffer.rfind(b"Content-Length: ", 0, end) + 16
                need = end + 8 + int(buffer[at : buffer.find(b"\r\n", at)])
            if len(buffer) < need:
                break
            yield bytes(buffer[:need])
            del buffer[:need]
            need = None
    if buffer:
        raise ValueError("the archive ends inside a record")


def inflate(source) -> Iterator[bytes]:
    """Inflated chunks of a gzip file of one or more members."""
    engine = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            if chunk := engine.decompress(data, CHUNK):
                yield chunk
            if engine.eof:
                data, engine = engine.unused_data, zlib.decompressobj(31)
            else:
                data = engine.unconsumed_tail
    if tail := engine.flush():
        yield tail


def write(rows: DataFrame, roll: int = ROLL) -> DataFrame:
    """Writes the rows of ``with_duplicates`` as whole-file gzip archives; the committed manifest (``archive``)."""
    folder = new_path(rows.sparkSession, "warc")

    def run(batches):
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        out = engine = None
        size, names = 0, []
        for batch in slices(batches):
            for row in batch.to_pylist():
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = store.open_output_stream(f"{path}/{names[-1]}", compression=None)
                    engine, size = zlib.compressobj(6, zlib.DEFLATED, 31), 0
                data = record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                out.write(engine.compress(data))
                size += len(data)
                if size >= roll:
                    out.write(engine.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(engine.flush())
            out.close()
        if names:
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n in names])], names=["archive"])

    return save(rows.mapInArrow(run, "archive string"), "warc-manifest")


def normalise(manifest: DataFrame) -> DataFrame:
    """Rewrites every archive with a member a record; the committed index of the new archives."""
    spark = manifest.sparkSession
    folder = new_path(spark, "warc-members")

    def run(batches):
        store = path = None
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                source_store, source = fs.FileSystem.from_uri(archive)
                store, path = fs.FileSystem.from_uri(folder)
                store.create_dir(path, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"
                rows, offset = [], 0
                with (
                    source_store.open_input_stream(source, compression=None) as packed,
                    store.open_output_stream(f"{path}/{name}", compression=None) as out,
                ):
                    for data in records(inflate(packed)):
                        engine = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = engine.compress(data) + engine.flush()
                        out.write(member)
                        head, _ = parse(data)
                        page = int(head["X-Page-ID"]) if head["X-Page-ID"] else None
                        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                        rows.append((f"{folder}/{name}", offset, len(member), page, head["WARC-Type"], digest))
                        offset += len(member)
                for start in range(0, len(rows), 5000):
                    part = zip(*rows[start : start + 5000])
                    names = [c.split()[0] for c in INDEX.split(", ")]
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(part, kinds)], names=names)

    spread = manifest.repartition(max(1, manifest.count()))  # an archive a task
    return save(spread.mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame) -> DataFrame:
    """Every indexed record, opened by its offset. ``intact``: the payload has the digest that its header names."""

    def run(batches):
        opened: dict[str, tuple] = {}
        for batch in slices(batches):
            rows = []
            for archive, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if archive not in opened:
                    for _, old in opened.values():
                        old.close()
                    opened.clear()
                    store, path = fs.FileSystem.from_uri(archive)
                    opened[archive] = store, store.open_input_file(path)
                packed = opened[archive][1]
                packed.seek(offset)
                head, body = parse(b"".join(inflate(io.BytesIO(packed.read(length)))))
                payload = body.partition(b"\r\n\r\n")[2]
                digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                response = head["WARC-Type"] == "response"
                rows.append((
                    int(head["X-Page-ID"]) if head["X-Page-ID"] else None,
                    int(head["X-Payload-Length"]),
                    hashlib.sha256(payload).hexdigest() if response else digest,
                    head["WARC-Type"],
                    None if response else int(head["X-Refers-To-Page-ID"]),
                    not response or hashlib.sha256(payload).hexdigest() == digest,
                ))
            names = [c.split()[0] for c in READ.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        for _, old in opened.values():
            old.close()

    return index.sortWithinPartitions("archive", "offset").mapInArrow(run, READ)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages``, normalises the archives and reads all records back."""
    return read(normalise(write(with_duplicates(pages))))
