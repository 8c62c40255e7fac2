"""WARC archives: deduplicating writer, gzip normaliser and indexed reader.

The writer streams records into archives that are each a single gzip stream. The normaliser inflates
such a whole-file stream once, front to back, rewrites every record as a gzip member of its own, and
writes a sidecar with the offset and size of each. The reader seeks by sidecar, so ranges of one
archive can be read by different tasks. Each archive is one task's work and is rotated at
`archive_bytes`; files are written under a name of the attempt and then moved, so repeated attempts
leave the same result.

Archives lie below the folder given (the shared one by default) and are reached through pyarrow's file
systems. Hadoop's names of object stores (s3a, s3n, wasbs and the like) are put into pyarrow's; another scheme
that pyarrow does not know is an error before anything is written.

Edge cases: NULL html is an empty payload. Of equal payloads of at least `min_bytes`, the record with
the smallest id is the response and the others revisit it; rows that repeat that id are responses too,
as are equal payloads whose ids are all NULL, while a NULL id beside others revisits. A NULL url or id
leaves its header out and reads back as NULL. An empty table gives no archives and no records.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored

END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20


def with_verdict(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is NULL for responses.

    Ids are compared per digest by a partial aggregate of digests alone. The digests that occur twice
    are written out first: if they are few, Spark sees it from the file size and no page is shuffled;
    if not, the join may split a digest's pages over many tasks.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    firsts = stored(rows.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n"), "firsts")
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def record(page_id, url: str | None, html: str, digest: str, refers_to, date: str) -> bytes:
    payload = html.encode("utf-8", "surrogatepass")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{quote(str(page_id), safe='')}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{quote(str(refers_to), safe='')}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + END + block + END


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


# Schemes of Hadoop's connectors and the name pyarrow has for the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "wasb": "abfs", "wasbs": "abfss"}


def arrow_uri(folder: str) -> str:
    scheme, mark, rest = folder.partition("://")
    return f"{SCHEMES.get(scheme.lower(), scheme.lower())}{mark}{rest}" if mark else folder


def file_system(folder: str):
    from pyarrow import fs

    folder = arrow_uri(folder)
    if folder.startswith("file:"):  # Spark writes such URIs with any number of slashes
        return fs.LocalFileSystem(), f"/{unquote(folder.removeprefix('file:')).lstrip('/')}"
    return fs.FileSystem.from_uri(folder)


class _Output:
    """A file that appears under its name only when it is complete."""

    def __init__(self, folder: str, name: str):
        self.fs, base = file_system(folder)
        self.fs.create_dir(base, recursive=True)
        self.target, self.temp = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"
        self.stream, self.size = self.fs.open_output_stream(self.temp, compression=None), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.temp, self.target)


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = 1 << 30, level: int = 3,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of with_verdict() as archives of one gzip stream each; returns (archive, records)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out, names, counts, raw = None, [], [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    names.append(f"part-{part:06d}-{len(names):04d}.warc.gz")
                    counts.append(0)
                    out, packer, raw = _Output(folder, names[-1]), zlib.compressobj(level, zlib.DEFLATED, 31), 0
                data = record(*row, date)
                out.write(packer.compress(data))
                counts[-1] += 1
                raw += len(data)
                if raw >= archive_bytes:
                    out.write(packer.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(packer.flush())
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["archive", "records"])

    return rows.mapInArrow(run, "archive string, records long")


def records_of(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """The records of a gzip file, whole-stream or by members, inflated once in chunks."""
    inflater, held, need = zlib.decompressobj(31), bytearray(), 0
    while data := read(CHUNK):
        while data:
            held += inflater.decompress(data)
            data = inflater.unused_data
            if inflater.eof:
                inflater = zlib.decompressobj(31)
                data = data.lstrip(b"\0")
        done = 0
        while len(held) - done >= max(need, 1):
            stop = held.find(END, done)
            if stop < 0:
                break
            size = stop + len(END) - done + int(headers(bytes(held[done:stop]))["content-length"]) + len(END)
            if len(held) - done < size:
                need = size  # no second look before the whole record is here
                break
            yield bytes(held[done:done + size])
            done, need = done + size, 0
        del held[:done]
    if held:
        raise ValueError(f"{len(held)} bytes after the last whole record")


def normalise(archives: DataFrame, source: str, target: str, level: int = 3) -> DataFrame:
    """Rewrite each archive with one member per record and a sidecar of (offset, size) lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            counts = []
            for name in names:
                fs, base = file_system(source)
                out, index = _Output(target, name), []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for data in records_of(stream.read):
                        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = packer.compress(data) + packer.flush()
                        index.append((out.size, len(member)))
                        out.write(member)
                out.close()
                side = _Output(target, f"{name}.idx")
                side.write("".join(f"{json.dumps(e)}\n" for e in index).encode())
                side.close()
                counts.append(len(index))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["archive", "records"])

    return spread(archives.select("archive")).mapInArrow(run, "archive string, records long")


def spread(rows: DataFrame, by: tuple[str, ...] = ("archive",)) -> DataFrame:
    """One row a task. Rows are names, so small that without a number Spark would give all of them to one task."""
    return rows.repartitionByRange(max(1, rows.count()), *by)


RECORD_SCHEMA = ("page_id string, url string, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to string, payload binary")


def read_archives(archives: DataFrame, folder: str, with_payload: bool = True, range_records: int = 2000) -> DataFrame:
    """Records by sidecar offsets; every stored payload is checked against its digest."""
    ranges = archives.where("records > 0").select("archive", F.explode(F.sequence(
        F.lit(0), F.col("records") - 1, F.lit(range_records))).alias("start"))
    name_of = lambda urn: None if urn is None else unquote(urn.removeprefix("<urn:page:").removesuffix(">"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, base = file_system(folder)
                with fs.open_input_stream(f"{base}/{name}.idx", compression=None) as side:
                    index = [json.loads(x) for x in side.read().splitlines()[start:start + range_records]]
                found = []
                with fs.open_input_file(f"{base}/{name}") as archive:
                    for offset, size in index:
                        archive.seek(offset)
                        data = zlib.decompress(archive.read(size), 31)
                        cut = data.index(END)
                        head = headers(data[:cut])
                        block = data[cut + len(END):cut + len(END) + int(head["content-length"])]
                        cut = block.index(END)
                        size, payload = int(headers(block[:cut])["content-length"]), block[cut + len(END):]
                        digest = head["warc-payload-digest"].removeprefix("sha256:")
                        if head["warc-type"] == "response" and (
                                len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"payload at {name}:{offset} differs from its digest")
                        found.append((name_of(head.get("warc-record-id")), head.get("warc-target-uri"), size, digest,
                                      head["warc-type"], name_of(head.get("warc-refers-to")),
                                      payload if with_payload and head["warc-type"] == "response" else None))
                kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
                    names=[c.split()[0] for c in RECORD_SCHEMA.split(", ")])

    return spread(ranges, ("archive", "start")).mapInArrow(run, RECORD_SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Pages written to archives, normalised and read back, without their payloads."""
    raw = stored(write_archives(with_verdict(pages), f"{folder}/raw"), "archives")
    members = stored(normalise(raw, f"{folder}/raw", f"{folder}/members"), "members")
    kind = pages.schema["page_id"].dataType
    return read_archives(members, f"{folder}/members", with_payload=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))
