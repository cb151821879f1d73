"""WARC archives: one gzip member per record, written to the shared folder and read back sequentially.

Of records with equal payloads one is a response and the others are revisits that refer to it. Writers put their
records into files of bounded size, under a name of the attempt, and hand on the names of finished files; readers
only open files that a finished task named, so a lost executor leaves at most files nobody reads.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.jobs import prepare, written
from lapwise.session import new_table_path

#: A file is closed at this size; readers take one file per task.
FILE_BYTES = 64 * 1024 * 1024
READ_BYTES = 256 * 1024
LEVEL = 6
RECORD_ID = "<urn:lapwise:page:{}>"
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that does not keep to the format, or a payload that does not have its digest."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(record: bytes, level: int = LEVEL) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _one_line(text: str | None) -> str:
    return quote(text or "", safe="%/:?#[]@!$&'()*+,;=~-._")


def page_record(page_id, url, payload: bytes | None, size: int, digest: str, refers_to) -> bytes:
    """Response record of a page, or a revisit record if it refers to another."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": RECORD_ID.format("null" if page_id is None else page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": _one_line(url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        headers["WARC-Profile"] = REVISIT_PROFILE
        headers["WARC-Refers-To"] = RECORD_ID.format(refers_to)
    return record_bytes(headers, http if revisit else http + (payload or b""))


def members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Content of each gzip member of a stream of bytes, decompressed as it comes."""
    packer, parts = None, []
    for chunk in chunks:
        while chunk:
            if packer is None:
                packer, parts = zlib.decompressobj(31), []
            try:
                parts.append(packer.decompress(chunk))
            except zlib.error as error:
                raise WarcError(f"broken gzip member: {error}") from error
            chunk = packer.unused_data
            if packer.eof:
                yield b"".join(parts)
                packer = None
    if packer is not None:
        raise WarcError("the archive ends within a record")


def parse_record(content: bytes) -> Record:
    """Headers and block, framed by Content-Length."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise WarcError("no WARC record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise WarcError(f"no header line: {line!r}")
        headers[name.strip().lower()] = value.strip()
    try:
        size = int(headers["content-length"])
    except (KeyError, ValueError) as error:
        raise WarcError("a record without Content-Length") from error
    if size < 0 or rest[size:] != b"\r\n\r\n":
        raise WarcError("a block that does not end where Content-Length says")
    return Record(headers, rest[:size])


def read_records(chunks: Iterator[bytes]) -> Iterator[Record]:
    """Records of an archive, with the payload digest of every response verified."""
    for content in members(chunks):
        record = parse_record(content)
        if record.headers.get("warc-type") == "response":
            payload = http_payload(record.block)[1]
            if record.headers.get("warc-payload-digest") != f"sha1:{digest_of(payload)}":
                raise WarcError(f"payload of {record.headers.get('warc-record-id')} does not have its digest")
        yield record


def http_payload(block: bytes) -> tuple[dict[str, str], bytes]:
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        raise WarcError("no HTTP head")
    headers = dict(line.split(": ", 1) for line in head.decode("latin-1").split("\r\n")[1:])
    return {k.lower(): v for k, v in headers.items()}, payload


def _open_folder(path: str):
    """File system and path of a folder that all executors reach."""
    if urlsplit(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(path).path if path.startswith("file:") else path
    return fs.FileSystem.from_uri(path)


def _chunks(file, size: int = READ_BYTES) -> Iterator[bytes]:
    while chunk := file.read(size):
        yield chunk


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds payload, size, sha1 (hex), ``revisit`` and ``refers_to``, the smallest page id with an equal payload.

    Rows with that page id are responses and refer to none. Only payloads of at least ``least_bytes`` are
    compared. A null page id comes after all others.
    """
    sized = pages.withColumn("payload", F.encode(F.coalesce("html", F.lit("")), "UTF-8")).drop("html")
    sized = sized.withColumns(
        {
            "size": F.octet_length("payload").cast("long"),
            "sha1": F.sha1("payload"),
            "known": F.col("page_id").isNotNull(),
            "page_key": F.coalesce("page_id", F.lit(0).cast("long")),
        }
    )
    # Payloads stay out of the comparison; the marks come back by page, so that no common payload is a hot key.
    keys = sized.where(F.col("size") >= least_bytes).select("page_key", "known", "size", "sha1").distinct()
    keys = written(keys, "payload-digests")
    first = keys.groupBy("sha1", "size").agg(F.min(F.struct(~F.col("known"), "page_key", "known")).alias("first"))
    marks = (
        keys.join(first, ["sha1", "size"])
        .where("first.known <> known OR first.page_key <> page_key")
        .select("page_key", "known", "sha1", F.when(F.col("first.known"), F.col("first.page_key")).alias("refers_to"), F.lit(True).alias("revisit"))
    )
    return sized.join(marks, ["page_key", "known", "sha1"], "left").withColumn("revisit", F.coalesce("revisit", F.lit(False)))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row (page_id, url, html) to files in ``folder``; (path, records) of each file.

    Null html is an empty payload, null url an empty one; line breaks in urls are percent-encoded.
    """
    prepare(pages.sparkSession)
    marked = mark_revisits(pages.select("page_id", "url", "html"), least_bytes)
    rows = marked.select(
        "page_id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "size", "sha1", "revisit", "refers_to"
    )

    def write(batches):
        system, path = _open_folder(folder)
        system.create_dir(path, recursive=True)
        file, name, written_bytes, records = None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if file is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    file, written_bytes, records = system.open_output_stream(f"{path}/{name}", compression=None), 0, 0
                digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                refers_to = ("null" if row["refers_to"] is None else row["refers_to"]) if row["revisit"] else None
                data = member(page_record(row["page_id"], row["url"], row["payload"], row["size"], digest, refers_to))
                file.write(data)
                written_bytes += len(data)
                records += 1
                if written_bytes >= file_bytes:
                    file.close()
                    file = None
                    yield _listing(name, records)
        if file is not None:
            file.close()
            yield _listing(name, records)

    listed = written(rows.mapInArrow(write, "name string, records long"), "warc-files")
    return listed


def _listing(name: str, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=["name", "records"])


def read_archives(files: DataFrame, folder: str, keep_payload: bool = False) -> DataFrame:
    """A row per record of the listed files, from its headers and HTTP head; raises on a broken archive.

    ``payload_bytes`` and ``payload_digest`` are of the full payload, also for revisits; ``refers_to`` is the
    response's page id for revisits. ``keep_payload`` adds ``payload`` (null for revisits).
    """
    spark = files.sparkSession
    prepare(spark)
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema += ", payload binary" if keep_payload else ""
    names = [field.split()[0] for field in schema.split(", ")]

    def read(batches):
        system, path = _open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                out, held = [], 0
                count = 0
                with system.open_input_stream(f"{path}/{row['name']}", compression=None) as file:
                    for record in read_records(_chunks(file)):
                        count += 1
                        out.append(_row(record, keep_payload))
                        held += len(record.block) if keep_payload else 256
                        if held >= 4 * 1024 * 1024:
                            yield _batch(out, names)
                            out, held = [], 0
                if count != row["records"]:
                    raise WarcError(f"{row['name']} has {count} records, not {row['records']}")
                if out:
                    yield _batch(out, names)

    # One file per task, as far as there are that many.
    n = max(files.count(), 1)
    return files.repartition(min(n, 100_000), "name").mapInArrow(read, schema)


def _row(record: Record, keep_payload: bool):
    head, payload = http_payload(record.block)
    kind = record.headers["warc-type"]
    out = (
        _page(record.headers["warc-record-id"]),
        unquote(record.headers.get("warc-target-uri", "")),
        int(head["content-length"]),
        record.headers["warc-payload-digest"].removeprefix("sha1:"),
        kind,
        _page(record.headers["warc-refers-to"]) if kind == "revisit" else None,
    )
    return (*out, payload if kind == "response" else None) if keep_payload else out


def _page(record_id: str) -> int | None:
    value = record_id.rstrip(">").rpartition(":")[2]
    return None if value == "null" else int(value)


_TYPES = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}


def _batch(rows, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _TYPES[n]) for c, n in zip(zip(*rows, strict=True), names, strict=True)], names=names
    )


def archive_pages(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write pages as WARC archives (by default to the shared folder) and read them back; see ``read_archives``."""
    folder = folder or new_table_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, least_bytes), folder)
