"""WARC archives: a writer of one gzip member per record, and a sequential reader that checks what it reads.

Both work on streams of any file system that pyarrow knows (local or mounted folders, HDFS, object stores), and hold one
record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import salted_join, stored

VERSION = b"WARC/1.1"
#: A new archive is begun when one has reached this size.
ARCHIVE_BYTES = 256_000_000
_READ = 1 << 18
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def digest(data: bytes) -> str:
    """The bare base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header's value on one line."""
    return " ".join(value.split())


def record_member(kind: str, record_id: str, uri: str | None, payload: bytes, refers_to: str | None = None) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header of its page, but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _clean(uri or "")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        headers[5:5] = [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", _PROFILE)]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers) + b"\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def members(stream) -> Iterator[bytes]:
    """The contents of a stream's gzip members, decompressed piece by piece as they are read."""
    rest = b""
    while True:
        unpack, out = zlib.decompressobj(31), io.BytesIO()
        while not unpack.eof:
            data = rest or stream.read(_READ)
            rest = b""
            if not data:
                if out.tell() or unpack.unconsumed_tail:
                    raise ValueError("the archive ends within a member")
                return
            out.write(unpack.decompress(data))
        rest = unpack.unused_data
        yield out.getvalue()


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def records(stream) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(WARC headers, HTTP headers, payload) of each record, in order.

    The block is framed by Content-Length; a wrong version, length or digest raises ValueError. A revisit's
    payload is empty here, and its length and digest are those of its headers.
    """
    for data in members(stream):
        head, found, body = data.partition(b"\r\n\r\n")
        if not found or not head.startswith(VERSION + b"\r\n"):
            raise ValueError("not a WARC record")
        headers = _headers(head)
        length = int(headers["content-length"])
        block, end = body[:length], body[length:]
        if len(block) != length or end != b"\r\n\r\n":
            raise ValueError("a record's length is not its Content-Length")
        if headers["warc-block-digest"] != f"sha1:{digest(block)}":
            raise ValueError("a block doesn't have its digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        if headers["warc-type"] == "response" and headers["warc-payload-digest"] != f"sha1:{digest(payload)}":
            raise ValueError("a payload doesn't have its digest")
        yield headers, _headers(http), payload


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


_PAGES = ["page_id", "url", "html", "record_type", "refers_to"]


def _name(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def _number(name: str | None) -> int | None:
    text = (name or "").strip("<>").rpartition(":")[2]
    return None if text in ("", "none") else int(text)


def _write(folder: str, most: int):
    def write(batches):
        store, path = _file_system(folder)
        store.create_dir(path, recursive=True)
        task = TaskContext.get()
        names, out, held = [], None, 0

        def close():
            out.close()
            # A task that runs twice replaces its own archive by an equal one.
            store.move(f"{path}/{names[-1]}.{task.taskAttemptId()}", f"{path}/{names[-1]}")

        for batch in batches:
            for page_id, url, html, kind, refers_to in zip(*(batch.column(c).to_pylist() for c in _PAGES)):
                if out is None or held >= most:
                    if out is not None:
                        close()
                    names.append(f"pages-{task.partitionId():06d}-{len(names):04d}.warc.gz")
                    out, held = store.open_output_stream(f"{path}/{names[-1]}.{task.taskAttemptId()}", compression=None), 0
                payload = (html or "").encode()
                data = record_member(kind, _name(page_id), url, payload, None if refers_to is None else _name(refers_to))
                out.write(data)
                held += len(data)
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"archive": pa.array([f"{folder}/{n}" for n in names], pa.string())})

    return write


def _read(batches):
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            store, path = _file_system(archive)
            with store.open_input_stream(path, compression=None) as stream:
                held, size = [], 0
                for headers, http, payload in records(stream):
                    kind = headers["warc-type"]
                    held.append(
                        (
                            archive,
                            _number(headers["warc-record-id"]),
                            kind,
                            _number(headers.get("warc-refers-to")),
                            headers["warc-target-uri"],
                            int(http["content-length"]),
                            headers["warc-payload-digest"].removeprefix("sha1:"),
                            payload if kind == "response" else None,
                        )
                    )
                    size += len(payload)
                    if size > 8_000_000 or len(held) == 5_000:
                        yield _rows(held)
                        held, size = [], 0
                if held:
                    yield _rows(held)


_RECORDS = "archive string, page_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string, payload binary"
_SCHEMA = pa.schema(
    [
        ("archive", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def _rows(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _SCHEMA)], schema=_SCHEMA)


def record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with ``record_type`` and ``refers_to``.

    Of pages with equal payloads of at least ``least_bytes`` bytes, the one with the smallest page_id is a
    response and the others are revisits of it. Only ids and digests are shuffled by digest, first merged in each task and then with
    salt, so that a payload that a third of all pages share is no burden for one task.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    key: list[Column] = [F.sha2(payload, 256).alias("sha"), F.octet_length(payload).alias("size")]
    keys = pages.select("page_id", *key).filter((F.col("size") >= least_bytes) & F.col("page_id").isNotNull())
    heads = keys.groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    heads = heads.filter("n > 1").drop("n")
    revisits = salted_join(keys, heads, ["sha", "size"], how="inner").filter(F.col("page_id") != F.col("first"))
    # A page id may come twice with different payloads, or with one: a row for each pair.
    revisits = revisits.groupBy("page_id", "sha", "size").agg(F.min("first").alias("refers_to"))
    return (
        pages.select("page_id", "url", "html", *key)
        .join(revisits, ["page_id", "sha", "size"], "left")
        .withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))
        .select(*_PAGES)
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page (page_id long, url string, html string) into gzipped archives; returns their places.

    A null html is an empty payload, a null url an empty URI. Repeated rows of a page are records of one
    type: the smallest id of a payload is a response each time. A page without an id is always a response. An empty
    table writes nothing. Other columns are not read. ``folder`` must be seen by all executors.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return stored(record_types(rows, least_bytes).mapInArrow(_write(folder, archive_bytes), "archive string"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record of the archives named in the column ``archive``, each read in order by one task."""
    return archives.select("archive").mapInArrow(_read, _RECORDS)
