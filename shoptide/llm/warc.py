"""WARC archives: written by map tasks, read back by byte ranges.

Writing. Equal payloads of at least LEAST bytes are stored once: the record with the smallest id is a
response, the others are revisit records that name it and its digest and carry no body. Each task writes
one archive of gzip members, a member a record, into the shared folder, under a name of its own attempt, and
returns the name and size. Only what successful tasks returned belongs to the archive set, so repeated or lost attempts do no harm.

Reading. Archives are cut into byte ranges. A task looks for the gzip magic in its range, tries each place by
inflating a header there - compressed bytes can look like magic, but do not inflate to a WARC version line - and then reads
members one after the other. It owns the members that start inside its range, and reads the last one to its end, beyond
the range. A candidate counts if a WARC version line inflates there; what is wrong behind that line, in the header or the body, makes a damaged
member. A record's payload is held whole, an archive never.

The folder is reached with pyarrow's file systems, so it may be local to all, or an object store.

Null html is an empty payload. Records without an id get none back. Rows that repeat an id and payload are each a
record; those with the smallest id are all responses. Small or empty payloads are all responses. An archive set may be empty.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm.shared import settle, shared_folder

LEAST = 100
RANGE = 32 << 20
READ = 1 << 20
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROBE = 1 << 16  # bytes that a version line surely inflates from
PIECE = 1 << 16

RECORD = "page_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"
FIELDS = [f.split()[0] for f in RECORD.split(", ")]


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def with_revisits(pages: DataFrame, page_id: str, url: str, html: str, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, digest, first): first is the id of the response that a revisit refers to."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # ids only: settled, so that the join below stands on plain shuffles and a hot payload can be split
    large = rows.filter(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = settle(large.filter("n > 1").select("digest", "first"), "firsts")
    joined = rows.join(shared, "digest", "left")
    return joined.withColumn("first", F.when(F.col("page_id") != F.col("first"), F.col("first")))


def record(page_id, url, payload: bytes, digest: str, first) -> bytes:
    """A response record, or a revisit of the record ``first``."""
    fields = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>")]
    fields += [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if url is not None:
        plain = "".join(url.split())
        fields.append(("WARC-Target-URI", plain))
        if plain != url:  # white space has no place in a header
            fields.append(("X-Url", json.dumps(url)))
    if first is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-Id", str(first))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if first is None else http
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """Writes a record per page below ``folder`` and returns (path, size) of the archives, settled."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        store.create_dir(root, recursive=True)
        path, size, out = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "first"))):
                data = member(record(*(x.as_py() for x in row)))
                out = out or store.open_output_stream(path, compression=None)  # the members are compressed
                out.write(data)
                size += len(data)
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "size": [size]})

    return settle(with_revisits(pages, page_id, url, html, least).mapInArrow(write, "path string, size long"), "archives")


class Window:
    """Bytes of a file from some place on, read a block at a time. ``held`` are the bytes from ``start`` on, ``at`` is the place."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.at, self.start, self.held = file, size, at, at, b""

    def ahead(self) -> int:
        return self.start + len(self.held) - self.at

    def fill(self, n: int) -> bool:
        """Whether there are n bytes ahead, or as many as the file has left and at least one."""
        while self.ahead() < n and self.at + self.ahead() < self.size:
            self.file.seek(self.at + self.ahead())
            more = self.file.read(max(READ, n - self.ahead()))
            if not more:
                raise EOFError(f"the archive ends before its {self.size} bytes")
            self.held, self.start = self.held[self.at - self.start :] + more, self.at
        return self.ahead() > 0

    def peek(self, n: int) -> bytes:
        begin = self.at - self.start
        return self.held[begin : begin + n]

    def find(self, what: bytes) -> int:
        """How far ahead ``what`` begins, -1 if it is not among the bytes held."""
        found = self.held.find(what, self.at - self.start)
        return -1 if found < 0 else found - (self.at - self.start)

    def skip(self, n: int) -> None:
        self.at += n

    def back(self, at: int) -> None:
        self.at, self.start, self.held = at, at, b""


def fields_of(head: bytes) -> dict | None:
    """The named fields of a record's header, without its end; None for what is none."""
    lines = head.split(b"\r\n")
    parts = [line.split(b": ", 1) for line in lines[1:]]
    if lines[0] + b"\r\n" != VERSION or any(len(part) != 2 for part in parts):
        return None
    try:
        fields = {k.decode("ascii"): v.decode() for k, v in parts}
    except UnicodeDecodeError:
        return None
    return fields if fields.get("Content-Length", "").isascii() and fields.get("Content-Length", "").isdecimal() and fields.get("WARC-Type") else None


def starts_record(data: bytes) -> bool:
    """Whether the version line of a record inflates from these bytes."""
    if not data.startswith(MAGIC):
        return False
    try:
        # no further than that line, as damage behind it is for the member's reader to find
        return zlib.decompressobj(31).decompress(data, len(VERSION)) == VERSION
    except zlib.error:
        return False


def seek_record(window: Window, end: int) -> bool:
    """Moves to the first member that starts before ``end``."""
    while window.at < end and window.fill(PROBE):
        found = window.find(MAGIC)
        if found < 0:
            window.skip(max(1, window.ahead() - len(MAGIC) + 1))
            continue
        window.skip(found)
        if window.at >= end:
            return False
        window.fill(PROBE)
        if starts_record(window.peek(PROBE)):
            return True
        window.skip(1)
    return False


def inflate(window: Window) -> bytes:
    """The member here, whole; moves behind it."""
    unpacker, parts = zlib.decompressobj(31), []
    while not unpacker.eof:
        if not window.fill(1):
            raise EOFError(f"a member is cut off at byte {window.at}")
        data = window.peek(PIECE)
        parts.append(unpacker.decompress(data))
        window.skip(len(data) - len(unpacker.unused_data))
    return b"".join(parts)


def parse(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = fields_of(head)
    if fields is None:
        raise ValueError("the header is not one of a record")
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']}: the payload does not have its digest")
    return {
        "page_id": fields.get("X-Page-Id"),
        "url": json.loads(fields["X-Url"]) if "X-Url" in fields else fields.get("WARC-Target-URI"),
        "record_type": kind,
        "refers_to": fields.get("X-Refers-To-Page-Id"),
        "payload_digest": digest,
        "payload_bytes": int(sizes["Content-Length"]),
        "payload": payload if kind == "response" else None,
    }


def records_in(store: fs.FileSystem, path: str, size: int, begin: int, end: int) -> Iterator[dict]:
    """The records whose members start in begin:end, and a row of its own kind for a member that is damaged."""
    with store.open_input_file(path) as file:
        window = Window(file, size, begin)
        # after a member the next one follows at once
        while seek_record(window, end):
            at = window.at
            try:
                found = parse(inflate(window))
            except (zlib.error, EOFError, ValueError, KeyError) as error:
                # the members behind it are searched for from here
                found = dict.fromkeys(FIELDS) | {"record_type": "damaged", "refers_to": f"{path}:{at}", "url": str(error), "payload_bytes": 0}
                window.back(at + 1)
            yield found


def read_archives(archives: DataFrame, folder: str, range_bytes: int = RANGE) -> DataFrame:
    """The records of archives (path, size) as RECORD. Revisits have no payload. A damaged member is a row of record_type "damaged", with its
    place in refers_to and what is wrong in url; the records behind it are read."""
    begins = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = archives.select("path", "size", begins.alias("begin"))
    # a range is a task's work: dealt out evenly, whichever files they are of
    count = ranges.count()
    ranges = ranges.repartition(max(1, count), "path", "begin") if count else ranges
    fields = FIELDS

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = file_system(folder)
        for batch in batches:
            for path, size, begin in zip(*(batch.column(c).to_pylist() for c in ("path", "size", "begin"))):
                held, n = [], 0
                for found in records_in(store, path, size, begin, begin + range_bytes):
                    held.append(found)
                    n += found["payload_bytes"]
                    if n > READ:
                        yield rows(held)
                        held, n = [], 0
                if held:
                    yield rows(held)

    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def rows(held: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[f] for x in held], kinds.get(f, pa.string())) for f in fields], fields)

    return ranges.mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", range_bytes: int = RANGE) -> DataFrame:
    """Pages written as archives in the shared folder and read back as RECORD."""
    spark: SparkSession = pages.sparkSession
    folder = shared_folder(spark, "warc")
    return read_archives(write_archives(pages, folder, page_id, url, html), folder, range_bytes)
