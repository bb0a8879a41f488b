"""WARC archives: a writer of one gzip member per record, and a sequential reader.

Executors write and read the archives through Arrow's file systems, in a folder that all of them share. An attempt of a
task writes files under names of its own and reports them as rows of a table; so files of lost or repeated attempts are
never read. The reader inflates one member after the other from a stream, takes header lines up to the blank line and
then as many bytes as Content-Length says, verifies both digests and that record and member end together; it holds one
record at a time, and after damage goes on at the next member.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelmill.llm.scratch import new_folder, stored

ARCHIVE_BYTES = 64 << 20  # an archive is closed once it has reached this size
REVISIT_BYTES = 1000  # payloads below are always written out
CHUNK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables hold no time of capture
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs


def record_id(page: int | None) -> str:
    """The id of a page's record: the same in every attempt, so that revisits can name it."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page/{page}') if page is not None else uuid.uuid4()}>"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """A record: a response with the payload, or a revisit of the response of another page without it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": record_id(page), "WARC-Date": DATE,
        "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else None,
        "WARC-Payload-Digest": _digest(payload), "WARC-Block-Digest": _digest(block),
        "Content-Type": "application/http;msgtype=response",
        "WARC-Refers-To": None if refers_to is None else record_id(refers_to), "WARC-Profile": None if refers_to is None else PROFILE,
        "X-Page-Id": page, "X-Refers-To-Page": refers_to, "X-Payload-Length": len(payload), "Content-Length": len(block),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, folder: str, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record of each page into archives in `folder`; returns the table of archives (path, records, bytes).

    Of records with equal payloads of at least `REVISIT_BYTES` bytes, that with the largest page id is a response and
    the others revisit it. Rows with a null page id are responses that nothing refers to; null html is an empty payload.
    Equal rows are all written; rows that share the largest id of their payload are all responses.
    """
    rows = pages.select(F.col(page).cast("long").alias("page"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"))
    keyed = rows.withColumn("sha", F.sha1("payload"))
    long = keyed.filter((F.length("payload") >= REVISIT_BYTES) & F.col("page").isNotNull()).select("page", "sha")
    last = long.groupBy("sha").agg(F.max("page").alias("last"), F.min("page").alias("first")).filter("first < last")
    revisits = long.join(last, "sha").filter("page < last").select("page", "sha", "last").distinct()
    todo = keyed.join(revisits, ["page", "sha"], "left").select("page", "url", "payload", "last")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = FileSystem.from_uri(folder)
        system.create_dir(top, recursive=True)
        archives, out, name, count, size = [], None, "", 0, 0
        for batch in batches:
            for p, u, data, to in zip(*(batch.column(i) for i in range(4))):
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    # else the stream would compress by the name's ending
                    out = system.open_output_stream(f"{top}/{name}", compression=None)
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = member.compress(record(p.as_py(), u.as_py(), data.as_py(), to.as_py())) + member.flush()
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    archives.append((f"{folder}/{name}", count, size))
                    out = None
        if out is not None:
            out.close()
            archives.append((f"{folder}/{name}", count, size))
        columns = [pa.array([a[i] for a in archives], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["path", "records", "bytes"])

    return stored(todo.mapInArrow(write, "path string, records long, bytes long"), "archives")


_MAGIC = b"\x1f\x8b\x08"  # how a gzip member begins


class _Archive:
    """The bytes of a stream that are not read yet, from the front."""

    def __init__(self, stream):
        self.stream, self.raw = stream, b""

    def has(self, n: int) -> bool:
        while len(self.raw) < n and (more := self.stream.read(CHUNK)):
            self.raw += more
        return len(self.raw) >= n

    def take(self) -> bytes:
        out, self.raw = self.raw or self.stream.read(CHUNK), b""
        return out

    def seek_member(self) -> bool:
        """Drop what comes before the next begin of a member; False if there is none."""
        while self.has(len(_MAGIC)):
            at = self.raw.find(_MAGIC)
            if at >= 0:
                self.raw = self.raw[at:]
                return True
            self.raw = self.raw[1 - len(_MAGIC) :]
            if not (more := self.stream.read(CHUNK)):
                return False
            self.raw += more
        return False


class _Member:
    """The inflated bytes of one gzip member, as they are asked for."""

    def __init__(self, archive: _Archive):
        self.archive, self.held, self.seen = archive, bytearray(), bytearray()
        self.inflate, self.damaged = zlib.decompressobj(31), False

    def more(self) -> bool:
        """Inflate some more; False at the end of the member and where it is damaged."""
        if self.inflate.eof or self.damaged:
            return False
        raw = self.archive.take()
        try:
            out = self.inflate.decompress(raw, CHUNK)
        except zlib.error:
            out = b""
            self.damaged = True
        if not raw and not out and not self.inflate.eof:
            self.damaged = True  # cut off
        left = b"" if self.damaged else self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        self.seen += raw[: len(raw) - len(left)]
        # of a damaged member only its first byte is given up: the next one may begin anywhere after it
        self.archive.raw = bytes(self.seen[1:]) if self.damaged else left
        self.held += out
        return not self.damaged

    def line(self) -> bytes | None:
        """The next line without its end; None if there is none."""
        at = 0
        while (end := self.held.find(b"\r\n", at)) < 0:
            at = max(0, len(self.held) - 1)
            if not self.more():
                return None
        out = bytes(self.held[:end])
        del self.held[: end + 2]
        return out

    def take(self, n: int) -> bytes:
        """n bytes, or fewer at the end."""
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def ended(self) -> bool:
        """Whether all of it is read, and its own checksum was right."""
        while not self.held and self.more():
            pass
        return not self.held and self.inflate.eof


def _record(member: _Member) -> tuple[dict[str, str], bytes, bool] | None:
    """The next record of a member; None if none begins there."""
    version = member.line()
    if version is None or not version.startswith(b"WARC/"):
        return None
    fields: dict[str, str] = {}
    while line := member.line():
        key, _, value = line.decode("utf-8", "replace").partition(":")
        fields[key.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    if line is None or not (length.isascii() and length.isdecimal()):
        return fields, b"", False
    block = member.take(int(length))
    intact = len(block) == int(length) and member.take(4) == b"\r\n\r\n"
    payload = block.partition(b"\r\n\r\n")[2]
    intact = intact and fields.get("warc-block-digest", _digest(block)) == _digest(block)
    if fields.get("warc-type") == "response":
        intact = intact and fields.get("warc-payload-digest", _digest(payload)) == _digest(payload)
    return fields, block, intact


def records(stream) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    """(header fields, block, intact) of every record.

    A record is intact if its digests are right, and it is all of one member whose checksum is right. Of a damaged member comes
    what can be read, not intact; the reader goes on at the next member. So do other bytes between members and after the last.
    """
    archive, lost = _Archive(stream), False  # lost: looking for a member after damage, which was reported
    while archive.has(1):
        if not (archive.has(len(_MAGIC)) and archive.raw.startswith(_MAGIC)):
            if not lost:
                yield {}, b"", False
            lost = True
            if not archive.seek_member():
                return
        member, found = _Member(archive), 0
        while not member.ended():
            if member.damaged and not member.held:
                break
            one = _record(member)
            if one is None:
                break
            fields, block, intact = one
            found += 1
            alone = member.ended() and found == 1
            yield fields, block, intact and alone
        if not member.ended():  # damaged, or more than records
            while member.more():
                member.held.clear()
            if not found and not lost:
                yield {}, b"", False
            lost = member.damaged
        elif found:
            lost = False
        elif not lost:
            yield {}, b"", False  # an empty member


RECORDS = (
    "page long, record_type string, record_id string, target_uri string, payload_bytes long, payload_digest string, "
    "refers_to long, intact boolean, payload binary"
)


def read_warc(spark: SparkSession, archives: DataFrame, payload: bool = True) -> DataFrame:
    """One row for each record of the archives named in the column `path`; payload only where it is asked for.

    The payload of a revisit is null; its digest and length are those of the response. Digests are given as hex. A record that is
    damaged, misframed or not alone in its member has intact = false and what fields could be read; the others are not touched by it.
    An archive without bytes has no records.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, at = FileSystem.from_uri(path)
                rows, size = [], 0
                with system.open_input_stream(at, compression=None) as stream:
                    for fields, block, intact in records(stream):
                        get = fields.get
                        number = lambda key: int(get(key)) if get(key, "").lstrip("-").isdecimal() else None  # noqa: B023, E731
                        body = block.partition(b"\r\n\r\n")[2] if get("warc-type") == "response" else None
                        digest = get("warc-payload-digest", "").removeprefix("sha1:")
                        digest = base64.b32decode(digest).hex() if len(digest) == 32 else digest or None
                        length = len(body) if body is not None else number("x-payload-length")
                        rows.append((number("x-page-id"), get("warc-type"), get("warc-record-id"), get("warc-target-uri"), length, digest,
                                     number("x-refers-to-page"), intact, body if payload else None))
                        size += len(body or b"") if payload else 100
                        if size > 4 << 20:
                            yield flush(rows)
                            rows, size = [], 0
                yield flush(rows)

    names = [c.split()[0] for c in RECORDS.split(", ")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(n).mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages into archives in the shared folder and read the records back."""
    spark = pages.sparkSession
    return read_warc(spark, write_warc(pages, new_folder(spark, "warc")), payload=False)
