"""WARC archives: a writer with revisit records, and a sequential reader.

Pages become records of their own gzip member. Of the pages with equal payloads of at
least ``REVISIT_BYTES``, the one with the largest id is written as a response and the
others as revisits that refer to it and carry no payload; smaller payloads are always
written out. Each task writes archives of bounded size to the shared folder, under names
that no other attempt uses, and returns the names; an archive counts only if the task that
wrote it has succeeded.

The reader takes one archive per task and goes through it once: members are inflated a
chunk at a time, records are framed by their content length, and block and payload
digests are checked. A damaged archive is an error that names the file and the record.

Edge cases: a null html is an empty payload; a null id stays null; rows with equal ids and
payloads are one page each, and if theirs is the largest id all of them are responses; an
empty table gives no archives and no records; other columns are not looked at. Addresses may have
any length and any characters.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitwatch.llm.common import join_hot, shared_path, stored

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64_000_000
CHUNK = 1 << 16
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: What stays of an address, besides letters and digits: all visible ASCII characters.
ADDRESS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address, by the schemes pyarrow has; ``s3a`` and ``s3n`` are
    other names of ``s3``. Other schemes are an error that names them."""
    if ":/" not in path:
        path = f"file://{path}"
    scheme, rest = path.split(":", 1)
    return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else path)


# -- writing ---------------------------------------------------------------------------


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record as a gzip member: a response, or a revisit of the page ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    # bytes that an address cannot hold are escaped, each in its own way
    address = quote(url or "", safe=ADDRESS, errors="surrogatepass")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {address}",
        f"WARC-Payload-Digest: {_digest(payload)}",
        f"WARC-Block-Digest: {_digest(block)}",
        *([f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    whole = "\r\n".join([*head, "", ""]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def revisits(pages: DataFrame) -> DataFrame:
    """``page_id, _digest, refers_to`` of the pages that revisit another."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    large = pages.filter(F.octet_length(payload) >= REVISIT_BYTES).select(
        "page_id", F.sha1(payload.cast("binary")).alias("_digest")
    )
    groups = stored(
        large.groupBy("_digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1"),
        "payloads",
    )
    total = groups.agg(F.sum("n_rows")).first()[0] or 0
    found = join_hot(large, groups, "_digest", total)
    # a null id is less than any other; were all null, none would revisit
    return found.filter("refers_to is not null and (page_id is null or page_id < refers_to)").distinct()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the pages below ``folder``; ``path, records, bytes`` of each archive."""
    again = revisits(pages).select(
        F.col("page_id").alias("_page"), F.col("_digest").alias("_payload"), "refers_to"
    )
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    own = pages.select("page_id", "url", "html", digest.alias("_own"))
    rows = own.join(
        again, own["page_id"].eqNullSafe(again["_page"]) & (own["_own"] == again["_payload"]), "left"
    ).select("page_id", "url", "html", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        target, root = filesystem(folder)
        name = f"{root}/pages-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, done = None, []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path = f"{name}-{len(done):04d}.warc.gz"
                    out, done = target.open_output_stream(path), [*done, [f"{folder}/{path.rsplit('/', 1)[1]}", 0, 0]]
                data = record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers_to)
                out.write(data)
                done[-1][1] += 1
                done[-1][2] += len(data)
                if done[-1][2] >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column) for column in zip(*done, strict=True)], ["path", "records", "bytes"]
            )

    target, root = filesystem(folder)
    target.create_dir(root, recursive=True)
    return stored(rows.mapInArrow(write, "path string, records long, bytes long"), "archives")


# -- reading ---------------------------------------------------------------------------


@dataclass
class Record:
    """Headers of a record and what its block has shown so far."""

    headers: dict[str, str]
    http: bytes = b""
    payload_size: int = 0
    block: "hashlib._Hash" = field(default_factory=hashlib.sha1)
    payload: "hashlib._Hash" = field(default_factory=hashlib.sha1)


class _Members:
    """Bytes of an archive, inflated member by member and chunk by chunk."""

    def __init__(self, source: BinaryIO):
        self.source, self.raw = source, b""
        self.inflate, self.ready = None, bytearray()
        self.ended = False  # the last member is complete

    def begin(self) -> bool:
        """Goes to the next member; false at the end of the archive."""
        if not self.raw:
            self.raw = self.source.read(CHUNK)
        if not self.raw:
            return False
        self.inflate, self.ready, self.ended = zlib.decompressobj(31), bytearray(), False
        return True

    def more(self) -> bool:
        """Inflates a little more; false if the member has ended."""
        if self.ended:
            return False
        if not self.raw and not self.inflate.unconsumed_tail:
            self.raw = self.source.read(CHUNK)
            if not self.raw:
                raise ValueError("the archive ends inside a member")
        self.ready += self.inflate.decompress(self.inflate.unconsumed_tail + self.raw, CHUNK)
        self.raw = b""
        if self.inflate.eof:
            self.raw, self.ended = self.inflate.unused_data, True
        return True

    def until(self, mark: bytes) -> bytes:
        """Everything up to and with the mark, however far into the member it is."""
        seen = 0
        while (at := self.ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.ready)
            if not self.more():
                raise ValueError("a header has no end")
        out = bytes(self.ready[: at + len(mark)])
        del self.ready[: at + len(mark)]
        return out

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces."""
        while size:
            if not self.ready and not self.more():
                raise ValueError("a record is shorter than its content length")
            part = bytes(self.ready[:size])
            del self.ready[: len(part)]
            size -= len(part)
            if part:
                yield part


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8", "replace").split("\r\n")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs} | {"": lines[0]}


def records(source: BinaryIO) -> Iterator[Record]:
    """Records of an archive in order, their digests checked."""
    members = _Members(source)
    while members.begin():
        headers = _headers(members.until(b"\r\n\r\n"))
        if not headers[""].startswith("WARC/"):
            raise ValueError("no WARC record")
        found = Record(headers)
        in_http = True
        for part in members.take(int(headers["content-length"])):
            found.block.update(part)
            if in_http:
                found.http += part
                if (at := found.http.find(b"\r\n\r\n")) >= 0:
                    part, in_http = found.http[at + 4 :], False
                    found.http = found.http[: at + 4]
            if not in_http:
                found.payload.update(part)
                found.payload_size += len(part)
        if b"".join(members.take(4)) != b"\r\n\r\n" or members.ready or members.more() and members.ready:
            raise ValueError(f"{headers.get('warc-record-id')}: more than one record in a member")
        _verify(found)
        yield found


def _verify(found: Record) -> None:
    headers = found.headers
    expected = {"warc-block-digest": found.block}
    if headers.get("warc-type") == "response":
        expected["warc-payload-digest"] = found.payload
    for name, seen in expected.items():
        if headers.get(name, "") != "sha1:" + base64.b32encode(seen.digest()).decode():
            raise ValueError(f"{headers.get('warc-record-id')}: {name} does not match")


def _page(of: str | None) -> int | None:
    number = (of or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "null") else int(number)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string"


def read_archives(archives: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` and the archive's
    ``path`` of every record; size and digest are of the full payload, for revisits too."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target, name = filesystem(path)
                rows = []
                with target.open_input_stream(name) as source:
                    try:
                        for found in records(source):
                            headers, http = found.headers, _headers(found.http)
                            size = int(http["content-length"])
                            if headers["warc-type"] == "response" and size != found.payload_size:
                                raise ValueError(f"{headers['warc-record-id']}: payload size does not match")
                            digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                            rows.append((
                                _page(headers["warc-record-id"]), size, digest, headers["warc-type"],
                                _page(headers.get("warc-refers-to")), path,
                            ))
                            if len(rows) == 10_000:
                                yield _batch(rows)
                                rows = []
                    except (ValueError, zlib.error, KeyError) as error:
                        raise ValueError(f"{path}: {error}") from error
                yield _batch(rows)

    count = max(1, archives.count())
    # names are all different, so ranges of them hold equal numbers of archives
    numbered = archives.select("path").repartitionByRange(min(count, 10_000), "path")
    return numbered.mapInArrow(scan, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = [part.split()[0] for part in READ.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)], names
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """All pages written to archives in the shared folder and read back."""
    folder = shared_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder))
