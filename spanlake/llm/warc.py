"""WARC archives: a writer that stores equal payloads once, and a reader that salvages.

Each record is a gzip member of its own.  Of the pages with equal payloads those with the smallest
id are stored as responses, the others as revisits that refer to it.  The reader goes forward through
one buffer and checks every member and record: gzip checksum, version line, lengths and block digest.
After a failed check it searches for the next member or version line at which a sound record begins,
goes on there, and logs the gap in between with its first reason.  Within a member it does the same in the
inflated bytes, up to where they can be inflated.  Of a member that fails its own checks those records
are kept whose block digest proves them, but none where only the gzip checksum tells of damage: it may
lie in any head.  Names of headers count in any case.

A NULL payload is the empty one and a NULL url the empty text.  A page without id is a response only
if no page with an equal payload has one.  Repeated rows are all written; rows that share the
smallest id are all responses.  An empty table gives no archive.  Line breaks in urls are escaped.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import store, written

ARCHIVE_BYTES = 64 << 20
"""Size from which the writer of a task goes on in a new archive: one task reads one archive."""

READ_BYTES = 1 << 20
"""Size of a request to the store."""

FIRST_BYTES = 1 << 12
"""First step into a member or record; the steps double."""

LEVEL = 4

# Fixed value: how the library's errors end where all could be inflated but differs from its checksum.
CHECKSUM_ONLY = (" data check", " length check")

# Fixed values of the format.
VERSION = b"WARC/1.1"
VERSION_START = b"WARC/1."
GZIP_START = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

PAGE, SIZE = "X-Page-Id", "X-Payload-Bytes"
"""Extension headers: the page, and the length of the full payload also where it is not stored."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'page:{page}')}>"


def header_text(value: str) -> str:
    """The value on one line: line breaks are percent-encoded, and then percent signs as well."""
    if "\r" in value or "\n" in value:
        value = value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    return value


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {header_text(v)}\r\n" for k, v in headers.items())
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page: int | None, url: str, payload: bytes, first: int | None) -> bytes:
    """Record of a page; ``first`` is the page that holds its payload, itself for a response."""
    digest = sha1_base32(payload)
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = f"{http}Content-Length: {len(payload)}\r\n\r\n".encode()
    headers = {
        "WARC-Type": "response" if first == page else "revisit",
        "WARC-Record-ID": record_id(page),
        "WARC-Date": DATE,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{digest}",
        SIZE: str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
    }
    if page is not None:
        headers[PAGE] = str(page)
    if first == page:
        block += payload
    else:
        headers["WARC-Profile"] = REVISIT_PROFILE
        headers["WARC-Refers-To"] = record_id(first)
        headers[f"{PAGE}-Referred"] = str(first)
    headers["WARC-Block-Digest"] = f"sha1:{sha1_base32(block)}"
    headers["Content-Length"] = str(len(block))
    return record_bytes(headers, block)


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write the archives and return their list (``file``, ``records``, ``bytes``).

    A task that runs again writes files of new names; only those of finished tasks are listed.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    first = rows.groupBy("sha").agg(F.min("page").alias("first"))
    linked = rows.join(first, "sha").select("page", "url", "payload", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        files.create_dir(root, recursive=True)
        out, name, count = None, "", 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("page", "url", "payload", "first"))
            for page, target, payload, stored_at in zip(*columns):
                if out is None:
                    name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                out.write(gzip_member(page_record(page, target, payload, stored_at)))
                count += 1
                if out.tell() >= ARCHIVE_BYTES:
                    yield listed(name, count, out)
                    out = None
        if out is not None:
            yield listed(name, count, out)

    def listed(name: str, count: int, out) -> pa.RecordBatch:
        size = out.tell()
        out.close()
        return pa.RecordBatch.from_pydict({"file": [name], "records": [count], "bytes": [size]})

    return written(linked.mapInArrow(write, "file string, records long, bytes long"), "archives")


class Headers(dict):
    """Values by name in any case; of a repeated name the last one."""

    def __setitem__(self, name: str, value: str) -> None:
        super().__setitem__(name.lower(), value)

    def __getitem__(self, name: str) -> str:
        return super().__getitem__(name.lower())

    def get(self, name: str, default: str | None = None) -> str | None:
        return super().get(name.lower(), default)


@dataclass
class Record:
    begin: int
    end: int
    headers: Headers
    block: bytes


class Broken(Exception):
    """A check failed; the text is the reason."""


class Reader:
    """Records of one archive, packed in gzip members or plain, and the gaps between them.

    A gap is a range of the file and a reason.  A gap inside of a sound member has the member's range, and
    the reason names the inflated bytes.
    """

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.start, self.held = 0, b""
        self.gaps: list[tuple[int, int, str]] = []

    def read(self, begin: int, count: int) -> bytes:
        """Bytes of the file; going forward, each byte is fetched once."""
        end, stop = min(begin + count, self.size), self.start + len(self.held)
        if begin < self.start or end > stop:
            kept = self.held[begin - self.start :] if self.start <= begin <= stop else b""
            at = begin + len(kept)
            wanted = min(max(end - at, READ_BYTES), self.size - at)
            self.start, self.held = begin, kept + self.file.read_at(wanted, at)
        return self.held[begin - self.start : end - self.start]

    def records(self) -> Iterator[Record]:
        at, lost, reason = 0, None, ""
        while at < self.size:
            try:
                found, end, why = self._at(at)
            except Broken as e:
                found, end, why = [], None, str(e)
            if lost is not None and (found or end is not None):
                self.gaps.append((lost, at, reason))
                lost = None
            yield from found
            if end is None:
                if lost is None:
                    lost, reason = at, why
                at = self._next(at + 1)
            else:
                at = end
        if lost is not None:
            self.gaps.append((lost, self.size, reason))

    def _at(self, begin: int) -> tuple[list[Record], int | None, str]:
        """Records at an offset, the offset after them or None where it is lost, and the reason."""
        start = self.read(begin, len(VERSION_START))
        if start.startswith(GZIP_START):
            return self._packed(begin)
        if start == VERSION_START:
            size = FIRST_BYTES
            while True:  # the record is read in steps that double until it is whole
                data = self.read(begin, size)
                try:
                    headers, block, at = parsed(data, 0)
                except Broken:
                    if size >= self.size - begin or not may_go_on(data, self.size - begin):
                        raise
                    size *= 2
                    continue
                return [Record(begin, begin + at, headers, block)], begin + at, ""
        raise Broken("no member or version line")

    def _packed(self, begin: int) -> tuple[list[Record], int | None, str]:
        data, end, why = self._member(begin)
        found, gaps = [], []
        for a, b, record in inner(data):
            if isinstance(record, str):
                gaps.append((a, b, record))
            elif end is not None or proven(record[0]):
                found.append(Record(begin, end or begin, *record))
        if not found or (why.endswith(CHECKSUM_ONLY) and not gaps):
            raise Broken(why or (gaps[0][2] if gaps else "empty member"))
        if end is not None:
            self.gaps += [(begin, end, f"{r} (inflated bytes {a} to {b})") for a, b, r in gaps]
        return found, end, why

    def _member(self, begin: int) -> tuple[bytes, int | None, str]:
        """Inflated bytes, the offset after the member or None if it is not sound, and the reason."""
        unpack, parts, at, step = zlib.decompressobj(31), [], begin, FIRST_BYTES
        try:
            while not unpack.eof:
                chunk = self.read(at, step)
                if not chunk:
                    return b"".join(parts), None, "member cut short"
                parts.append(unpack.decompress(chunk))
                at, step = at + len(chunk), min(2 * step, READ_BYTES)
        except zlib.error as e:
            return self._inflated(begin, at + step), None, f"gzip: {e}"
        return b"".join(parts), at - len(unpack.unused_data), ""

    def _inflated(self, begin: int, end: int) -> bytes:
        """What can be inflated of a member before it fails."""
        unpack, parts = zlib.decompressobj(31), []
        try:
            for at in range(begin, min(end, self.size), 64):
                before, chunk = unpack.copy(), self.read(at, 64)
                parts.append(unpack.decompress(chunk))
        except zlib.error:
            try:
                for byte in chunk:
                    parts.append(before.decompress(bytes([byte])))
            except zlib.error:
                pass
        return b"".join(parts)

    def _next(self, begin: int) -> int:
        """Next offset at which a member or a version line may begin."""
        while begin < self.size:
            data = self.read(begin, FIRST_BYTES)
            hits = [i for s in (GZIP_START, VERSION_START) if (i := data.find(s)) >= 0]
            if hits:
                return begin + min(hits)
            if begin + len(data) >= self.size:
                break
            begin += len(data) - len(VERSION_START) + 1
        return self.size


def inner(data: bytes) -> Iterator[tuple[int, int, tuple[Headers, bytes] | str]]:
    """Records in inflated bytes, and between them the reasons of gaps, each with its range."""
    at, lost, reason = 0, None, ""
    while at < len(data):
        try:
            headers, block, end = parsed(data, at)
        except Broken as e:
            if lost is None:
                lost, reason = at, str(e)
            at = data.find(VERSION_START, at + 1)
            if at < 0:
                break
            continue
        if lost is not None:
            yield lost, at, reason
            lost = None
        yield at, end, (headers, block)
        at = end
    if lost is not None:
        yield lost, len(data), reason


def proven(headers: Headers) -> bool:
    """Whether the record has a digest of its block; ``parsed`` has compared it."""
    return headers.get("WARC-Block-Digest", "").startswith("sha1:")


def may_go_on(data: bytes, left: int) -> bool:
    """Whether more bytes can complete the record that ``data`` begins."""
    head = data.find(b"\r\n\r\n")
    if head < 0:
        return all(b":" in line for line in data.split(b"\r\n")[1:-1])
    for line in data[:head].split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return len(data) < head + 8 + int(value) <= left
    return False


def parsed(data: bytes, at: int) -> tuple[Headers, bytes, int]:
    """Headers and block of the record at an offset, and the offset after it."""
    head = data.find(b"\r\n\r\n", at)
    version, *lines = data[at:head].split(b"\r\n") if head >= 0 else [b""]
    if not (version.startswith(VERSION_START) and version[len(VERSION_START) :].isdigit()):
        raise Broken("no record head")
    headers = Headers()
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Broken("malformed header")
        headers[name.decode("utf-8", "replace").strip()] = value.decode("utf-8", "replace").strip()
    length = headers.get("Content-Length", "")
    if not (length.isascii() and length.isdigit()):
        raise Broken("no content length")
    begin, end = head + 4, head + 4 + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Broken("length does not fit")
    block, digest = data[begin:end], headers.get("WARC-Block-Digest", "")
    if digest.startswith("sha1:") and digest != f"sha1:{sha1_base32(block)}":
        raise Broken("block digest differs")
    return headers, block, end + 4


RECORD_SCHEMA = """file string, begin long, end long, gap string, record_type string,
record_id string, url string, page_id long, payload_bytes long, payload_digest string,
refers_to long, payload binary"""


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Records and gaps of the archives in the column ``file``, relative to ``folder``.

    A gap has its reason in ``gap`` and NULL in all columns after it.  The payload of a revisit is
    NULL.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                place = f"{root}/{name}"
                reader = Reader(files.open_input_file(place), files.get_file_info(place).size)
                rows, size = [], 0
                for record in reader.records():
                    rows.append(row_of(name, record))
                    size += len(record.block)
                    if size > 1 << 22:
                        yield made(rows)
                        rows, size = [], 0
                rows += [(name, a, b, why, *[None] * 8) for a, b, why in reader.gaps]
                if rows:
                    yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64()]
        types += [pa.string(), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in RECORD_SCHEMA.split(",")]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names
        )

    count = max(archives.count(), 1)
    return (
        archives.select("file").repartitionByRange(count, "file").mapInArrow(read, RECORD_SCHEMA)
    )


def row_of(name: str, record: Record) -> tuple:
    h, block = record.headers, record.block
    kind = h.get("WARC-Type")
    payload = block
    if "application/http" in h.get("Content-Type", ""):
        payload = block.partition(b"\r\n\r\n")[2]
    whole = kind != "revisit"
    size = h.get(SIZE, str(len(payload)) if whole else "")
    digest = h.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    return (
        name,
        record.begin,
        record.end,
        None,
        kind,
        h.get("WARC-Record-ID"),
        h.get("WARC-Target-URI"),
        _number(h.get(PAGE)),
        len(payload) if whole else _number(size),
        sha1_base32(payload) if whole else digest or None,
        _number(h.get(f"{PAGE}-Referred")),
        payload if whole else None,
    )


def _number(text: str | None) -> int | None:
    digits = (text or "").removeprefix("-")
    return int(text) if digits.isascii() and digits.isdigit() else None
