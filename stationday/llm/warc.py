"""WARC archives written by Spark and read back by a salvage reader.

**Writing.** Every page becomes one record in a gzip member of its own. Of the
pages with equal payloads the one with the smallest page_id (NULL last; of equal
ids the first by place in the table) is a ``response``, the others are
``revisit`` records that name it and carry the HTTP head but no payload. The
digests are counted first: pages send their SHA-256, not their text, and only
digests met more than once come back, as a table that Spark broadcasts if its
files are small and joins by sorting otherwise. Members are written by Spark's
text writer as they are (the separator after each is an empty gzip member), so a
task that is lost or run twice leaves no half file.

**Reading.** A file is read by one task, in pieces of ``PIECE`` bytes; a task
holds one member. At each place a member or, in plain archives, a version line
must begin there and pass its checks: the member's CRC and length, the version
line, the header, its Content-Length against the bytes there are, the end mark
and the block digest. After a failed check the reader searches for the next place
where all checks pass, goes on from there and reports the bytes between as a
gap, with the first reason. A record whose member is sound but whose content
fails is a gap as long as the member. Records and gaps together cover every byte
of a file but the empty separators.

NULL and empty html is an empty payload; all empty payloads are equal, so one of
those pages is the response. NULL url gives a record without a target; a url
with control characters is written percent-encoded. NULL page_ids are written as
such and come back as NULL. Repeated rows are separate records. An empty table
gives no archive and an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.llm.common import map_texts, on_workers, saved, scratch_path, table

PIECE = 1 << 18
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
FILE_RECORDS = 100_000  # records of an archive file, at most

#: An empty gzip member; the text writer puts one after each record.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff0300") + bytes(8)

#: Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/\d")
_END = b"\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- writing -------------------------------------------------------------------


def _record_id(page_id: int | None, place: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{place}>"


def page_of(record_id: str) -> int | None:
    """The page_id in a record id."""
    own = record_id.strip("<>").split(":")[2]
    return int(own) if own else None


def record(kind: str, record_id: str, url: str | None, payload: bytes, refers_to: str | None = None) -> bytes:
    """One record: header, HTTP head, payload (not for a revisit), end mark."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if kind == "response":
        block += payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", refers_to or "")]
    head += [("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)), ("WARC-Block-Digest", "sha1:" + base32_sha1(block))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode() + block + _END


def member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def numbered(pages: DataFrame) -> DataFrame:
    """(page_id, place, url, html) with a number for each row by its place. The
    frame is read more than once and must give the same rows in the same
    partitions, as a table of files does."""
    return pages.select("page_id", F.monotonically_increasing_id().alias("place"), "url", F.coalesce("html", F.lit("")).alias("html"))


def repeated_payloads(rows: DataFrame) -> DataFrame:
    """(digest, first): for every payload of more than one row, the row that is
    written whole."""
    key = F.unhex(F.sha2(F.col("html").cast("binary"), 256)).alias("digest")
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "place")).alias("first")
    return rows.select(key, "page_id", "place").groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")


def write_archives(pages: DataFrame, path: str) -> None:
    """All pages(page_id, url, html) as archives in the folder ``path``."""
    spark = pages.sparkSession
    on_workers(spark)
    rows = numbered(pages)
    repeats = saved(repeated_payloads(rows), "warc-repeats")
    key = F.unhex(F.sha2(F.col("html").cast("binary"), 256))
    rows = rows.withColumn("digest", key).join(repeats, "digest", "left")
    again = F.col("first").isNotNull() & (F.col("first.place") != F.col("place"))
    rows = rows.select("page_id", "place", "url", "html", again.alias("again"), F.col("first.page_id").alias("to_id"), F.col("first.place").alias("to_place"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for page_id, place, url, html, again_, to_id, to_place in zip(*(c.to_pylist() for c in batch.columns)):
            payload = html.encode()
            args = ("revisit", _record_id(page_id, place), url, payload, _record_id(to_id, to_place)) if again_ else ("response", _record_id(page_id, place), url, payload)
            out.append(member(record(*args)))
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    members = map_texts(rows, run, "member binary", text="html")
    lines = members.select(F.col("member").cast("string").alias("value"))
    lines.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("ISO-8859-1")).option("maxRecordsPerFile", FILE_RECORDS).text(path)


# --- reading -------------------------------------------------------------------


class Bytes:
    """Random access to a file, read in pieces; holds what one check needs."""

    def __init__(self, f, length: int):
        self.f, self.length = f, length
        self.at, self.held = 0, b""

    def get(self, pos: int, n: int) -> bytes:
        """Up to n bytes from pos."""
        n = max(0, min(n, self.length - pos))
        if not (self.at <= pos and pos + n <= self.at + len(self.held)):
            self.f.seek(pos)
            self.held, self.at = self.f.read(min(max(n, PIECE), self.length - pos)), pos
        return self.held[pos - self.at : pos - self.at + n]

    def find(self, pos: int) -> int:
        """The next place from pos on where a member or a version line may
        begin, or the end of the file."""
        while pos < self.length:
            piece = self.get(pos, PIECE)
            if m := _START.search(piece):
                return pos + m.start()
            if pos + len(piece) >= self.length:
                break
            pos += len(piece) - 5  # a start may lie across two pieces
        return self.length


class Broken(Exception):
    """A check that failed. ``end``: where the bytes that belong to what failed
    surely end, if they do."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.reason, self.end = reason, end


@dataclass
class Record:
    offset: int
    length: int
    head: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


def _header(raw: bytes) -> dict[str, str]:
    """Fields by lower-case name; a folded line goes on with the one before."""
    out: dict[str, str] = {}
    last = ""
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in " \t" and last:
            out[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise Broken("header line without a name")
        last = name.strip().lower()
        out[last] = value.strip()
    return out


def _parsed(read, pos: int) -> tuple[dict[str, str], int, int]:
    """(header, start of the block, its length) of the record at ``pos``, where
    ``read(pos, n)`` gives up to n bytes."""
    first = read(pos, 64)
    if not _VERSION.match(first):
        raise Broken("no version line")
    size = 1024
    while True:
        raw = read(pos, size)
        at = raw.find(_END)
        if at >= 0:
            break
        if len(raw) < size:
            raise Broken("header without an end")
        size *= 4
    head = _header(raw[:at])
    n = head.get("content-length", "")
    if not n.isascii() or not n.isdigit():
        raise Broken("no content length")
    return head, pos + at + len(_END), int(n)


def _checked(head: dict[str, str], block: bytes) -> None:
    digest = head.get("warc-block-digest", "")
    if digest.lower().startswith("sha1:") and digest[5:].upper() != base32_sha1(block):
        raise Broken("block digest differs")


def _plain(src: Bytes, pos: int) -> tuple[list[Record], int]:
    head, start, n = _parsed(src.get, pos)
    if start + n + len(_END) > src.length:
        raise Broken("record longer than the file")
    if src.get(start + n, len(_END)) != _END:
        raise Broken("no end mark after the block")
    block = src.get(start, n)
    _checked(head, block)
    end = start + n + len(_END)
    return [Record(pos, end - pos, head, block)], end


def _inflated(src: Bytes, pos: int) -> tuple[bytes, int]:
    """The content of the member at pos and where it ends; zlib checks its CRC
    and length."""
    z, out, at = zlib.decompressobj(31), [], pos
    while not z.eof:
        piece = src.get(at, PIECE)
        if not piece:
            raise Broken("member without an end")
        try:
            out.append(z.decompress(piece))
        except zlib.error:
            raise Broken("member damaged") from None
        at += len(piece)
    return b"".join(out), at - len(z.unused_data)


def _member(src: Bytes, pos: int) -> tuple[list[Record], int]:
    data, end = _inflated(src, pos)
    found, at = [], 0
    while at < len(data):
        try:
            head, start, n = _parsed(lambda p, k: data[p : p + k], at)
            if data[start + n : start + n + len(_END)] != _END:
                raise Broken("no end mark after the block")
            _checked(head, block := data[start : start + n])
        except Broken as e:
            raise Broken(e.reason, end) from None
        found.append(Record(pos, end - pos, head, block))
        at = start + n + len(_END)
    return found, end


def salvage(f, length: int) -> Iterator[Record | Gap]:
    """Records and gaps of one archive, in order. The records of a member have
    its offset and length."""
    src, pos = Bytes(f, length), 0
    lost: tuple[int, str] | None = None  # where the open gap begins, and why
    while pos < length:
        try:
            begin = src.get(pos, 5)
            if begin[:3] == MAGIC:
                found, end = _member(src, pos)
            elif begin == b"WARC/":
                found, end = _plain(src, pos)
            else:
                raise Broken("neither a member nor a version line")
        except Broken as e:
            lost = lost or (pos, e.reason)
            pos = e.end or src.find(pos + 1)
            if e.end:  # sound framing: the search need not look inside
                yield Gap(lost[0], pos - lost[0], lost[1])
                lost = None
            continue
        if lost:
            yield Gap(lost[0], pos - lost[0], lost[1])
            lost = None
        yield from found
        pos = end
    if lost:
        yield Gap(lost[0], length - lost[0], lost[1])


def _opened(path: str):
    """The file of a URI, for random access, by the store's own client."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, own = fs.FileSystem.from_uri(path)
    return store.open_input_file(own)


READ = "path string, offset bigint, length bigint, gap string, head map<string,string>, block binary"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, offset, length, gap, head, block): every record of the archives in
    the folder ``path`` with its header (names in lower case) and block, and every
    quarantined gap with its reason in ``gap`` (NULL for records)."""
    on_workers(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!._]*").load(path).select("path", "length")

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=["path", "offset", "length", "gap", "head", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size = [], 0
                with _opened(name) as f:
                    for x in salvage(f, length):
                        rows.append((name, x.offset, x.length, x.reason, None, None) if isinstance(x, Gap) else (name, x.offset, x.length, None, list(x.head.items()), x.block))
                        size += 0 if isinstance(x, Gap) else len(x.block)
                        if size >= 8 * PIECE or len(rows) >= 10_000:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(run, READ)


def gaps(read: DataFrame) -> DataFrame:
    """The quarantine log: (path, offset, length, reason)."""
    return read.filter(F.col("gap").isNotNull()).select("path", "offset", "length", F.col("gap").alias("reason"))


def http_records(read: DataFrame, payloads: bool = True) -> DataFrame:
    """(record_id, record_type, target, refers_to, payload_digest, payload_bytes,
    payload) of responses and revisits. A response's digest and size are those of
    the payload that was read, a revisit's are those it states of its response's;
    its payload is NULL, and all are without ``payloads``."""
    rows = read.filter(F.col("gap").isNull()).select("head", "block")
    schema = "record_id string, record_type string, target string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for head, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                head = dict(head)
                kind = head.get("warc-type")
                if kind not in ("response", "revisit"):
                    continue
                top, _, payload = block.partition(_END)
                if kind == "response":
                    said = (base32_sha1(payload), len(payload), payload if payloads else None)
                else:
                    size = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", top)
                    said = (head.get("warc-payload-digest", "").partition(":")[2] or None, int(size[1]) if size else None, None)
                out.append((head.get("warc-record-id"), kind, head.get("warc-target-uri"), head.get("warc-refers-to"), *said))
            if out:
                types = (*[pa.string()] * 5, pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=[c.split(" ")[0] for c in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def read_pages(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), one row
    per record that ``write_archives`` wrote."""
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:(-?[0-9]*):[0-9]+>$", 1), F.lit("")).cast("long")
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_pages(http_records(read_archives(spark, path), payloads=False))
