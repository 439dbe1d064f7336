"""Legacy ARC archives converted to WARC, written per task and read back.

``read_arc`` follows the version block of each archive: version 1 has five fields
in a header line, version 2 has ten, the last is always the declared length, and
lines are parsed from the right so that a URL may hold spaces.  ``to_warc`` makes
the record a WARC archive would have: a name-based UUID, an ISO time from the
14-digit date, a type from the content and SHA-1 digests in base32.  Records with
equal payloads are written once and revisited by the others.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize, shared_path

#: Field names of a header line by version (fixed by the format).
FIELDS = {
    1: ["url", "ip", "date", "type", "length"],
    2: ["url", "ip", "date", "type", "code", "checksum", "location", "offset", "filename", "length"],
}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES, CHUNK_ROWS, DATE = 32 << 20, 500, "20240101000000"
#: Bytes that the decompressor gets at once; what is left of them behind a member is copied.
FEED = 1 << 14
_PAGE, _REFERS = "X-Page-Id", "X-Refers-To-Page-Id"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass
class ArcRecord:
    header: dict[str, str]
    content: bytes


def write_arc(records: Iterable[tuple[str, str, bytes]], version: int, filename: str = "pages.arc", date: str = DATE) -> bytes:
    """An ARC archive of (url, media type, content) records; the layout of one version."""
    names = "URL IP-address Archive-date Content-type Archive-length" if version == 1 else "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
    block = f"{version} 0 tracewright\n{names}\n".encode()
    out, at = [], 0

    def put(url: str, kind: str, content: bytes) -> None:
        nonlocal at
        url = url.replace(" ", "%20").replace("\n", "%0A").replace("\r", "%0D")
        more = f"200 - - {at} {filename} " if version == 2 else ""
        part = f"{url} 0.0.0.0 {date} {kind} {more}{len(content)}\n".encode() + content + b"\n"
        at += len(part)
        out.append(part)

    put(f"filedesc://{filename}", "text/plain", block)
    for url, kind, content in records:
        put(url, kind, content)
    return b"".join(out)


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """All records, the version block first; the version sets how header lines are read."""
    at, version = 0, 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        if not version:
            length = int(line.rsplit(" ", 1)[1])
            version = int(data[end + 1 : end + 1 + length].split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version}")
            names = FIELDS[1] if len(line.split(" ")) == 5 else FIELDS[version]
        else:
            names = FIELDS[version]
        parts = line.rsplit(" ", len(names) - 1)
        if len(parts) != len(names):
            raise ValueError(f"ARC header of version {version} has {len(parts)} fields at byte {at}")
        header = dict(zip(names, parts, strict=True))
        length = int(header["length"])
        if end + 1 + length > len(data):
            raise ValueError(f"declared length {length} exceeds the archive at byte {at}")
        yield ArcRecord(header, data[end + 1 : end + 1 + length])
        at = end + 1 + length


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes = b""
    fields: dict[str, str] = field(default_factory=dict)

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2] if self.headers.get("Content-Type", "").startswith("application/http") else self.block

    def encode(self) -> bytes:
        head = "".join(f"{k}: {v}\r\n" for k, v in (self.headers | {"Content-Length": str(len(self.block))}).items())
        return f"WARC/1.1\r\n{head}\r\n".encode() + self.block + b"\r\n\r\n"


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def page_record_id(page_id: int) -> str:
    return record_id(f"page:{page_id}")


def iso_date(date: str) -> str:
    """ISO 8601 of an archive date; dates of fewer digits are filled up to their first moment."""
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def http_fields(block: bytes) -> dict[str, str]:
    lines = block.partition(b"\r\n\r\n")[0].decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def to_warc(record: ArcRecord) -> WarcRecord:
    """The WARC record equivalent to an ARC record."""
    h, body = record.header, record.content
    headers = {"WARC-Date": iso_date(h["date"])}
    if h["url"].startswith("filedesc:"):
        fields = f"software: tracewright\r\nformat: WARC File Format 1.1\r\nconverted-from: {h['url']}\r\n".encode()
        headers |= {"WARC-Type": "warcinfo", "WARC-Record-ID": record_id(f"{h['url']} {h['date']}"), "Content-Type": "application/warc-fields"}
        return WarcRecord(headers, fields)
    http = body.startswith(b"HTTP/")
    payload = body.partition(b"\r\n\r\n")[2] if http else body
    digest = base32_sha1(payload)
    page = http_fields(body).get(_PAGE.lower()) if http else None
    headers |= {
        "WARC-Type": "response" if http else "resource",
        "WARC-Record-ID": page_record_id(int(page)) if page else record_id(f"{h['date']} {h['url']} {digest}"),
        "WARC-Target-URI": h["url"],
        "WARC-IP-Address": h["ip"],
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(body)}",
        "Content-Type": "application/http;msgtype=response" if http else h["type"],
    }
    return WarcRecord(headers, body)


def to_revisit(record: WarcRecord, page_id: int) -> WarcRecord:
    """The record without its payload, pointing at that of the page that has it."""
    head = record.block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
    more = {"WARC-Type": "revisit", "WARC-Profile": IDENTICAL, "WARC-Refers-To": page_record_id(page_id), _REFERS: str(page_id), "WARC-Block-Digest": f"sha1:{base32_sha1(head)}"}
    return WarcRecord(record.headers | more, head)


def referred_page(headers: dict[str, str]) -> int | None:
    """The page that a revisit refers to, if its record has the name that the revisit states."""
    page = headers.get(_REFERS)
    return int(page) if page and page_record_id(int(page)) == headers.get("WARC-Refers-To") else None


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of an archive, one by one, in time linear in its length."""
    view, at = memoryview(data), 0
    while at < len(view):
        d, out = zlib.decompressobj(31), []
        while not d.eof and at < len(view):
            part = view[at : at + FEED]
            out.append(d.decompress(part))
            at += len(part) - len(d.unused_data)
        if not d.eof:
            raise ValueError("the archive ends inside a member")
        yield b"".join(out)


def read_warc(data: bytes) -> Iterator[WarcRecord]:
    """Records of an archive of gzip members, or of one that is not compressed."""
    if data[:2] == b"\x1f\x8b":
        for x in members(data):
            yield from read_warc(x)
        return
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k: v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(headers["Content-Length"])
        yield WarcRecord(headers, data[end + 4 : end + 4 + length])
        at = end + 4 + length + 4


def member(record: WarcRecord, level: int = 3) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record.encode()) + z.flush()


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with refers_to: the largest page_id with an equal payload, null for that one and below ``min_bytes``.

    Only ids and digests meet by digest; payloads travel once, to the roles of the
    rows that revisit.  A digest of very many pages is looked up in a table of
    bounded size instead of gathering its rows.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("html")).withColumn("sha", F.sha1("html"))
    ids = materialize(rows.filter(F.octet_length("html") >= min_bytes).groupBy("page_id", "sha").count(), "digests")
    first = ids.groupBy("sha").agg(F.max("page_id").alias("first"), F.sum("count").alias("n")).filter("n > 1 and first is not null")
    role = join_hot(ids, first, "sha").filter("page_id is null or first <> page_id").select(F.col("page_id").alias("_page"), F.col("sha").alias("_sha"), F.col("first").alias("refers_to"))
    return rows.join(role, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("sha") == F.col("_sha")), "left").select("page_id", "url", "html", "refers_to")


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Convert rows with refers_to through ARC to WARC archives in ``folder``; returns (path, records).

    Files get their final name by a rename when complete.  The name and the bytes
    depend on the partition alone, so a task that runs again leaves the files that
    it finds and makes the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        out, size, number, made = [], 0, 0, []

        def close() -> None:
            nonlocal out, size, number
            if out:
                final = posixpath.join(root, f"part-{part:06d}-{number:04d}.warc.gz")
                temp = posixpath.join(root, f"_part-{part:06d}-{number:04d}.{attempt}")
                store.create_dir(root, recursive=True)
                with store.open_output_stream(temp, compression=None) as f:
                    f.write(b"".join(out))
                if store.get_file_info(final).type == fs.FileType.NotFound:
                    store.move(temp, final)
                else:  # an earlier run of this task has made it
                    store.delete_file(temp)
                made.append((final, len(out)))
                out, size, number = [], 0, number + 1

        for b in batches:
            for lo in range(0, len(b), CHUNK_ROWS):
                rows = b.slice(lo, CHUNK_ROWS).to_pylist()
                content = []
                for r in rows:
                    page = f"{_PAGE}: {r['page_id']}\r\n" if r["page_id"] is not None else ""
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{page}Content-Length: {len(r['html'])}\r\n\r\n"
                    content.append((r["url"] or f"urn:page:{r['page_id']}", "text/html", head.encode() + r["html"]))
                arc = write_arc(content, version=1 + part % 2, filename=f"part-{part}-{lo}.arc")
                for i, old in enumerate(read_arc(arc)):
                    new = to_warc(old)
                    if i and rows[i - 1]["refers_to"] is not None:
                        new = to_revisit(new, rows[i - 1]["refers_to"])
                    if i or not out:
                        out.append(member(new))
                        size += len(new.block)
                    if size >= file_bytes:
                        close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in made], pa.string()), pa.array([n for _, n in made], pa.int64())], ["path", "records"])

    return rows.sortWithinPartitions("page_id", "url", "html").mapInArrow(run, "path string, records long")


def read_archives(spark, folder: str) -> DataFrame:
    """One row per response, resource or revisit record of the archives in ``folder``."""
    kind = "record_id string, record_type string, page_id long, url string, date string, payload_bytes long, payload_digest string, refers_to_id string, refers_to long, digest_ok boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                rows = []
                for r in read_warc(data.as_py()):
                    h = r.headers
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    got = http_fields(r.block) if h["Content-Type"].startswith("application/http") else {}
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    whole = h["WARC-Type"] != "revisit"
                    size = len(r.payload) if whole else int(got["content-length"])
                    page = got.get(_PAGE.lower())
                    rows.append((h["WARC-Record-ID"], h["WARC-Type"], int(page) if page else None, h["WARC-Target-URI"], h["WARC-Date"], size, digest, h.get("WARC-Refers-To"), None if whole else referred_page(h), base32_sha1(r.payload) == digest if whole else None))
                if rows:
                    names = [x.split()[0] for x in kind.split(", ")]
                    types = [{"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[x.split()[1]] for x in kind.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("content").mapInArrow(run, kind)


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write one WARC record per row of ``pages`` and return what the archives hold.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to, url.
    A null html is an empty payload; a null url gets a name from the page_id; rows
    that repeat a page_id with the same payload get the same role; a row with a
    null page_id revisits a row that has one, else it is a response.  An empty
    table gives no row.
    """
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    made = write_archives(roles(pages, min_bytes), folder).agg(F.sum("records").alias("n")).first()["n"]
    if not made:
        kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
        return spark.createDataFrame([], kind)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
