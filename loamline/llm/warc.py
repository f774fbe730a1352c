"""A converter from the legacy ARC format to WARC, and readers and writers of both.

Archives are files in the shared folder, written by Spark's committing text
writer (gzip at its fastest level) and read as binary files. Each holds about ``ARCHIVE_BYTES`` of
records, or one longer record, so memory is bounded by that; rows go to Python in
batches of about as many bytes. (``read_warc`` is lazy: its batches are as the session has them.)

An ARC file begins with a version block, whose second line names the version and
whose third line names the fields of the header lines: five in version 1, ten in
version 2. A record is its header line, the declared number of bytes, and a line
feed. The converter checks the fields against the version, cuts records by
their declared length, and makes what WARC asks for: a record id from a hash of
URI, date and content, an ISO date from the 14 digits, the type, and SHA-1
digests of block and payload in base 32. The version block becomes a warcinfo
record.

Of records with equal payloads (digest and length) of at least ``least_bytes``
bytes the one with the smallest page id is a response, the others are revisits
that name it; smaller payloads are all responses. A null payload is empty. A null
id is ordered after all others; rows that share the smallest id are all responses.
White space and controls in URLs are percent-encoded; a null URL becomes
``urn:page``. Other columns are left out.

Archives from elsewhere may hold any bytes: bodies and headers are kept as they
are, whatever their encoding. URLs with spaces are read up to the last fields of the
header line. A record without an HTTP head becomes a resource, whose payload
is its whole block. HTTP lines without a colon give no field. Records without a page
id have null there and are all responses.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, heavy_lookup, light_batches, new_path, pieces, stored, table

ARCHIVE_BYTES = 8_000_000
FIELDS = {1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"], 2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"]}
DATE = "20240101000000"


def text_of(data: bytes) -> str:
    """Header bytes as text that gives the same bytes again."""
    return data.decode("utf-8", "surrogateescape")


def bytes_of(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


def shown(text: str) -> str:
    """The text for a column, which holds UTF-8 only."""
    return bytes_of(text).decode("utf-8", "replace")


def safe_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f-\xa0  ]", lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url) if url else "urn:page"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- ARC -------------------------------------------------------------------


def arc_file(records: list[tuple[str, str, bytes]], version: int = 1, name: str = "pages.arc") -> bytes:
    """records: URL, content type, content."""
    head = f"{version} 0 loamline\n{' '.join(FIELDS[version])}\n\n".encode()
    tail = {1: "text/plain", 2: "text/plain 200 - - 0 " + name}[version]
    out = [f"filedesc://{name} 0.0.0.0 {DATE} {tail} {len(head)}\n".encode(), head, b"\n"]
    size = sum(map(len, out))
    for url, kind, content in records:
        line = f"{url} 0.0.0.0 {DATE} {kind} " + (f"{len(content)}\n" if version == 1 else f"200 {sha1(content)} - {size} {name} {len(content)}\n")
        part = [line.encode(), content, b"\n"]
        size += sum(map(len, part))
        out += part
    return b"".join(out)


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of each record, the version block first."""
    at, fields = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"header line without end at byte {at}")
        if end == at:  # blank lines between records
            at += 1
            continue
        line = text_of(data[at:end]).rstrip("\r")
        values = line.rsplit(" ", len(fields) - 1) if fields else line.split(" ")
        names = fields or next((f for f in FIELDS.values() if len(f) == len(values)), None)
        if names is None or len(values) != len(names):
            raise ValueError(f"header line of {len(values)} fields at byte {at}")
        header = dict(zip(names, values, strict=True))
        length = int(header["Archive-length"])
        content = data[end + 1 : end + 1 + length]
        if len(content) != length:
            raise ValueError(f"record at byte {at} declares {length} bytes and has {len(content)}")
        if fields is None:
            if not header["URL"].startswith("filedesc:"):
                raise ValueError("no version block")
            lines = text_of(content).split("\n")
            version = int(lines[0].split(" ")[0])
            fields = lines[1].strip().split(" ")
            if fields != FIELDS.get(version):
                raise ValueError(f"version {version} with the fields {fields}")
        yield header, content
        at = end + 1 + length


# --- WARC ------------------------------------------------------------------


def warc_date(arc_date: str) -> str:
    d = arc_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, content: bytes) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(bytes_of(f'{url} {date} ') + content).digest()[:16], version=5)}>"


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes] | None:
    """Header fields (names in lower case), head and body of an HTTP message; None for other blocks."""
    if not block.startswith(b"HTTP/"):
        return None
    gap = re.search(rb"\r?\n\r?\n", block)
    end = gap.end() if gap else len(block)
    lines = [text_of(line).partition(":") for line in block[:end].splitlines()[1:]]
    return {name.strip().lower(): value.strip() for name, colon, value in lines if colon}, block[:end], block[end:]


def number(text: str | None) -> int | None:
    """An id of 64 bits, if the text is one."""
    return int(text) if text and re.fullmatch("-?[0-9]{1,19}", text) and -(2**63) <= int(text) < 2**63 else None


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items()), f"WARC-Block-Digest: sha1:{sha1(block)}", f"Content-Length: {len(block)}"]
    return bytes_of("\r\n".join(lines)) + b"\r\n\r\n" + block + b"\r\n\r\n"


def converted(header: dict[str, str], content: bytes, original: tuple[str, str, str] | None = None) -> bytes:
    """The WARC record of an ARC record; with original (record id, URL, page id), a revisit of that."""
    url, date = header["URL"], warc_date(header["Archive-date"])
    fields = {"WARC-Type": "warcinfo", "WARC-Record-ID": record_id(url, date, content), "WARC-Date": date}
    if url.startswith("filedesc:"):
        block = f"software: loamline\r\nformat: WARC File Format 1.1\r\nconverted-from: {url}\r\n".encode()
        return warc_record(fields | {"Content-Type": "application/warc-fields"}, block)
    http = split_http(content)
    if http is None:
        return warc_record(fields | {"WARC-Type": "resource", "WARC-Target-URI": url, "WARC-IP-Address": header["IP-address"], "Content-Type": header["Content-type"], "WARC-Payload-Digest": f"sha1:{sha1(content)}"}, content)
    _, head, body = http
    fields |= {"WARC-Type": "revisit" if original else "response", "WARC-Target-URI": url, "WARC-IP-Address": header["IP-address"], "Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": f"sha1:{sha1(body)}"}
    if original is None:
        return warc_record(fields, content)
    fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": original[0], "WARC-Refers-To-Target-URI": original[1], "X-Refers-To-Page-Id": original[2], "X-Payload-Length": str(len(body))}
    return warc_record(fields, head)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = text_of(data[at:end]).split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {name.strip(): value.strip() for name, colon, value in (line.partition(":") for line in lines[1:]) if colon}
        size = int(fields["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} isn't {size} bytes long")
        if fields.get("WARC-Block-Digest", "").startswith("sha1:") and fields["WARC-Block-Digest"] != f"sha1:{sha1(block)}":
            raise ValueError(f"digest of the record at byte {at}")
        yield fields, block
        at = end + 8 + size


# --- tables ----------------------------------------------------------------


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def _row(data: bytes, end: int) -> pa.RecordBatch:
    """The bytes without the last ``end`` as one text. They needn't be UTF-8: nothing on the way to a file looks at them, or copies them before Spark does."""
    offsets = np.array([0, len(data) - end], np.int32)
    return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])], names=["value"])


def _write(archives: DataFrame, path: str, end: str) -> None:
    """One file for each row of ``_row``, which ends with ``end``; the writer puts that back."""
    archives.write.option("maxRecordsPerFile", 1).option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def write_arc(pages: DataFrame, path: str, version: int = 1, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """pages (page_id, url, html) as ARC files of HTTP responses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def whole() -> pa.RecordBatch:
            return _row(arc_file(held, version), 1)

        for b in pieces(batches, archive_bytes, "html"):
            for page, url, html in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                body = (html or "").encode("utf-8")
                if held and size + len(body) > archive_bytes:
                    yield whole()
                    held, size = [], 0
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(body)}\r\nX-Page-Id: {'' if page is None else page}\r\n\r\n"
                held.append((safe_url(url), "text/html", head.encode() + body))
                size += len(body)
        if held:
            yield whole()

    with light_batches(pages.sparkSession, archive_bytes):
        _write(pages.select("page_id", "url", "html").mapInArrow(run, "value string"), path, "\n")


def arc_index(spark: SparkSession, path: str) -> DataFrame:
    """What deciding on revisits needs of each record: path, seq, url, id, page_id, digest and length."""
    schema = "path string, seq int, url binary, id string, page_id long, payload string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                for i, (h, content) in enumerate(arc_records(gzip.decompress(data.as_py()))):
                    http = split_http(content)
                    if http is not None and not h["URL"].startswith("filedesc:"):
                        f, _, body = http
                        rows.append((file, i, bytes_of(h["URL"]), record_id(h["URL"], warc_date(h["Archive-date"]), content), number(f.get("x-page-id")), f"{sha1(body)}:{len(body)}"))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.string()), strict=True)], names=["path", "seq", "url", "id", "page_id", "payload"])

    return _files(spark, path).mapInArrow(run, schema)


def revisits(index: DataFrame, least_bytes: int = 0) -> DataFrame:
    """path, seq and the original of every record that revisits one."""
    originals = index.groupBy("payload").agg(F.count("*").alias("n"), F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "id", "url"))).alias("original")).where((F.col("n") > 1) & F.col("original").isNotNull())
    joined = heavy_lookup(index.select("path", "seq", "page_id", "payload"), originals, "payload", "n")
    return joined.where(F.col("original").isNotNull() & (F.split("payload", ":")[1].cast("long") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("original.page_id"))).select("path", "seq", "original")


def arc_to_warc(spark: SparkSession, arc: str, warc: str, least_bytes: int = 0) -> None:
    """Converts the ARC files under arc to WARC files under warc, one for one."""
    # Stored, as deciding reads it several times and the archives are unpacked only once for that.
    with light_batches(spark, ARCHIVE_BYTES):
        index, kept = stored(arc_index(spark, arc), "index")
    # Of one file: no more entries than it has records.
    decided = revisits(index, least_bytes).groupBy("path").agg(F.collect_list(F.struct("seq", F.col("original.id").alias("id"), F.col("original.url").alias("url"), F.col("original.page_id").cast("string").alias("page"))).alias("originals"))
    work = _files(spark, arc).join(decided, "path", "left").select("content", "originals")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, originals in zip(b.column(0), b.column(1), strict=True):
                of = {o["seq"]: (o["id"], text_of(o["url"]), o["page"]) for o in originals.as_py() or ()}
                out = b"".join(converted(h, c, of.get(i)) for i, (h, c) in enumerate(arc_records(gzip.decompress(data.as_py()))))
                if out:
                    yield _row(out, 2)

    with light_batches(spark, ARCHIVE_BYTES):
        _write(work.mapInArrow(run, "value string"), warc, "\r\n")
    dropped(spark, kept)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_id and url of each response and revisit."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                rows = []
                for f, block in warc_records(gzip.decompress(data.as_py())):
                    if f["WARC-Type"] not in ("response", "revisit", "resource"):
                        continue
                    http, _, body = split_http(block) or ({}, b"", block)
                    again = f["WARC-Type"] == "revisit"
                    size = number(f.get("X-Payload-Length", http.get("content-length"))) if again else len(body)
                    digest = f.get("WARC-Payload-Digest", "")
                    if not again:
                        own = sha1(body)
                        if digest.startswith("sha1:") and digest != f"sha1:{own}":
                            raise ValueError(f"payload of {f['WARC-Record-ID']}")
                        digest = own
                    rows.append((number(http.get("x-page-id")), size, digest.removeprefix("sha1:"), f["WARC-Type"], number(f.get("X-Refers-To-Page-Id")), f["WARC-Record-ID"], shown(f["WARC-Target-URI"])))
                if rows:
                    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split(" ")[0] for x in schema.split(", ")])

    return _files(spark, path).select("content").mapInArrow(run, schema)


def through_archives(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, version: int = 1) -> DataFrame:
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc, version, archive_bytes)
    arc_to_warc(spark, arc, warc, least_bytes)
    return read_warc(spark, warc)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_archives(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
