"""Legacy ARC archives to WARC archives (operator 6).

An ARC file starts with a version block that names its version and the fields
of the header lines that follow.  Every record is one header line, then as
many bytes as the line declares, then a line feed.  Version 1 lines have five
fields, version 2 lines ten; URLs may hold blanks, so lines are taken apart
from the right.  Lengths, not contents, say where records end.

For each ARC record the converter makes the WARC record that says the same:
the version block becomes ``warcinfo``, an HTTP exchange ``response``, and
anything else ``resource``.  The identifier is a name-based UUID (the same
input always gives the same identifier), the 14-digit date becomes
``WARC-Date``, and block and payload digests are added.  The payload of a
response is what follows the HTTP header.

Records with equal payloads of at least ``REVISIT_BYTES`` are written once:
the one with the least page id is the response, the others become ``revisit``
records that keep their HTTP header (with the full length), the digest and a
reference.  Only digests and ids are grouped, with minima combined before the
shuffle, so one payload may make up any share of the pages; payloads never
travel.  The list of revisits is broadcast while its count is at most
``BROADCAST_ROWS`` and joined by a shuffle above that.

Every record is a gzip member of its own, so a reader can enter an archive at
any record.  Members are gathered to archives of about ``FILE_BYTES`` compressed
bytes (whatever the number of records; one record may be longer), each of
which Spark's text writer puts into a file of its own, closed by an empty
member.  Archives are read back in parallel, decompressed and parsed as a
stream.

Defined cases: null html is an empty payload; null urls become ``urn:nil``;
pages that repeat an id with the payload of that id's response are responses
too; a page of any length is one record, held in memory by one task; columns
other than ``page_id``, ``url`` and ``html`` are not read; a page without an id is never the original of others, and its revisits
refer to pages with ids only; an empty table gives empty archives.
"""

from __future__ import annotations

import hashlib
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import saved
from fareflow.session import checkpoint_dir

REVISIT_BYTES = 100
FILE_BYTES = 32 << 20
BROADCAST_ROWS = 200_000
ARC_BYTES = 4 << 20
SEPARATOR = b"\r\n\r\n"

# Header fields of the two ARC versions and the length fields' names.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:arc-records")


@dataclass
class Record:
    """One archive record: its header fields and its block."""

    fields: dict[str, str]
    block: bytes
    version: int = 1
    extra: dict[str, str] = field(default_factory=dict)


# ---- ARC ------------------------------------------------------------------

def arc_header(version: int, url: str, ip: str, date: str, kind: str, length: int,
               status: int = 200, offset: int = 0, name: str = "-") -> bytes:
    url = quote(url, safe="".join(chr(c) for c in range(33, 127)))
    head = [url, ip, date, kind]
    if version == 2:
        head += [str(status), "-", "-", str(offset), name]
    return (" ".join(head + [str(length)]) + "\n").encode()


def arc_archive(version: int, name: str, records: list[tuple[str, str, bytes]]) -> bytes:
    """A whole archive of (url, 14-digit date, block) records."""
    about = f"{version} 0 converter\n{ARC_FIELDS[version]}\n\n".encode()
    parts = [arc_header(version, f"filedesc://{name}", "0.0.0.0", "20010101000000", "text/plain", len(about), name=name), about, b"\n"]
    size = sum(map(len, parts))
    for url, date, block in records:
        head = arc_header(version, url, "0.0.0.0", date, "text/html", len(block), offset=size, name=name)
        parts += [head, block, b"\n"]
        size += len(head) + len(block) + 1
    return b"".join(parts)


def parse_arc(data: bytes) -> Iterator[Record]:
    """Records of an archive; the version block is the first of them.

    Legacy archives are usually stored with every record compressed as a
    gzip member of its own; declared lengths then speak of the plain bytes.
    """
    if data[:2] == b"\x1f\x8b":
        data = b"".join(unzipped(data))
    at, version = 0, 0
    while at < len(data):
        if data[at:at + 1] == b"\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"header line at byte {at} does not end")
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        if not version:
            first = data[end + 1:end + 1 + 4].split(b" ")[0]
            if not line.startswith("filedesc:") or first not in (b"1", b"2"):
                raise ValueError("the archive has no version block")
            version = int(first)
        names = ARC_FIELDS[version].split()
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise ValueError(f"header line at byte {at} has {len(values)} fields")
        fields = dict(zip(names, values))
        size = int(fields["Archive-length"])
        block = data[end + 1:end + 1 + size]
        if len(block) != size:
            raise ValueError(f"record at byte {at} declares {size} bytes and has {len(block)}")
        yield Record(fields, block, version)
        at = end + 1 + size


# ---- WARC -----------------------------------------------------------------

def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its blank line) and payload."""
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


def http_field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode("utf-8", "replace")
    return None


def warc_date(date: str) -> str:
    """The 14-digit date; a shorter one means the first instant it names."""
    d = date + "00010101000000"[len(date):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, page: str | None) -> str:
    return f"<{uuid.uuid5(_NAMES, f'{page} {date} {url}').urn}>"


def to_warc(record: Record) -> Record:
    """Equivalent WARC record; ``extra`` holds what the writer may need."""
    f = record.fields
    url, date, block = f["URL"], f["Archive-date"], record.block
    head, payload, page = b"", block, None
    if url.startswith("filedesc:"):
        kind, media = "warcinfo", "application/warc-fields"
        block = f"software: ARC converter\r\nformat: WARC File Format 1.1\r\nsource: ARC/{record.version}\r\n".encode()
        payload = block
    elif block.startswith(b"HTTP/"):
        kind, media = "response", "application/http; msgtype=response"
        head, payload = split_http(block)
        page = http_field(head, b"x-page-id")
    else:
        kind, media = "resource", f["Content-type"]
    digest = hashlib.sha256(payload).hexdigest()
    fields = {"WARC-Type": kind, "WARC-Record-ID": record_id(url, date, page), "WARC-Date": warc_date(date)}
    if kind == "warcinfo":
        fields["WARC-Filename"] = url.removeprefix("filedesc://")
    else:
        fields |= {"WARC-Target-URI": url, "WARC-IP-Address": f["IP-address"], "WARC-Payload-Digest": f"sha256:{digest}"}
    fields |= {"WARC-Block-Digest": f"sha256:{digest if not head else hashlib.sha256(block).hexdigest()}", "Content-Type": media}
    return Record(fields, block, record.version, {"head": head, "digest": digest, "size": str(len(payload)), "page": page})


def to_revisit(warc: Record, original: int | str, original_id: str) -> Record:
    """The same record without its payload, referring to another record and its page."""
    head = warc.extra["head"]
    fields = dict(warc.fields)
    fields |= {"WARC-Type": "revisit", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
               "WARC-Refers-To": original_id, "WARC-Refers-To-Page": str(original), "WARC-Block-Digest": f"sha256:{hashlib.sha256(head).hexdigest()}"}
    return Record(fields, head, warc.version, warc.extra)


def warc_bytes(warc: Record) -> bytes:
    """The record without the separator that ends it."""
    lines = ["WARC/1.1"] + [f"{k}: {v}" for k, v in warc.fields.items()] + [f"Content-Length: {len(warc.block)}", "", ""]
    return "\r\n".join(lines).encode() + warc.block


def parse_warc(chunks: Iterator[bytes]) -> Iterator[Record]:
    """Records of an archive that arrives in pieces, by declared lengths."""
    held = b""

    def more(need: int) -> bool:
        nonlocal held
        parts, size = [held], len(held)
        while size < need:
            piece = next(chunks, None)
            if piece is None:
                held = b"".join(parts)
                return False
            parts.append(piece)
            size += len(piece)
        held = b"".join(parts)
        return True

    while True:
        end = held.find(b"\r\n\r\n")
        while end < 0:
            if not more(len(held) + 1):
                if held.strip(b"\r\n"):
                    raise ValueError("the archive ends inside a header")
                return
            end = held.find(b"\r\n\r\n")
        lines = held[:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record does not start with its version")
        fields = {k: v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields["Content-Length"])
        if not more(end + 4 + size):
            raise ValueError("the archive ends inside a record")
        yield Record(fields, held[end + 4:end + 4 + size])
        more(end + 8 + size)
        held = held[end + 8 + size:]


def member(data: bytes) -> bytes:
    """A gzip member; the same data always give the same bytes."""
    z = zlib.compressobj(wbits=31)
    return z.compress(data) + z.flush()


def unzipped(data: bytes, piece: int = 1 << 14) -> Iterator[bytes]:
    """Contents of a gzip file of one or more members, piece by piece.

    Pieces are short because what follows a member in its last piece is
    handed back and read again.
    """
    view, at = memoryview(data), 0
    while at < len(view):
        z = zlib.decompressobj(31)
        while not z.eof:
            if at >= len(view):
                raise ValueError("the compressed archive is cut short")
            fed = view[at:at + piece]
            got = z.decompress(fed)
            at += len(fed) - len(z.unused_data)
            if got:
                yield got


# ---- Spark ----------------------------------------------------------------

def page_archives(pages: DataFrame) -> DataFrame:
    """``(content)``: ARC archives of pages (page_id, url, html), a few megabytes each.

    Even and odd ids go to archives of version 1 and 2.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("urn:nil")).alias("url"),
                          F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))

    def block(page: int | None, html: str) -> bytes:
        body = html.encode("utf-8")
        about = "" if page is None else f"X-Page-Id: {page}\r\n"
        return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{about}Content-Length: {len(body)}\r\n\r\n".encode() + body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {1: [], 2: []}, {1: 0, 2: 0}

        def archive(version: int) -> pa.RecordBatch:
            data = arc_archive(version, f"pages-{uuid.uuid5(_NAMES, str(held[version][0][:2]))}.arc", held[version])
            held[version], size[version] = [], 0
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["content"])

        for batch in batches:
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                version = 1 + (page or 0) % 2
                date = time.strftime("%Y%m%d%H%M%S", time.gmtime(978_307_200 + (page or 0) % 500_000_000))
                held[version].append((url, date, block(page, html)))
                size[version] += len(held[version][-1][2])
                if size[version] >= ARC_BYTES:
                    yield archive(version)
        for version in (1, 2):
            if held[version]:
                yield archive(version)

    return source.mapInArrow(run, "content binary")


def read_archives(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``(content)``: the files of a folder, whole."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("content")


def payloads(archives: DataFrame) -> DataFrame:
    """``(page_id, digest, size, record_id)`` of the payload of every HTTP exchange."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content").to_pylist():
                rows = []
                for w in map(to_warc, parse_arc(data)):
                    if w.fields["WARC-Type"] == "response":
                        page = w.extra["page"]
                        rows.append((int(page) if page else None, w.extra["digest"], int(w.extra["size"]), w.fields["WARC-Record-ID"]))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.string()))],
                        names=["page_id", "digest", "size", "record_id"])

    return archives.mapInArrow(run, "page_id long, digest string, size long, record_id string")


def converted(archives: DataFrame) -> DataFrame:
    """``(page_id, digest, record, revisit)`` of every ARC record.

    ``record`` are the bytes of the full WARC record; ``revisit`` those of the
    revisit record that could stand for it, with ``@`` where the original's
    record id and page id go, or null.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content").to_pylist():
                rows = []
                for arc in parse_arc(data):
                    w = to_warc(arc)
                    again = None
                    if w.fields["WARC-Type"] == "response":
                        again = warc_bytes(to_revisit(w, "@", "@"))
                    page = w.extra["page"]
                    rows.append((int(page) if page else None, w.extra["digest"], warc_bytes(w), again))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.binary(), pa.binary()))],
                    names=["page_id", "digest", "record", "revisit"])

    return archives.mapInArrow(run, "page_id long, digest string, record binary, revisit binary")


def gathered(records: DataFrame, size: int) -> DataFrame:
    """``(archive)``: the ``record`` rows as gzip members, joined to about ``size`` bytes a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])

        for batch in batches:
            for record in batch.column("record"):
                held.append(member(record.as_py() + SEPARATOR))
                total += len(held[-1])
                if total >= size:
                    yield archive()
                    held, total = [], 0
        if held:
            yield archive()

    return records.mapInArrow(run, "archive binary")


def convert(archives: DataFrame, path: str) -> None:
    """Write the WARC archives that say what the ARC ``archives`` say."""
    rows = converted(archives)
    keys = saved(payloads(archives), "digests").where(F.col("size") >= REVISIT_BYTES)
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "record_id")))
    first = keys.groupBy("digest").agg(least.alias("least"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 and least is not null").select("digest", F.col("least.page_id").alias("original"), F.col("least.record_id").alias("original_id"))
    later = saved(keys.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("original"))).select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "original", "original_id").distinct(), "revisits")
    if later.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        later = F.broadcast(later)
    marked = rows.join(later, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
                       & F.col("revisit").isNotNull(), "left")
    refers = F.concat(F.lit("\r\nWARC-Refers-To: "), F.col("original_id"),
                      F.lit("\r\nWARC-Refers-To-Page: "), F.col("original").cast("string"), F.lit("\r\n"))
    record = F.when(F.col("original").isNull(), F.col("record")).otherwise(
        F.replace(F.col("revisit").cast("string"), F.lit("\r\nWARC-Refers-To: @\r\nWARC-Refers-To-Page: @\r\n"), refers).cast("binary"))
    # The text writer puts down the bytes it is given; its "line end" is the closing member.
    gathered(marked.select(record.alias("record")), FILE_BYTES).select(F.col("archive").cast("string").alias("value")).write.option(
        "lineSep", member(b"").decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Page records of WARC archives.

    ``(page_id, target_uri, date, record_id, record_type, payload_bytes,
    payload_digest, refers_to, refers_to_record, payload)``; digest and length are those of the
    full payload, taken from the payload itself where the record has it, else
    from the headers.  A payload that does not fit its declared digest raises.
    """
    schema = ("page_id long, target_uri string, date string, record_id string, record_type string, "
              "payload_bytes long, payload_digest string, refers_to long, refers_to_record string, payload binary")
    names = [x.split()[0] for x in schema.split(", ")]

    def row(r: Record) -> tuple:
        f = r.fields
        head, payload = split_http(r.block) if r.block.startswith(b"HTTP/") else (b"", r.block)
        page = http_field(head, b"x-page-id")
        declared = f["WARC-Payload-Digest"].removeprefix("sha256:")
        if f["WARC-Type"] == "revisit":
            size, payload = int(http_field(head, b"content-length") or 0), None
        else:
            size = len(payload)
            if hashlib.sha256(payload).hexdigest() != declared:
                raise ValueError(f"payload of {f['WARC-Record-ID']} does not fit its digest")
        return (int(page) if page else None, f["WARC-Target-URI"], f["WARC-Date"], f["WARC-Record-ID"], f["WARC-Type"], size,
                declared, int(f["WARC-Refers-To-Page"]) if "WARC-Refers-To-Page" in f else None,
                f.get("WARC-Refers-To"), payload)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content").to_pylist():
                rows, size = [], 0
                for r in parse_warc(unzipped(data)):
                    if r.fields["WARC-Type"] == "warcinfo":
                        continue
                    rows.append(row(r))
                    size += len(r.block)
                    if size >= ARC_BYTES:
                        yield table(rows)
                        rows, size = [], 0
                if rows:
                    yield table(rows)

    return read_archives(spark, path, "part-*").mapInArrow(run, schema)


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm/{uuid.uuid4().hex}/warc"
