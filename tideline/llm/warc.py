"""Legacy archives: writing ARC files, and converting them to WARC files.

An ARC file is a version block (``filedesc://`` record whose body names the
version and its header fields) followed by records, each a header line of
space-separated fields, the last one the declared length, then that many bytes
and a newline.  Version 1 lines have five fields, version 2 lines ten; the
reader takes the fields of the version that the file itself declares.  Every
record is a gzip member of its own.

Conversion (``convert``):

1. Every ARC file is read once for an index: place, payload digest (SHA-1 in
   base32) and payload length of its records.
2. Of records with equal digest and length (length at least ``min_bytes``) that
   with the largest page_id becomes a ``response``; the others ``revisit`` it.
   The largest is an aggregate with map-side partial sums joined back to the
   narrow index, so a digest that a third of all pages share is no hot group.
3. Every ARC file becomes one WARC file: the records are read again at their
   places and written with identifiers, dates, types and digests derived from
   what the ARC line says.

Files are written by tasks into the shared folder under a name of their own
attempt; the table of file names that Spark commits says which of them count,
so a repeated task leaves at most a file that no one reads.

A null html is an empty payload.  A null url is written as ``urn:none``.  A
null page_id is smaller than any.  Rows that share page_id and payload are
records of their own; one of them is the response.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import staged
from tideline.session import scratch_path

LEVEL = 2  # of gzip members
CHUNK = 1 << 20
FILE_BYTES = 64 << 20  # payload bytes after which a new ARC file is begun
FIRST_DATE = datetime(2000, 1, 1, tzinfo=timezone.utc)  # pages have no date: a second for each page_id
RECORD_BYTES = 512  # what a record counts besides its payload
MAX_SECONDS = 3_000_000_000

# The header fields of the two ARC versions.
FIELDS = {
    "1": ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    "2": ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
NO_ID = -(1 << 63)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def folder(spark, name: str) -> str:
    path = scratch_path(spark, name)
    return re.sub(r"^file:/+", "file:///", path)


class Writer:
    """A file of gzip members, one for each record."""

    def __init__(self, base: str, stem: str, kind: str):
        fs, path = _filesystem(base)
        fs.create_dir(path, recursive=True)
        self.name = f"{stem}-{uuid.uuid4().hex[:12]}.{kind}.gz"
        self.out = fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.at = self.records = self.payload = 0

    def member(self, *pieces: bytes) -> int:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        data = b"".join([*(packer.compress(p) for p in pieces), packer.flush()])
        self.out.write(data)
        start, self.at = self.at, self.at + len(data)
        self.records += 1
        return start

    def close(self) -> None:
        self.out.close()


def members(base: str, name: str) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of the gzip members of a file, one at a time."""
    fs, path = _filesystem(base)
    with fs.open_input_stream(f"{path}/{name}", compression=None) as f:
        at, begin, rest, packer, out = 0, 0, b"", zlib.decompressobj(31), []
        while True:
            data = rest or f.read(CHUNK)
            rest = b""
            if not data:
                if out:
                    raise ValueError(f"{name}: the record at {begin} is cut off")
                return
            out.append(packer.decompress(data))
            rest = packer.unused_data
            at += len(data) - len(rest)
            if packer.eof:
                yield begin, b"".join(out)
                begin, packer, out = at, zlib.decompressobj(31), []


# -- ARC -----------------------------------------------------------------


def arc_version(number: str, name: str) -> bytes:
    body = f"{number} 0 tideline\n{' '.join(FIELDS[number])}\n".encode()
    return arc_line(number, f"filedesc://{name}", "0.0.0.0", FIRST_DATE, "text/plain", "200", len(body)) + body + b"\n"


def arc_line(number: str, url: str, ip: str, date: datetime, kind: str, code: str, length: int) -> bytes:
    said = {"URL": url, "IP-address": ip, "Archive-date": date.strftime("%Y%m%d%H%M%S"), "Content-type": kind, "Result-code": code, "Archive-length": str(length)}
    return (" ".join(said.get(f, "-") for f in FIELDS[number]) + "\n").encode()


def parse_arc(data: bytes, fields: list[str]) -> tuple[dict[str, str], bytes]:
    """Header fields and declared bytes of a record."""
    line, _, body = data.partition(b"\n")
    values = line.decode("utf-8", "replace").split(" ")
    if len(values) != len(fields):
        raise ValueError(f"an ARC line of {len(values)} fields where the version has {len(fields)}")
    said = dict(zip(fields, values))
    length = int(said["Archive-length"])
    if len(body) < length:
        raise ValueError(f"an ARC record declares {length} bytes and has {len(body)}")
    return said, body[:length]


def arc_records(base: str, name: str) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, fields, body) of the records after the version block."""
    fields: list[str] | None = None
    for at, data in members(base, name):
        if fields is None:
            _, _, body = data.partition(b"\n")
            number, names = body.split(b"\n")[:2]
            fields = names.decode().split(" ")
            if fields != FIELDS.get(number.decode().split(" ")[0]):
                raise ValueError(f"{name}: unknown ARC version {number!r}")
            continue
        yield (at, *parse_arc(data, fields))


def page_date(page_id: int | None) -> datetime:
    return FIRST_DATE + timedelta(seconds=(page_id or 0) % MAX_SECONDS)


def _http(page_id: int | None, size: int) -> bytes:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{own}Content-Length: {size}\r\n\r\n".encode()


def split_http(body: bytes) -> tuple[bytes, int | None, bytes]:
    """HTTP header block, page_id it names, payload."""
    head, _, payload = body.partition(b"\r\n\r\n")
    found = re.search(rb"(?m)^X-Page-Id: (-?\d+)", head)
    return head, int(found[1]) if found else None, payload


def _arc_writer(base: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        number = str(1 + task % 2)  # both versions are written
        out, done = None, []
        for part in parts:
            for page, url, html in zip(part.column("page_id").to_pylist(), part.column("url").to_pylist(), part.column("html")):
                payload = (html.as_py() or "").encode("utf-8", "replace")
                if out is None:
                    out = Writer(base, f"{task:06d}", "arc")
                    out.member(arc_version(number, out.name))
                    out.records = 0
                head = _http(page, len(payload))
                line = arc_line(number, quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "urn:none", "0.0.0.0", page_date(page), "text/html", "200", len(head) + len(payload))
                out.member(line, head, payload, b"\n")
                out.payload += len(payload) + RECORD_BYTES
                if out.payload >= FILE_BYTES:
                    out.close()
                    done.append((out.name, out.records))
                    out = None
        if out is not None:
            out.close()
            done.append((out.name, out.records))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], names=["file", "records"])

    return run


def write_arc(pages: DataFrame, base: str) -> DataFrame:
    """Writes ``pages`` as ARC files under ``base``: (file, records)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return staged(pages.mapInArrow(_arc_writer(base), "file string, records long"), "arc-files")


# -- conversion ------------------------------------------------------------


def _indexer(base: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name in part.column("file").to_pylist():
                rows = []
                for at, said, body in arc_records(base, name):
                    _, page, payload = split_http(body)
                    sha = digest(payload)
                    rows.append((at, page, sha, len(payload), record_id(said, sha, page)))
                if rows:
                    places, pages, digests, sizes, ids = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(rows)), pa.array(places, pa.int64()), pa.array(pages, pa.int64()), pa.array(digests), pa.array(sizes, pa.int64()), pa.array(ids)],
                        names=["file", "place", "page_id", "digest", "size", "record"],
                    )

    return run


def record_id(said: dict[str, str], sha: str, page: int | None) -> str:
    """What the ARC line says, as a name-based UUID."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{said["URL"]} {said["Archive-date"]} {sha} {page}')}"


def warc_member(said: dict[str, str], body: bytes, refers: dict | None) -> tuple[bytes, bytes]:
    """Header block and content block of the WARC record of an ARC record."""
    head, page, payload = split_http(body)
    date = datetime.strptime(said["Archive-date"], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    sha = digest(payload)
    block = head + b"\r\n\r\n" + (b"" if refers else payload)
    kind = "dns" if said["URL"].startswith("dns:") else "http"
    lines = [
        "WARC/1.0",
        f"WARC-Type: {'revisit' if refers else 'response' if kind == 'http' else 'resource'}",
        f"WARC-Record-ID: <{record_id(said, sha, page)}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {said['URL']}",
        f"WARC-IP-Address: {said['IP-address']}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response" if kind == "http" else "Content-Type: text/dns",
    ]
    if refers:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers['record']}>"]
        if refers["page"] is not None:
            lines.append(f"X-Refers-To-Page: {refers['page']}")
        lines.append(f"X-Payload-Length: {len(payload)}")
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), block


def _converter(arcs: str, base: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                refers = {r["place"]: r["to"] for r in row["rows"]}
                out = Writer(base, row["file"].split("-")[0], "warc")
                info = f"software: tideline\r\nformat: WARC File Format 1.0\r\nisPartOf: {row['file']}\r\n".encode()
                head = ["WARC/1.0", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, row['file'])}>", f"WARC-Date: {FIRST_DATE:%Y-%m-%dT%H:%M:%SZ}", "Content-Type: application/warc-fields", f"Content-Length: {len(info)}"]
                out.member(("\r\n".join(head) + "\r\n\r\n").encode(), info, b"\r\n\r\n")
                for at, said, body in arc_records(arcs, row["file"]):
                    out.member(*warc_member(said, body, refers[at]), b"\r\n\r\n")
                out.close()
                yield pa.RecordBatch.from_arrays([pa.array([out.name]), pa.array([out.records - 1], pa.int64())], names=["file", "records"])

    return run


def convert(arc_files: DataFrame, arcs: str, base: str, min_bytes: int = 0) -> DataFrame:
    """Converts the ARC files under ``arcs`` to WARC files under ``base``:
    (file, records)."""
    spread = arc_files.select("file").repartition(arc_files.sparkSession.sparkContext.defaultParallelism, "file")
    index = staged(spread.mapInArrow(_indexer(arcs), "file string, place long, page_id long, digest string, size long, record string"), "arc-index")
    order = F.struct(F.coalesce("page_id", F.lit(NO_ID)).alias("id"), "file", "place", "record")
    first = index.filter(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.max(order).alias("first"))
    revisit = (F.col("first.file") != F.col("file")) | (F.col("first.place") != F.col("place"))
    page = F.when(F.col("first.id") != NO_ID, F.col("first.id"))
    to = F.when(revisit, F.struct(F.col("first.record").alias("record"), page.alias("page")))
    packed = index.join(first, ["digest", "size"], "left").groupBy("file").agg(F.collect_list(F.struct("place", to.alias("to"))).alias("rows"))
    # a few narrow rows stand for large files: a fixed number of tasks, which Spark does not merge by their bytes
    packed = packed.repartition(arc_files.sparkSession.sparkContext.defaultParallelism, "file")
    return staged(packed.mapInArrow(_converter(arcs, base), "file string, records long"), "warc-files")


# -- reading back ----------------------------------------------------------


def parse_warc(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    said = dict(x.split(": ", 1) for x in lines[1:])
    length = int(said["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a WARC record whose length is not the declared one")
    return said, rest[:length]


def _reader(base: str):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "warc_date", "target_uri"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name in part.column("file").to_pylist():
                rows = []
                for _, data in members(base, name):
                    said, block = parse_warc(data)
                    if said["WARC-Type"] == "warcinfo":
                        continue
                    _, page, payload = split_http(block)
                    sha = said["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = said["WARC-Type"] == "revisit"
                    if digest(block) != said["WARC-Block-Digest"].removeprefix("sha1:") or not revisit and digest(payload) != sha:
                        raise ValueError(f"{name}: a digest does not fit")
                    to = said.get("X-Refers-To-Page")
                    rows.append((page, int(said["X-Payload-Length"]) if revisit else len(payload), sha, said["WARC-Type"], None if to is None else int(to), said["WARC-Record-ID"], said["WARC-Date"], said["WARC-Target-URI"]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


WARC_ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, warc_date string, target_uri string"


def read_warc(warc_files: DataFrame, base: str) -> DataFrame:
    spread = warc_files.select("file").repartition(warc_files.sparkSession.sparkContext.defaultParallelism, "file")
    return spread.mapInArrow(_reader(base), WARC_ROWS)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` -> ARC files -> WARC files -> one row for every record."""
    spark = pages.sparkSession
    arcs, warcs = folder(spark, "arc"), folder(spark, "warc")
    return read_warc(convert(write_arc(pages, arcs), arcs, warcs, min_bytes), warcs)
