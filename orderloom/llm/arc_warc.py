"""Legacy ARC archives converted to WARC, with revisit records for repeated payloads.

An ARC file starts with a version block that names its version and the fields of its header lines;
each record is one header line, which ends in the declared length, and that many bytes. `convert`
reads the archives twice. The first pass takes each record's payload digest and length; equal
payloads of at least `least_bytes` bytes are grouped in Spark (small rows, combined on the map
side), and of a group the record with the largest id stays a response. The second pass streams each
archive again beside its own sorted list of revisits and writes the WARC file: payloads pass through
one task at a time, a record at a time, and are never shuffled.

What ARC lacks is synthesised: the record id from the archive's name and the record's number, the
date from the 14 (or 12) digits of the header line, the type from the body, digests from the bytes.

Files are named by attempt and count only if they are in the written manifest. Archives are gzip
files of one member per record.

Edge cases: a NULL or empty page is a record with an empty payload; a NULL URL is written as `-`,
and characters a header line cannot hold are percent-encoded. A NULL id ranks below all others and
is left out of the record. A header line whose address and date (12 or 14 digits) are not where its
version has them raises; parameters of a content type and spaces in a URL are read as part of them. Rows of one group that share the largest id are all responses (no ids:
all are). Empty tables give no files. A record that is cut short, or whose payload does not match
its digest, raises. Other columns are never looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import open_store, staged
from orderloom.operators.dedup import unused
from orderloom.session import new_folder

LEAST_BYTES = 1000
ID_HEADER = "X-Page-Id"
# The header line's fields by version, where the version block names none.
FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename"
    " Archive-length",
}
# What a field may hold; in any other (URL, type, location) old writers left spaces. The address and the
# digits of the date tell where the URL ends.
SHAPES = {
    "ip-address": r"\d{1,3}(?:\.\d{1,3}){3}|[0-9A-Fa-f.:]*:[0-9A-Fa-f.:]*",
    "archive-date": r"\d{12}(?:\d\d)?",
    "result-code": r"\d{3}|-",
    "checksum": r"\S+",
    "offset": r"\d+|-",
    "filename": r"\S+",
    "archive-length": r"\d+",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
URL_SAFE = "".join(chr(c) for c in range(33, 127))

ARCHIVES = "folder string, name string"
SCANNED = "name string, number long, page_id long, payload_bytes long, digest string"
READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string,"
    " record_id string, refers_id string, date string, url string"
)
_KINDS = {"long": pa.int64(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(part.split() for part in schema.split(",")))
    columns = list(zip(*rows)) if rows else [()] * len(names)
    arrays = [pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# ---- ARC ----------------------------------------------------------------------------------------


def version_block(name: str, version: str, date: str) -> bytes:
    block = f"{version} 0 orderloom\n{FIELDS[version]}\n".encode()
    middle = "text/plain" if version == "1" else f"text/plain 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {date} {middle} {len(block)}\n".encode() + block


def arc_record(
    page_id: int | None, url: str | None, html: str | None, name: str, version: str, date: str
) -> bytes:
    payload = (html or "").encode()
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    lines += [] if page_id is None else [f"{ID_HEADER}: {page_id}"]
    lines += [f"Content-Length: {len(payload)}", "", ""]
    body = "\r\n".join(lines).encode() + payload
    more = "" if version == "1" else f" 200 - - 0 {name}"
    address = quote(url or "-", safe=URL_SAFE)
    line = f"\n{address} 0.0.0.0 {date} text/html{more} {len(body)}\n"
    return line.encode() + body


def write_arc(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "20000101000000",
) -> DataFrame:
    """One archive per partition, versions 1 and 2 in turn; returns the manifest."""
    folder = new_folder(pages.sparkSession, "arc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, version = f"{part:07d}-{uuid.uuid4().hex}.arc.gz", "12"[part % 2]
        out = None
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                for page, url, html in zip(
                    *(c.to_pylist() for c in batch.slice(low, 64).columns), strict=True
                ):
                    if out is None:
                        store, root = open_store(folder)
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                        out.write(_member(version_block(name, version, date)))
                    out.write(_member(arc_record(page, url, html, name, version, date)))
        if out is not None:
            out.close()
            yield _batch([(folder, name)], ARCHIVES)

    own = pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(html_col))
    return staged(own.mapInArrow(write, ARCHIVES), "arc-manifest")


def _exactly(f: BinaryIO, n: int) -> bytes:
    data = f.read(n)
    if len(data) != n:
        raise ValueError("record cut short")
    return data


def arc_records(f: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, body) of each record, by the fields and lengths the archive declares."""
    first = f.readline().decode("utf-8", "replace").rstrip("\r\n")
    if not first:
        return
    if not first.startswith("filedesc:"):
        raise ValueError("no version block")
    block = _exactly(f, int(first.rsplit(" ", 1)[1])).decode("utf-8", "replace").split("\n")
    version = block[0].split(" ")[0]
    named = block[1].strip() if len(block) > 1 and block[1].startswith("URL ") else FIELDS[version]
    names = [n.lower() for n in named.split(" ")]
    header = re.compile(" ".join(f"({SHAPES.get(n, '.*?')})" for n in names))
    while True:
        line = f.readline()
        if not line:
            return
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text:
            values = header.fullmatch(text)
            if values is None:
                raise ValueError(f"bad header line: {text[:200]}")
            fields = dict(zip(names, values.groups()))
            yield fields, _exactly(f, int(fields["archive-length"]))


def http_parts(body: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """The HTTP header block, the payload and the header fields; no header: all is payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body, {}
    end = re.search(rb"\r?\n\r?\n", body)
    at = end.end() if end else len(body)
    head = body[:at]
    pairs = (line.split(":", 1) for line in head.decode("latin-1").splitlines()[1:] if ":" in line)
    return head, body[at:], {k.strip().lower(): v.strip() for k, v in pairs}


def warc_date(digits: str) -> str:
    """14 digits, or fewer from the left, as a WARC date; no date of the calendar: the epoch."""
    if not re.fullmatch(r"[0-9]{4,14}", digits) or len(digits) % 2:
        return EPOCH
    d = digits + "00000101000000"[len(digits) :]
    try:
        moment = datetime.strptime(d, "%Y%m%d%H%M%S")
    except ValueError:
        return EPOCH
    return f"{moment.isoformat()}Z"


def record_id(name: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{number}')}>"


def _page_id(headers: dict[str, str]) -> int | None:
    value = headers.get(ID_HEADER.lower(), "")
    return int(value) if re.fullmatch(r"-?\d+", value) else None


def _open(folder: str, name: str) -> BinaryIO:
    store, root = open_store(folder)
    raw = store.open_input_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18)


def scan(archives: DataFrame) -> DataFrame:
    """A small row per record: where it is, its id, its payload's length and SHA-1."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.to_pylist():
                rows, name = [], archive["name"]
                with _open(archive["folder"], name) as f:
                    for number, (_, body) in enumerate(arc_records(f)):
                        head, payload, headers = http_parts(body)
                        digest = hashlib.sha1(payload).hexdigest() if head else None
                        rows.append((name, number, _page_id(headers), len(payload), digest))
                        if len(rows) == 1024:
                            yield _batch(rows, SCANNED)
                            rows = []
                yield _batch(rows, SCANNED)

    return archives.mapInArrow(read, SCANNED)


# ---- WARC ---------------------------------------------------------------------------------------


def _warc(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return _member("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(
    name: str, number: int, fields: dict[str, str], body: bytes, refers_to: str | None
) -> bytes:
    head, payload, _ = http_parts(body)
    kind = "resource" if not head else "response" if refers_to is None else "revisit"
    block = head if kind == "revisit" else body
    content = fields.get("content-type", "application/octet-stream")
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(name, number)),
        ("WARC-Date", warc_date(fields.get("archive-date", ""))),
        ("WARC-Target-URI", quote(fields["url"], safe=URL_SAFE)),
        ("WARC-IP-Address", fields.get("ip-address", "0.0.0.0")),
        ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Block-Digest", _sha1(block)),
        ("Content-Type", "application/http;msgtype=response" if head else content),
    ]
    if refers_to is not None and head:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", refers_to)]
    return _warc(headers, block)


def _one_file_per_task(archives: DataFrame) -> DataFrame:
    return archives.repartitionByRange(max(1, archives.count()), "name")


def convert(archives: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write a WARC file per archive; returns their manifest."""
    out_folder = new_folder(archives.sparkSession, "warc")
    records = staged(scan(_one_file_per_task(archives)), "arc-records")
    large = records.where((F.col("payload_bytes") >= least_bytes) & F.col("digest").isNotNull())
    place = F.struct("page_id", "name", "number")
    groups = (
        large.groupBy("digest", "payload_bytes")
        .agg(F.max(place).alias("top"), F.count("*").alias("n"))
        .where("n > 1 AND top.page_id IS NOT NULL")
    )
    revisits = large.join(groups, ["digest", "payload_bytes"]).where(
        "page_id IS NULL OR page_id < top.page_id"
    )
    # An archive's revisits are at most its records: one row per archive, read beside it.
    refers = F.struct("number", F.col("top.name").alias("to_name"), F.col("top.number").alias("to"))
    lists = revisits.groupBy("name").agg(F.sort_array(F.collect_list(refers)).alias("revisits"))
    work = archives.join(lists, "name", "left").select("folder", "name", "revisits")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.to_pylist():
                name = archive["name"]
                refers = {r["number"]: (r["to_name"], r["to"]) for r in archive["revisits"] or []}
                target = f"{name.removesuffix('.arc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz"
                store, root = open_store(out_folder)
                store.create_dir(root, recursive=True)
                with (
                    store.open_output_stream(f"{root}/{target}", compression=None) as out,
                    _open(archive["folder"], name) as f,
                ):
                    info = f"software: orderloom\r\nisPartOf: {name}\r\n".encode()
                    about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, -1))]
                    about += [("WARC-Date", EPOCH), ("WARC-Filename", target)]
                    out.write(_warc([*about, ("Content-Type", "application/warc-fields")], info))
                    for number, (fields, body) in enumerate(arc_records(f)):
                        to = refers.get(number)
                        refer = None if to is None else record_id(*to)
                        out.write(warc_record(name, number, fields, body, refer))
                yield _batch([(out_folder, target)], ARCHIVES)

    return staged(_one_file_per_task(work).mapInArrow(write, ARCHIVES), "warc-manifest")


def warc_records(f: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    while True:
        line = f.readline()
        if not line:
            return
        if line.strip() != b"WARC/1.1":
            raise ValueError("not a WARC record")
        headers = {}
        while (line := f.readline().rstrip(b"\r\n")) != b"":
            key, _, value = line.decode().partition(":")
            headers[key.lower()] = value.strip()
        block = _exactly(f, int(headers["content-length"]))
        if _exactly(f, 4) != b"\r\n\r\n":
            raise ValueError("record cut short")
        yield headers, block


def read_warc(archives: DataFrame) -> DataFrame:
    """The columns of READ for every record but warcinfo, digests checked.

    A revisit does not hold its payload: `payload_bytes` is NULL (`with_referred` finds it).
    """

    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind = headers["warc-type"]
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        _, payload, http = http_parts(block)
        size = None if kind == "revisit" else len(payload)
        if kind != "revisit" and _sha1(payload) != f"sha1:{digest}":
            raise ValueError("payload does not match its digest")
        return (
            _page_id(http),
            size,
            base64.b32decode(digest).hex(),
            kind,
            headers["warc-record-id"],
            headers.get("warc-refers-to"),
            headers["warc-date"],
            headers["warc-target-uri"],
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.to_pylist():
                rows = []
                with _open(archive["folder"], archive["name"]) as f:
                    for headers, block in warc_records(f):
                        if headers["warc-type"] != "warcinfo":
                            rows.append(row(headers, block))
                        if len(rows) == 1024:
                            yield _batch(rows, READ)
                            rows = []
                yield _batch(rows, READ)

    return _one_file_per_task(archives).mapInArrow(read, READ)


def with_referred(records: DataFrame) -> DataFrame:
    """Adds `refers_to`, the page id of the response that a revisit names, and takes its payload's length.

    Both are NULL if the archives do not hold that response.
    """
    records = staged(records, "warc-records")
    size = unused("_size", records.columns)
    revisits = records.where("refers_id IS NOT NULL")
    ids = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias(size),
    )
    # Few responses are referred to by many: only those take part in the join.
    named = ids.join(revisits.select("refers_id").distinct(), "refers_id")
    found = revisits.drop("payload_bytes").join(named, "refers_id", "left")
    found = found.withColumnRenamed(size, "payload_bytes").select(*records.columns, "refers_to")
    rest = records.where("refers_id IS NULL").withColumn("refers_to", F.lit(None).cast("long"))
    return found.unionByName(rest)
