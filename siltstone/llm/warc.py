"""Legacy ARC archives to WARC archives (operator 10).

An ARC file is a version block and records, each a header line, a body of the declared
length and a line feed. Version 1 header lines have five fields (URL, IP address, date,
content type, length); version 2 lines have ten (also result code, checksum, location,
offset and file name). The converter reads the version from the first block, parses each
line accordingly, and takes as many bytes as it declares. From a record it makes a WARC
record: an identifier drawn from the record's name, place and digest, the date in ISO
form, a type, and SHA-1 digests of block and payload. Of records with equal payloads one
is a ``response``; the others are ``revisit`` records that keep the HTTP header, which
says the payload's length, and refer to the response.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.files import Staged, read_range
from siltstone.session import scratch_path

# Fixed values of the two formats.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "code", "checksum", "location", "offset", "file", "length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: WARC records are listed in the manifest by runs of about so many bytes.
RUN = 4 << 20
#: Bytes of an ARC block that one row carries.
ARC_BLOCK = 1 << 20
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


@dataclass
class ArcRecord:
    """One record of an ARC file."""

    url: str
    ip: str
    date: str
    kind: str
    body: bytes

    def http(self) -> tuple[bytes, bytes]:
        """HTTP header and payload; a body without a header is all payload."""
        if self.body.startswith(b"HTTP/"):
            head, mark, payload = self.body.partition(b"\r\n\r\n")
            if mark:
                return head + mark, payload
        return b"", self.body


def _field(text: str | None) -> str:
    """A header-line field: white space would part it."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in text or "") or "-"


def arc_version_block(version: int, name: str = "pages.arc") -> bytes:
    """First block of an ARC file."""
    fields = {1: "URL IP-address Archive-date Content-type Archive-length"}
    fields[2] = (
        "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
        "Filename Archive-length"
    )
    body = f"{version} 0 siltstone\n{fields[version]}\n".encode()
    middle = "" if version == 1 else " 200 - - 0 " + name
    return f"filedesc://{name} 0.0.0.0 19700101000000 text/plain{middle} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, url: str | None, date: str, body: bytes, kind: str = "text/html") -> bytes:
    """One record in the header form of ``version``."""
    middle = "" if version == 1 else " 200 - - 0 -"
    line = f"{_field(url)} 0.0.0.0 {date} {_field(kind)}{middle} {len(body)}\n"
    return line.encode() + body + b"\n"


def arc_records(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC block that begins with its version block."""
    at, version = 0, 0
    while at < len(data):
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"ARC header line at byte {at} has no end")
        parts = data[at:stop].decode("utf-8").split(" ")
        if not version:  # the file's first line names its own length last in both versions
            body = data[stop + 1 : stop + 1 + int(parts[-1])]
            version = int(body[:1])
            if version not in ARC_FIELDS or len(parts) != len(ARC_FIELDS[version]):
                raise ValueError(f"ARC version block {parts} is of no known version")
        else:
            names = ARC_FIELDS[version]
            if len(parts) != len(names):
                raise ValueError(f"ARC header line at byte {at} has {len(parts)} fields")
            row = dict(zip(names, parts))
            body = data[stop + 1 : stop + 1 + int(row["length"])]
            if len(body) != int(row["length"]):
                raise ValueError(f"ARC record at byte {at} is cut off")
            yield ArcRecord(row["url"], row["ip"], row["date"], row["type"], body)
        at = stop + 1 + len(body)
        if data[at : at + 1] != b"\n":
            raise ValueError(f"ARC record before byte {at} is longer than it declares")
        at += 1


def sha1(data: bytes) -> str:
    """SHA-1 in upper-case base 32, as WARC writes digests."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso(date: str) -> str:
    """An ARC date of up to fourteen digits as a WARC date; lacking parts are the least."""
    full = date + "19700101000000"[len(date) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_record(record: ArcRecord, page_id: int | None, refers_to: int | None, copy: bool) -> bytes:
    """The WARC form of an ARC record; ``copy`` makes it a revisit of ``refers_to``'s page."""
    head, payload = record.http()
    block = head if copy else record.body
    digest = sha1(payload)
    own = uuid.uuid5(_SPACE, f"{record.url} {record.date} {page_id} {digest}")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if copy else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{own}>",
        f"WARC-Date: {iso(record.date)}",
        f"WARC-Target-URI: {record.url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1(block)}",
        f"WARC-Page: {'' if page_id is None else page_id}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if copy:
        lines[2:2] = [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To-Page: {'' if refers_to is None else refers_to}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each WARC record."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        if stop < 0 or not lines[0].startswith("WARC/1."):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(fields["Content-Length"])
        block = data[stop + 4 : stop + 4 + size]
        at = stop + 4 + size
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"WARC record before byte {at} is not closed")
        yield fields, block
        at += 4


def _http(payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload


_KEYS = pa.struct([("page_id", pa.int64()), ("copy", pa.bool_()), ("refers_to", pa.int64())])
_PAGES = ("page_id", "url", "copy", "refers_to", "html")


def _arc_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages, in the order of ``_PAGES``, as ARC blocks that take turns in the two versions."""
    version = 1
    parts, keys, size = [], [], 0

    def block() -> pa.RecordBatch:
        data = arc_version_block(version) + b"".join(parts)
        return pa.RecordBatch.from_arrays([pa.array([data]), pa.array([keys], pa.list_(_KEYS))], ["arc", "keys"])

    for batch in batches:
        rows = batch.select(["page_id", "copy", "refers_to"]).to_pylist()
        for key, url, html in zip(rows, batch.column(1).to_pylist(), batch.column(4)):
            day = (key["page_id"] or 0) % 28 + 1
            body = _http((html.as_py() or "").encode())
            parts.append(arc_record(version, url, f"200001{day:02d}000000", body))
            keys.append(key)
            size += len(parts[-1])
            if size >= ARC_BLOCK:
                yield block()
                version, parts, keys, size = 3 - version, [], [], 0
    if parts:
        yield block()


_MANIFEST = "file string, begin bigint, length bigint, records bigint"


def _warc_files(data: str):
    """Turns ARC blocks into one ``.warc.gz`` file of a task, a gzip member per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows, begin, records = None, [], 0, 0
        for batch in batches:
            for arc, keys in zip(batch.column(0), batch.column(1).to_pylist()):
                out = out or Staged(data, f"part-{TaskContext.get().partitionId():010d}.warc.gz")
                for record, key in zip(arc_records(arc.as_py()), keys, strict=True):
                    made = warc_record(record, key["page_id"], key["refers_to"], key["copy"])
                    out.write([gzip.compress(made, 1, mtime=0)])
                    records += 1
                    if out.size - begin >= RUN:
                        rows.append((out.final.rsplit("/", 1)[1], begin, out.size - begin, records))
                        begin, records = out.size, 0
        if out is not None:
            if records:
                rows.append((out.final.rsplit("/", 1)[1], begin, out.size - begin, records))
            out.publish()
            names = [c.split()[0] for c in _MANIFEST.split(", ")]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def to_arc(pages: DataFrame) -> DataFrame:
    """``page_id, url, copy, refers_to, html`` rows as ARC blocks of bounded size.

    ``keys`` names the pages of a block in order.
    """
    keys = "array<struct<page_id: bigint, copy: boolean, refers_to: bigint>>"
    return pages.select(*_PAGES).mapInArrow(_arc_blocks, f"arc binary, keys {keys}")


def convert(blocks: DataFrame, folder: str) -> DataFrame:
    """Write the WARC form of ARC blocks (``arc, keys``) as ``.warc.gz`` files.

    Returns the manifest, kept in ``folder``: a row per run of records.
    """
    return _kept(blocks.select("arc", "keys").mapInArrow(_warc_files(f"{folder}/data"), _MANIFEST), folder)


def convert_pages(pages: DataFrame, folder: str) -> DataFrame:
    """``convert(to_arc(pages))`` in one pass of a task: a block is converted as soon as made."""
    files = _warc_files(f"{folder}/data")
    return _kept(pages.select(*_PAGES).mapInArrow(lambda b: files(_arc_blocks(b)), _MANIFEST), folder)


def _kept(manifest: DataFrame, folder: str) -> DataFrame:
    manifest.write.parquet(f"{folder}/manifest")
    return manifest.sparkSession.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Read converted archives back: a row per record, digests checked.

    ``page_id, url, date, payload_bytes, payload_digest, record_type, refers_to``; the
    length of a revisit's payload is the one its HTTP header declares.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    runs = manifest.repartition(tasks, F.xxhash64("file", "begin"))
    data = f"{folder}/data"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = gzip.decompress(read_range(data, row["file"], row["begin"], row["length"]))
                found = [_described(fields, block) for fields, block in warc_records(raw)]
                if len(found) != row["records"]:
                    raise ValueError(f"{row['file']} has {len(found)} records in a run of {row['records']}")
                yield pa.RecordBatch.from_pylist(found, schema=_DESCRIBED)

    return runs.mapInArrow(
        run,
        "page_id bigint, url string, date string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint",
    )


_DESCRIBED = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("date", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def _described(fields: dict[str, str], block: bytes) -> dict:
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if sha1(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"block of {fields['WARC-Record-ID']} does not match its digest")
    head, _, payload = block.partition(b"\r\n\r\n")
    declared = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    size = int(declared[b"Content-Length"])
    if fields["WARC-Type"] == "response" and (len(payload) != size or sha1(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number = lambda name: int(fields[name]) if fields.get(name) else None
    return {
        "page_id": number("WARC-Page"),
        "url": fields["WARC-Target-URI"],
        "date": fields["WARC-Date"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To-Page"),
    }


def with_copies(
    pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, html, copy, refers_to``: which pages repeat another's payload.

    Of equal payloads of at least ``least_bytes`` bytes the page of the largest id is the
    original, a null id being the least; rows that share that id are originals all.
    """
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    # only what repeats is looked up, and only digests, never payloads, are grouped
    keyed = rows.select("page_id", digest.alias("digest"), F.coalesce(F.octet_length("html"), F.lit(0)).alias("size"))
    groups = keyed.filter(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.count(F.lit(1)).alias("held"), F.max("page_id").alias("refers_to")
    )
    repeated = groups.filter("held > 1").select("digest", "refers_to", F.lit(True).alias("repeated"))
    found = rows.withColumn("digest", digest).join(repeated, "digest", "left")
    original = F.col("page_id").eqNullSafe(F.col("refers_to"))
    copy = F.coalesce(F.col("repeated"), F.lit(False)) & ~original
    return found.select(
        "page_id", "url", "html", copy.alias("copy"), F.when(copy, F.col("refers_to")).alias("refers_to")
    )


def archive(
    pages: DataFrame,
    least_bytes: int = 0,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Every page through ARC blocks into WARC archives, and the archives read back.

    A null page is an empty payload, a null address is ``-``; a null id is written as none.
    Repeated rows are archived each, as their page is. Other columns are ignored; no
    rows give no archives. Payloads go through one join with the digests that repeat; a
    digest of very many pages is split by adaptive execution.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    marked = with_copies(pages, least_bytes, id_col, url_col, html_col)
    convert_pages(marked, folder)
    return read_warc(spark, folder)
