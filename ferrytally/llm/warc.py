"""WARC archives: written as one gzip member per record, read back by byte ranges.

Writing. Payloads are compared by SHA-1 and length. Of equal ones that are long enough, the row with the largest
id is a response, the others are revisits that refer to it. Records are compressed in Python workers and stored
by Spark's text sink, which commits files as a whole and writes to any file system Spark knows. The sink ends
each row with a separator; that is the byte 0, which is also the last byte of every gzip member of less than
16 MiB of data (the high byte of its size), and is cut from the row. A larger record is followed by an empty member.

Reading. Files are cut into byte ranges, whatever lies in them. A task scans its range for the gzip magic,
takes a candidate for a record if its header is one of gzip and its data begin like a WARC record, and owns the
records that start inside the range; it reads on past the end to finish the last one. A record that lies
within another one (an archive kept in an archive) starts before the end of a record of an earlier range; each range tells how far
its records reach, and rows that start before that are dropped. Only these reaches, one per range, are compared
within a file. With payloads the archives are read twice, so that payloads are never shuffled or stored.
Files are opened with pyarrow's file systems.

Archives of other writers may hold any type of record. The payload is what follows the HTTP header where the record holds an HTTP
message, else the whole block. A missing length, type or address is null; a missing digest is computed from the payload, and is null for a
revisit. A SHA-1 that is given is checked, unless the payload is truncated or transfer-encoded; other digests are returned as they are.

Defined results: a null html is an empty payload; rows that share the largest id of their group are all responses;
null ids count as smallest, and rows of a group without any id are all responses. Line breaks in a url are
percent-encoded, a null url is left out. An empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrytally.llm.common import join_counted, map_arrow, stored, table
from ferrytally.session import scratch_path

SPLIT_BYTES = 32 << 20
READ_BYTES = 1 << 20
MIN_BYTES = 0  # payloads of at least so many bytes are written once

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1."


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, not compressed."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line(url)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member (or two) whose last byte is 0, the same for the same data."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = pack.compress(data) + pack.flush()
    return packed if packed[-1] == 0 else packed + EMPTY_MEMBER


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = zip(*[b.column(c) for c in ("page_id", "url", "payload", "refers_to", "revisit")])
        packed = [member(record(*[v.as_py() for v in row]))[:-1] for row in rows]
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["member"])


def write(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write a record per row to new archives under ``path``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).select(
        "*", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size")
    )
    # Only payloads that occur more than once are looked up.
    firsts = rows.filter(F.col("size") >= min_bytes).groupBy("sha", "size").agg(
        F.count(F.lit(1)).alias("times"), F.max("page_id").alias("largest")
    ).filter((F.col("times") > 1) & F.col("largest").isNotNull())
    judged = join_counted(rows, firsts, ["sha", "size"], "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    records = judged.select(
        "page_id", "url", "payload", F.when(revisit, F.col("largest")).alias("refers_to"), revisit.alias("revisit")
    )
    packed = map_arrow(records, _members, "member binary")
    packed.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").option(
        "compression", "none"
    ).text(path)


def _uri(path: str) -> str:
    return re.sub(r"^file:/+", "file:///", path)


class Range:
    """The records that start within a byte range of an archive."""

    def __init__(self, file, start: int, end: int):
        self.file, self.at, self.end = file, start, end
        self.size = file.size()

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _next_magic(self, at: int) -> int | None:
        while at < self.end:
            chunk = self._read(at, READ_BYTES)
            found = chunk.find(MAGIC)
            if found >= 0:
                return at + found if at + found < self.end else None
            if len(chunk) < READ_BYTES:
                return None
            at += len(chunk) - len(MAGIC) + 1
        return None

    def _member(self, at: int) -> tuple[bytes, int] | None:
        """Data and end of the member at a place, or None if there is no record or empty member."""
        unpack, parts, place, checked = zlib.decompressobj(31), [], at, False
        while not unpack.eof:
            chunk = self._read(place, READ_BYTES)
            if not chunk:
                return None
            if place == at and (len(chunk) < 10 or chunk[3] & 0xE0):
                return None
            place += len(chunk)
            try:
                if not checked:
                    # The first bytes tell whether this is a record, before the rest is unpacked.
                    first = unpack.decompress(chunk, 4096)
                    if not VERSION.startswith(first[:len(VERSION)]):
                        return None
                    checked = True
                    parts.append(first)
                    chunk = unpack.unconsumed_tail
                parts.append(unpack.decompress(chunk))
            except zlib.error:
                return None
        return b"".join(parts), place - len(unpack.unused_data)

    def __iter__(self) -> Iterator[tuple[int, int, bytes]]:
        at = self._next_magic(self.at)
        while at is not None:
            found = self._member(at)
            if found is None:
                at = self._next_magic(at + 1)
                continue
            data, after = found
            if data:
                yield at, after, data
            at = self._next_magic(after)


def parse(data: bytes) -> dict:
    """Headers (lower-case names) and block of a record; without a length the block goes on to the end of the data."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = headers.get("content-length", "")
    return headers | {"block": rest[:int(length)] if length.isdecimal() else rest.removesuffix(b"\r\n\r\n")}


def _page(urn: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d{1,18})>", urn)
    return int(found[1]) if found else None


def _described(data: bytes) -> tuple:
    """page, url, payload size, digest, type, page referred to and payload (None for a revisit); what is not told is None."""
    r = parse(data)
    kind, given = r.get("warc-type"), r.get("warc-payload-digest")
    http, payload = b"", r["block"]
    if r.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = payload.partition(b"\r\n\r\n")
    digest = given and given.removeprefix("sha1:")
    if kind == "revisit":
        told = re.search(rb"(?i)\r\ncontent-length: *(\d{1,18})(?!\d)", http)
        size, payload = int(told[1]) if told else None, None
    else:
        size = len(payload)
        encoded = "warc-truncated" in r or re.search(rb"(?i)\r\ntransfer-encoding:", http)
        if not given or (given != digest and not encoded):
            own = base32_sha1(payload)
            if given and own != digest:
                raise ValueError(f"payload of {r.get('warc-record-id')} does not match its digest")
            digest = own
    return (
        _page(r.get("warc-record-id", "")), r.get("warc-target-uri"), size, digest, kind,
        _page(r.get("warc-refers-to", "")), payload,
    )


_FIELDS = [
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
]
_PLACES = [("path", pa.string()), ("range", pa.int64()), ("start", pa.int64()), ("after", pa.int64())]


def _records(with_payload: bool):
    schema = pa.schema([*_PLACES, *(_FIELDS if with_payload else _FIELDS[:-1])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start, end, floor in zip(*[b.column(c).to_pylist() for c in ("path", "range", "end", "floor")]):
                system, name = fs.FileSystem.from_uri(_uri(path))
                with system.open_input_file(name) as file:
                    rows, held = [], 0
                    for at, after, data in Range(file, start, end):
                        if at < floor:
                            continue
                        row = _described(data)
                        rows.append((path, start, at, after, *(row if with_payload else row[:-1])))
                        held += len(data) if with_payload else 200
                        if held > 4 * READ_BYTES:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                    yield _batch(rows, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def read(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """The records of all archives under ``path``; payloads only if asked for."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes).cast("bigint")))
    ranges = files.select("path", "length", starts.alias("range")).select(
        "path", "range", F.least("length", F.col("range") + split_bytes).alias("end")
    )
    number = max(1, ranges.count())
    kind = "path string, range bigint, start bigint, after bigint, page_id bigint, url string, payload_bytes bigint, "
    kind += "payload_digest string, record_type string, refers_to bigint"
    begin = F.lit(0).cast("bigint").alias("floor")
    found = stored(ranges.select("*", begin).repartition(number).mapInArrow(_records(False), kind))
    earlier = Window.partitionBy("path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    reached = found.groupBy("path", "range").agg(F.max("after").alias("reach"))
    floors = reached.select("path", "range", F.coalesce(F.max("reach").over(earlier), F.lit(0)).alias("floor"))
    if with_payload:
        again = ranges.join(floors, ["path", "range"]).repartition(number)
        return again.mapInArrow(_records(True), f"{kind}, payload binary").drop(*[n for n, _ in _PLACES])
    return found.join(floors, ["path", "range"]).filter("start >= floor").drop(*[n for n, _ in _PLACES], "floor")


def query(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    return read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
