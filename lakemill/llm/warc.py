"""Web archives: records written per page, and a reader that salvages damaged files.

Every record is a gzip member of its own, so a reader can start at any of them. Spark's text
writer writes the files: it takes the bytes as they are and ends each value with a separator, for
which the member's own last byte stands in. That byte is the top one of the member's length and
zero below 16 MiB; a longer record is cut into several members, as gzip allows.

The reader checks members, version lines, lengths and digests. After a failed check it goes on from
the next member that inflates or the next version line, whichever comes first, and reports the
bytes between as quarantined. Records that a damaged member inflates before it fails are kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import prepare, text_of
from lakemill.session import fresh_folder, settle

VERSION = b"WARC/1.1\r\n"
GZIP = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Bytes of a record in one member; below the 16 MiB at which the last byte is no longer zero.
MEMBER_BYTES = 8 << 20
#: Bytes of payload that a file aims at, so that one file fits in a task.
FILE_BYTES = 24 << 20
READ_BYTES = 1 << 15
_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_HEADER = re.compile(r"([!-9;-~]+):[ \t]*(.*)")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or, if it refers to a page, a revisit without."""
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        # A line break in an address would end the header.
        ("WARC-Target-URI", re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or "urn:unknown")),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    block = HTTP + payload
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
        block = HTTP
    headers += [
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + block + b"\r\n\r\n"


def members(data: bytes) -> bytes:
    """`data` as gzip members, each of them with a zero as its last byte."""
    out = []
    for at in range(0, len(data), MEMBER_BYTES):
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        out.append(packer.compress(data[at : at + MEMBER_BYTES]) + packer.flush())
    return b"".join(out)


@dataclass
class Salvaged:
    """Records found in a file, as (headers, block), and the gaps (start, end, reason) between."""

    records: list[tuple[dict[str, str], bytes]] = field(default_factory=list)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)


def _parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record that starts at `at`; ValueError says what fails."""
    line = _LINE.match(data, at)
    if not line:
        raise ValueError("no version line")
    stop = data.find(b"\r\n\r\n", line.end())
    if stop < 0:
        raise ValueError("headers without an end")
    headers = {}
    for row in data[line.end() : stop].decode("utf-8", "replace").split("\r\n"):
        m = _HEADER.fullmatch(row)
        if not m:
            raise ValueError("a damaged header")
        headers[m[1].lower()] = m[2]
    if not headers.get("content-length", "").isdecimal():
        raise ValueError("no length")
    begin, size = stop + 4, int(headers["content-length"])
    if data[begin + size : begin + size + 4] != b"\r\n\r\n":
        raise ValueError("a wrong length")
    block = data[begin : begin + size]
    told = headers.get("warc-block-digest", "")
    if told.startswith("sha1:") and told[5:] != payload_digest(block):
        raise ValueError("a wrong digest")
    return headers, block, begin + size + 4


def _plain(data: bytes, base: int, out: Salvaged) -> None:
    at = 0
    while at < len(data):
        try:
            headers, block, end = _parse(data, at)
        except ValueError as why:
            following = _LINE.search(data, at + 1)
            end = following.start() if following else len(data)
            out.gaps.append((base + at, base + end, str(why)))
        else:
            out.records.append((headers, block))
        at = end


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the member that starts at `at` holds, where it ends, and "whole", "cut off" or "damaged".

    Of a member that is not whole, all that inflates comes, up to the byte that fails.
    """
    opened, got = zlib.decompressobj(31), []
    while at < len(data) and not opened.eof:
        before = opened.copy()
        try:
            got.append(opened.decompress(data[at : at + READ_BYTES]))
        except zlib.error:
            try:
                for k in range(at, at + READ_BYTES):
                    got.append(before.decompress(data[k : k + 1]))
                    at = k + 1
            except zlib.error:
                pass
            return b"".join(got), at, "damaged"
        at += READ_BYTES
    return b"".join(got), min(at, len(data)) - len(opened.unused_data), "whole" if opened.eof else "cut off"


def _leading(data: bytes, state: str) -> Salvaged:
    """Records in what a member that is not whole did inflate.

    A record that ends where the inflated bytes end is not one of them, as the member's check of
    it is missing. Damaged bytes may inflate to wrong ones, so a digest must tell that they did not.
    """
    out, at = Salvaged(), 0
    while at < len(data):
        try:
            headers, block, end = _parse(data, at)
        except ValueError:
            following = _LINE.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if end < len(data) and (state == "cut off" or headers.get("warc-block-digest", "").startswith("sha1:")):
            out.records.append((headers, block))
        at = end
    return out


def _next(data: bytes, member: int, line: int) -> int:
    """The first member from `member` on that is whole or begins with a record, or version line from `line` on."""
    found = _LINE.search(data, line)
    stop = found.start() if found else len(data)
    at = data.find(GZIP, member, stop)
    while at >= 0:
        got, _, state = _inflate(data, at)
        if state == "whole" or _LINE.match(got):
            return at
        at = data.find(GZIP, at + 1, stop)
    return stop


def salvage(data: bytes) -> Salvaged:
    """All records of a file that pass their checks: plain ones, those in gzip members, and both mixed."""
    out = Salvaged()
    member, line = data.find(GZIP), _LINE.search(data)
    plain = bool(line) and (member < 0 or line.start() < member)
    at, start, held = 0, 0, b""  # held: bytes of a record that began at `start` and goes on
    while at < len(data):
        got, end, state = _inflate(data, at) if data.startswith(GZIP, at) else (b"", at, "none")
        if held and (state == "none" or _LINE.match(got)):
            out.gaps.append((start, at, "a record without its end"))
            held = b""
        if state != "whole":
            failed, inner = end, Salvaged()
            why = "no version line" if plain else "no valid member"
            if state != "none":
                inner, why = _leading(held + got, state), "no valid member"
                out.records += inner.records
                if held and not inner.records:
                    out.gaps.append((start, at, "a record without its end"))
                held = b""
            elif _LINE.match(data, at):
                plain = True
                try:
                    headers, block, end = _parse(data, at)
                except ValueError as reason:
                    why = str(reason)
                else:
                    out.records.append((headers, block))
                    at = end
                    continue
            # Records that were read from a member are not sought again in its bytes.
            end = _next(data, at + 1, max(failed, at + 1) if inner.records else at + 1)
            out.gaps.append((at, end, why))
            at = end
            continue
        plain = False
        if not held:
            start = at
        held += got
        at = end
        try:
            headers, block, stop = _parse(held, 0)
        except ValueError as why:
            if str(why) in ("a wrong length", "headers without an end") and len(got) == MEMBER_BYTES:
                continue  # the record may go on in the next member
            stop = 0
        else:
            out.records.append((headers, block))
        if stop < len(held):  # further records in the same member, or after one that fails
            inner = Salvaged()
            _plain(held[stop:], 0, inner)
            out.records += inner.records
            out.gaps += [(start, end, why) for *_, why in inner.gaps]
        held = b""
    if held:
        out.gaps.append((start, len(data), "a record without its end"))
    return out


def write(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", date: str = "2024-01-01T00:00:00Z") -> str:
    """Writes a record for every row and returns the folder.

    Of rows with equal payloads the one with the smallest id is a response and the others revisit
    it; rows that repeat that id are responses too. A null html is the empty payload. A row without
    an id is a response if no row with an id has its payload. An empty table writes no record.
    Other columns are ignored.
    """
    spark = prepare(pages.sparkSession)
    source = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), text_of(html).alias("html"))
    keyed = settle(source.select("page_id", F.sha2("html", 256).alias("content"), F.octet_length("html").cast("long").alias("bytes")), "page-digests")
    total, n = keyed.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    repeated = settle(
        keyed.groupBy("content").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 AND refers_to IS NOT NULL").drop("n"),
        "repeated-payloads",
    )
    same = F.col("page_id").eqNullSafe(F.col("refers_to"))
    revisits = settle(keyed.join(repeated, "content").where(~same).select("page_id", "content", "refers_to").distinct(), "revisits")
    told = revisits.select(F.col("page_id").alias("__id"), F.col("content").alias("__content"), "refers_to")
    linked = (
        source.withColumn("content", F.sha2("html", 256))
        .join(told, F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("content") == F.col("__content")), "left")
        .select("page_id", "url", "html", "refers_to")
    )

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*[c.to_pylist() for c in b.columns])
            packed = [members(record(i, u, (h or "").encode("utf-8", "surrogatepass"), r, date))[:-1] for i, u, h, r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["value"])

    path = fresh_folder(spark, "warc")
    archive = linked.mapInArrow(lay, "value binary").select(F.col("value").cast("string"))
    per_file = max(1, n * FILE_BYTES // max(total, FILE_BYTES))
    archive.write.option("lineSep", "\x00").option("maxRecordsPerFile", per_file).text(path)
    return path


def _page(told: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", told or "")
    return int(m[1]) if m else None


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Records (page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) and
    gaps (file, start, end, reason) of the files in a folder.

    A response whose payload differs from its digest counts as a gap, as any record that fails.
    """
    prepare(spark, 1)  # a row is a whole file
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Salvaged]]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                yield name, salvage(data.as_buffer().to_pybytes())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, got in found(batches):
            for at in range(0, len(got.records), 256):
                out = []
                for headers, block in got.records[at : at + 256]:
                    payload = block[block.find(b"\r\n\r\n") + 4 :] if headers.get("warc-type") == "response" else None
                    size = len(payload) if payload is not None else int(headers.get("x-payload-length") or 0)
                    digest = payload_digest(payload) if payload is not None else headers.get("warc-payload-digest", "")[5:]
                    out.append((_page(headers.get("warc-record-id")), headers.get("warc-target-uri"), headers.get("warc-type"), size, digest, _page(headers.get("warc-refers-to")), payload))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    def lost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, got in found(batches):
            if got.gaps:
                start, end, why = zip(*got.gaps)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(why)), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(why)], names=["file", "start", "end", "reason"])

    columns = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    return files.mapInArrow(rows, columns), files.mapInArrow(lost, "file string, start long, end long, reason string")
