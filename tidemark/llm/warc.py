"""WARC archives: a writer with revisit records and a salvaging reader.

Archives are files of bounded size, each a chain of gzip members (or plain
records), written and read by Spark, so any file system it knows will do.  The
reader checks every record: member checksum, version line, headers, declared
length, closing blank lines and payload digest.  After a failed check it looks
for the next place where a whole valid record begins, goes on from there, and
reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_stream, materialize, scratch_dir

ARCHIVE_BYTES = 16 * 1024 ** 2
WARC_DATE = "1970-01-01T00:00:00Z"
# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"
RECORD_ID = "urn:page:"

_FEED = 1 << 16
_START = re.compile(rb"\x1f\x8b\x08|(?:(?<=\n)|\A)WARC/1\.[01]\r\n")


class BadRecord(Exception):
    """A record that failed a check."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return VERSION + lines.encode("utf-8", "replace") + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """A response record, or with ``refers_to`` a revisit without the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"),
               ("WARC-Record-ID", f"<{RECORD_ID}{'' if page_id is None else page_id}>"), ("WARC-Date", WARC_DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    headers += [("WARC-Payload-Digest", "sha1:" + payload_digest(payload)), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        return _record(headers, http + payload)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>")]
    return _record(headers, http)


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse_record(data: bytes, start: int = 0, exact: bool = False) -> tuple[dict[str, str], bytes, int]:
    """Headers (lower-case names), block and end of the record at ``start``; raises BadRecord."""
    if not re.compile(rb"WARC/1\.[01]\r\n").match(data, start):
        raise BadRecord("no version line")
    body = data.find(b"\r\n\r\n", start)
    if body < 0:
        raise BadRecord("headers not closed")
    headers: dict[str, str] = {}
    for line in data[start:body].split(b"\r\n")[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise BadRecord("malformed header")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise BadRecord("no content length")
    end = body + 4 + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        raise BadRecord("record not closed at its declared length")
    if exact and end + 4 != len(data):
        raise BadRecord("bytes after the record in its member")
    block = data[body + 4:end]
    kind, digest = headers.get("warc-type"), headers.get("warc-payload-digest", "")
    if kind == "response" and digest.startswith("sha1:") and payload_digest(http_payload(block)) != digest[5:]:
        raise BadRecord("payload digest differs")
    return headers, block, end + 4


def http_payload(block: bytes) -> bytes:
    head = block.find(b"\r\n\r\n")
    return block[head + 4:] if head >= 0 else b""


def http_length(block: bytes) -> int:
    found = re.search(rb"\r\nContent-Length: ([0-9]+)\r\n", block)
    return int(found[1]) if found else 0


def _member(data: bytes, start: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``start`` and its end; raises BadRecord."""
    unpack, parts, at = zlib.decompressobj(31), [], start
    try:
        while not unpack.eof and at < len(data):
            parts.append(unpack.decompress(data[at:at + _FEED]))
            at += _FEED
    except zlib.error as e:
        raise BadRecord(f"gzip: {e}") from None
    if not unpack.eof:
        raise BadRecord("gzip: member not closed")
    return b"".join(parts), min(at, len(data)) - len(unpack.unused_data)


def _one(data: bytes, start: int) -> tuple[dict[str, str], bytes, int]:
    if data.startswith(GZIP_MAGIC, start):
        content, end = _member(data, start)
        headers, block, _ = parse_record(content, exact=True)
        return headers, block, end
    return parse_record(data, start)


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str | None]]:
    """(start, end, headers, block, None) of each valid record and
    (start, end, None, b"", reason) of each gap, in file order.

    Zero bytes between or after records are padding.  Every byte of the file
    is in a record, in a gap or padding.
    """
    at, size = 0, len(data)
    while at < size:
        if data[at] == 0:
            at += 1
            continue
        try:
            headers, block, end = _one(data, at)
        except BadRecord as first:
            gap, reason, found = at, str(first), None
            for candidate in _START.finditer(data, at + 1):
                try:
                    found = _one(data, candidate.start())
                    at = candidate.start()
                    break
                except BadRecord:
                    continue
            if found is None:
                yield gap, size, None, b"", reason
                return
            yield gap, at, None, b"", reason
            headers, block, end = found
        yield at, end, headers, block, None
        at = end


def plan_records(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """``pages`` with __payload (binary), __refers_to (null for responses).

    Of equal payloads of at least ``min_bytes`` bytes the largest id is the
    response (all rows of it, where its row is repeated), the others refer to it.
    """
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.withColumn("__payload", payload).withColumn("__sha", F.sha1("__payload"))
    kept = materialize(rows.where(F.octet_length("__payload") >= min_bytes).groupBy("__sha")
                       .agg(F.max(id_col).alias("__keep"), F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n"), "payload-groups")
    revisit = F.col("__keep").isNotNull() & ~F.col("__keep").eqNullSafe(F.col(id_col))
    return rows.join(kept, "__sha", "left").withColumn("__refers_to", F.when(revisit, F.col("__keep")))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, compress: bool = True) -> None:
    """One record per row, into archives of about ``archive_bytes`` below ``path``.

    A null payload is empty, a null url has no target header, a null id an
    empty record name; other columns are ignored; an empty table writes no archive.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held, size = [], 0
        for page_id, url, payload, refers_to in rows:
            record = page_record(page_id, url, payload, refers_to)
            held.append(gzip_member(record) if compress else record)
            size += len(held[-1])
            if size >= archive_bytes:
                yield (b"".join(held),)
                held, size = [], 0
        if held:
            yield (b"".join(held),)

    planned = plan_records(pages.select(*{id_col, url_col, payload_col}), id_col, payload_col, min_bytes)
    archives = map_stream(planned, [id_col, url_col, "__payload", "__refers_to"], "content binary", run)
    # One file per row; the writer closes each with one zero byte, which is padding.
    (archives.select(F.col("content").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("lineSep", "\0").text(path))


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per valid record and per quarantined gap.

    path, start, length; for records record_type, page_id, url, payload_bytes,
    payload_digest, refers_to (and payload); for gaps only ``gap_reason``.
    """

    def number(name: str) -> int | None:
        found = re.fullmatch(f"<{RECORD_ID}(-?[0-9]+)>", name)
        return int(found[1]) if found else None

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for file, content in rows:
            for start, end, headers, block, reason in salvage(content):
                if headers is None:
                    yield (file, start, end - start, reason, *[None] * (7 if with_payload else 6))
                    continue
                kind = headers.get("warc-type")
                full = kind == "response"
                payload = http_payload(block) if full else None
                yield (file, start, end - start, None, kind, number(headers.get("warc-record-id", "")),
                       headers.get("warc-target-uri"), len(payload) if full else http_length(block),
                       headers.get("warc-payload-digest", "").removeprefix("sha1:"),
                       number(headers.get("warc-refers-to", "")), *([payload] if with_payload else []))

    schema = ("path string, start long, length long, gap_reason string, record_type string, page_id long, url string, "
              "payload_bytes long, payload_digest string, refers_to long" + (", payload binary" if with_payload else ""))
    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary") \
                 .format("binaryFile").load(path)
    return map_stream(files, ["path", "content"], schema, run)


def without_gaps(found: DataFrame) -> DataFrame:
    """The records of archives that must be sound.

    Where a reader had to quarantine bytes, the gaps are written to the scratch
    folder as a log and the job stops with its place.
    """
    found = materialize(found, "warc-records")
    gaps = found.where("gap_reason IS NOT NULL").select("path", "start", "length", "gap_reason")
    if not gaps.isEmpty():
        log = scratch_dir(found.sparkSession, "warc-gaps")
        gaps.write.parquet(log)
        raise ValueError(f"archives have unreadable bytes, listed in {log}")
    return found
