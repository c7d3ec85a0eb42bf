"""Operator 1: WARC archives and a reader that salvages damaged ones.

The writer stores one record per page, compressed record by record, and turns
repeated payloads into revisit records. The reader checks every member and
record; after a failed check it searches for the next valid gzip member or
version line, also inside a member, goes on from there, and reports the bytes in
between (the member, if it is inside one) as a gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.columns import quoted
from glyphmill.sources.scratch import materialize

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"
RECORD_END = b"\r\n\r\n"

# The end of a header is looked for in so many bytes first, then up to the next version line.
_HEADER = 1 << 16
# An archive is closed once it has so many bytes.
FILE_BYTES = 1 << 28
_CONTROL = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_FEED = 1 << 18
_BATCH_BYTES = 1 << 23


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add ``refers_to``: the smallest page_id with an equal payload, null for that page itself.

    ``pages`` has page_id, url, payload (binary). Payloads under ``least_bytes``
    refer to nothing, nor does a null page_id. Ids and digests are stored once
    and grouped; a page's payload moves once, by its own id, so that many
    copies of one payload do not meet in a task. Both sides of the join by
    digest are stored tables, so Spark splits the partition of a hot payload.
    """
    rows = pages.withColumn("_digest", F.sha1("payload"))
    thin = rows.where(F.length("payload") >= least_bytes).select("page_id", "_digest")
    thin = materialize(thin, "warc-digests")
    first = thin.groupBy("_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = materialize(first.where(F.col("_n") > 1).drop("_n"), "warc-firsts")
    revisits = (
        thin.join(first, "_digest")
        .where(F.col("page_id") > F.col("_first"))
        .groupBy("page_id", "_digest")
        .agg(F.min("_first").alias("refers_to"))
    )
    return rows.join(revisits, ["page_id", "_digest"], "left").drop("_digest")


def _field(name: str, value: str) -> str:
    clean = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)
    return f"{name}: {clean}\r\n"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record: the HTTP response, or for a revisit its header alone."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = VERSION.decode() + "\r\n"
    head += _field("WARC-Type", "response" if refers_to is None else "revisit")
    head += _field("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>")
    head += _field("WARC-Date", date)
    if url is not None:
        head += _field("WARC-Target-URI", url)
    if refers_to is not None:
        head += _field("WARC-Refers-To", f"<urn:page:{refers_to}>")
        head += _field("WARC-Profile", REVISIT_PROFILE)
    head += _field("WARC-Payload-Digest", "sha1:" + sha1_base32(payload))
    head += _field("WARC-Block-Digest", "sha1:" + sha1_base32(block))
    head += _field("Content-Type", "application/http;msgtype=response")
    head += f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode("utf-8", "replace") + block + RECORD_END


def member(record: bytes) -> bytes:
    """A gzip member that ends in a zero byte (the size's upper one); if not, an empty member follows."""
    packed = gzip.compress(record, compresslevel=3, mtime=0)
    return packed if packed[-1] == 0 else packed + gzip.compress(b"", mtime=0)


def write_archives(
    pages: DataFrame,
    path: str,
    url_col: str = "url",
    body_col: str = "html",
    id_col: str = "page_id",
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write one record per row below ``path``, gzip member by member.

    An archive has at most ``file_bytes`` bytes, and one more record: a task goes
    on in the next folder ``roll=<n>`` then.

    A null body is an empty payload, a null url leaves the field out, a null id
    gives an empty record id. Rows repeated with id and body are repeated
    records of the same kind. Other columns are ignored.

    Spark's own text writer does the writing, so any file system it knows will
    do and a retried task leaves no half file: its line end stands for the last
    byte of each member, which is zero.
    """
    payload = F.coalesce(quoted(body_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        quoted(id_col).cast("long").alias("page_id"), quoted(url_col).cast("string").alias("url"), payload.alias("payload")
    )
    marked = mark_revisits(rows, least_bytes).select("page_id", "url", "payload", "refers_to")

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = roll = 0
        for batch in batches:
            values, rolls, size = [], [], 0
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                values.append(member(record_bytes(*row, date))[:-1])
                rolls.append(roll)
                size += len(values[-1])
                written += len(values[-1]) + 1
                if written >= file_bytes:
                    written, roll = 0, roll + 1
                if size > _BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), pa.array(rolls, pa.int32())], names=["value", "roll"])
                    values, rolls, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), pa.array(rolls, pa.int32())], names=["value", "roll"])

    (
        marked.mapInArrow(serialise, "value binary, roll int")
        .select(F.col("value").cast("string"), "roll")
        .write.option("lineSep", "\x00")
        .partitionBy("roll")
        .text(path)
    )


class Damage(Exception):
    """A check failed."""


def _next_line(data: bytes, pos: int) -> int:
    """The next place where a line begins like a version line; the end if there is none."""
    line = data.find(b"WARC/", pos)
    while line >= 0 and (data[line + 5 : line + 7] not in (b"1.", b"0.") or (line > 0 and data[line - 1 : line] != b"\n")):
        line = data.find(b"WARC/", line + 1)
    return line if line >= 0 else len(data)


def _headers(data: bytes, pos: int) -> tuple[dict[str, str], int]:
    """Fields of the record that begins at ``pos``, and where its block begins."""
    if data[pos : pos + 7] not in (b"WARC/1.", b"WARC/0."):
        raise Damage("no version line")
    end = data.find(RECORD_END, pos, pos + _HEADER)
    if end < 0:
        end = data.find(RECORD_END, pos + _HEADER - len(RECORD_END), _next_line(data, pos + 1))
    if end < 0:
        raise Damage("header without end")
    fields = {}
    if _CONTROL.search(data, pos, end):
        raise Damage("control character in header")
    for line in bytes(data[pos:end]).decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damage("broken header line")
        fields[name.strip().lower()] = value.strip()
    if not fields.get("warc-type") or not fields.get("warc-record-id"):
        raise Damage("type or record id is missing")
    return fields, end + len(RECORD_END)


def _payload(fields: dict[str, str], block: bytes) -> bytes:
    """The HTTP entity, or the whole block of other content."""
    if not fields.get("content-type", "").startswith("application/http"):
        return block
    return block.partition(RECORD_END)[2]


def read_record(data: bytes, pos: int) -> tuple[dict[str, str], bytes, int]:
    """(fields, block, end) of the record at ``pos``; raises ``Damage`` if a check fails."""
    fields, start = _headers(data, pos)
    length = fields.get("content-length", "")
    if not length.isdecimal() or len(length) > 18:
        raise Damage("no content length")
    end = start + int(length)
    if data[end : end + 4] != RECORD_END:
        raise Damage("record end not where the length puts it")
    block = bytes(data[start:end])
    stated = fields.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != sha1_base32(block):
        raise Damage("block digest differs")
    stated = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "response" and stated.startswith("sha1:"):
        if stated[5:] != sha1_base32(_payload(fields, block)):
            raise Damage("payload digest differs")
    return fields, block, end + len(RECORD_END)


def _member(data: memoryview, pos: int) -> tuple[bytes, int, str]:
    """(content, end, damage) of the gzip member at ``pos``. Its checksum and size are checked by zlib.

    ``damage`` is empty if all is well, else ``content`` is what could be inflated and ``end`` where that failed.
    """
    inflate, parts, at = zlib.decompressobj(wbits=31), [], pos
    try:
        while not inflate.eof:
            piece = data[at : at + _FEED]
            if not len(piece):
                return b"".join(parts), at, "member is cut off"
            parts.append(inflate.decompress(piece))
            at += len(piece)
    except zlib.error as error:
        # the piece that failed once more, byte by byte, for what it gives before
        inflate = zlib.decompressobj(wbits=31)
        if at > pos:
            inflate.decompress(data[pos:at])
        try:
            while True:
                parts.append(inflate.decompress(data[at : at + 1]))
                at += 1
        except zlib.error:
            return b"".join(parts), at, f"member: {error}"
    return b"".join(parts), at - len(inflate.unused_data), ""


def _next_start(data: bytes, pos: int, lines_from: int) -> int:
    """The next place where a member, or from ``lines_from`` on a version line, may begin; the end if there is none."""
    line = _next_line(data, max(pos, lines_from))
    magic = data.find(GZIP_MAGIC, pos, line + len(GZIP_MAGIC))
    return magic if magic >= 0 else line


def _member_records(content: bytes, damage: str) -> tuple[list[tuple], str]:
    """(records, reason) of a member's content; ``reason`` names its gaps, and is empty if there are none.

    After a failed check the next version line is tried. If the member itself is
    damaged and is one record, its check is the record's and the record is not sound.
    """
    found, gaps, at = [], [], 0
    while at < len(content):
        try:
            fields, block, end = read_record(content, at)
        except Damage as failed:
            end = _next_line(content, at + 1)
            # places that follow each other without a record between them are one gap
            if gaps and gaps[-1][1] == at:
                gaps[-1][1] = end
            else:
                gaps.append([at, end, str(failed)])
        else:
            found.append((fields, block))
            if damage and at == 0 and end == len(content):
                found = []
        at = end
    reasons = [damage] * bool(damage) + [f"{reason} (bytes {a} to {b} of the content)" for a, b, reason in gaps]
    return found, "; ".join(reasons)


def salvage(data: bytes) -> Iterator[tuple]:
    """Every sound record and every gap of an archive, in order.

    ("record", start, end, fields, block) or ("gap", start, end, reason). A
    member's records share its place. A member in which a check fails is a gap,
    whose reason names the places in its content; its sound records, before and
    after the damage and also of a member that is cut off, come before the gap
    and have its start as their place.
    """
    view, pos, gap, reason, lines_from = memoryview(data), 0, -1, "", 0
    while pos < len(data):
        if data[pos : pos + 3] == GZIP_MAGIC:
            content, end, damage = _member(view, pos)
            found, failed = _member_records(content, damage)
            if damage:
                # a member that follows may begin before the place of failure; stored lines were read above
                lines_from = max(lines_from, end)
                end = _next_start(data, pos + 1, lines_from)
        else:
            found, failed = [], ""
            try:
                fields, block, end = read_record(data, pos)
                found.append((fields, block))
            except Damage as error:
                failed, end = str(error), _next_start(data, pos + 1, lines_from)
        if failed:
            if gap < 0:
                gap, reason = pos, failed
            for fields, block in found:
                yield "record", pos, pos, fields, block
        else:
            if gap >= 0:
                yield "gap", gap, pos, reason
                gap = -1
            for fields, block in found:
                yield "record", pos, end, fields, block
        pos = end
    if gap >= 0:
        yield "gap", gap, len(data), reason


ROWS = (
    "kind string, file string, start long, end long, reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary, "
    "fields map<string,string>"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records and gaps of the archives below ``path``, gzip or plain.

    One row per sound record (``kind`` record) and per quarantined byte range
    (``kind`` gap, with its reason). ``payload_bytes`` and ``payload_digest``
    are of the full payload, also for revisits, which store none. A file is
    read by one task, whole: archives are to be at most some hundred MB, as the
    writer makes them and as is usual. Folders without archives give no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    schema = pa.schema(
        [(n, pa.string()) for n in ("kind", "file")]
        + [("start", pa.int64()), ("end", pa.int64())]
        + [(n, pa.string()) for n in ("reason", "record_type", "record_id", "target_uri", "refers_to", "payload_digest")]
        + [("payload_bytes", pa.int64()), ("payload", pa.binary()), ("fields", pa.map_(pa.string(), pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows, size = [], 0
                for item in salvage(content.as_py()):
                    rows.append(_row(name.as_py(), item))
                    size += len(rows[-1].get("payload") or b"") + 200
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.mapInArrow(run, ROWS)


def _row(file: str, item: tuple) -> dict:
    kind, start, end = item[:3]
    row = {"kind": kind, "file": file, "start": start, "end": end}
    if kind == "gap":
        return row | {"reason": item[3]}
    fields, block = item[3:]
    payload = _payload(fields, block)
    length = len(payload)
    if fields.get("warc-type") == "revisit":
        stated = re.search(rb"(?im)^content-length:\s*([0-9]+)\s*$", block.partition(RECORD_END)[0])
        length = int(stated[1]) if stated else None
    return row | {
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or sha1_base32(payload),
        "payload_bytes": length,
        "payload": payload,
        "fields": fields,
    }


def page_number(record_id: Column) -> Column:
    """The id the writer put into a record id."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")
