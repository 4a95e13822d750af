"""WARC archives of pages with revisit records, and a reader that salvages damaged files.

Writing: of the records with equal payloads of at least ``REVISIT_BYTES`` bytes,
that with the smallest id is the response, the others are revisits of it without
the payload.  Every record is a gzip member of its own; a task closes a file
after ``FILE_BYTES``.  Rows are sorted in each task, so that a task that is run
again writes the same files.

Reading: a member or record that fails a check (gzip head, checksum and length,
version line, headers, mandatory fields, type, length, block or payload digest)
opens a gap.  The reader searches from the next byte on for a gzip magic number
or a version line that begins a valid record; there the gap ends, is logged with
its bytes and the failed check, and reading goes on.  Inside a member of several
records the search is for version lines: the records around a damage come back,
and the gap has ``inner_start`` and ``inner_stop``, the lost bytes of what the
member holds (no ``inner_stop`` where the rest of it could not be unpacked).
Records of a member whose checksum fails carry that as their ``reason``, as
nothing vouches for their headers; a member of one record is then lost whole.
``after_gap`` marks the first record behind a gap.  A whole archive is held in
memory by the task that reads it.

Null payloads are empty ones; a null url leaves out the target URI; a row
without an id is always a response and is read back without one; rows that
repeat an id and a payload are all responses where their id is the smallest; an
empty table gives no file and an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlens.llm.files import committed

REVISIT_BYTES = 100
FILE_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"  # of every record, so that reruns write equal files
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/"
CANDIDATE = re.compile(rb"\x1f\x8b\x08|WARC/")
VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r\n")
NAME_BYTES = 1024  # file names and comments in gzip heads may be this long
# What the format demands of every record, and its record types.
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
FIELDS = ("path string, kind string, start bigint, stop bigint, reason string, page_id bigint, record_type string, "
          "refers_to bigint, target_uri string, payload_bytes bigint, payload_digest string, payload binary, "
          "inner_start bigint, inner_stop bigint, after_gap boolean")


# -- records -----------------------------------------------------------------
def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One record as a gzip member; revisits come without their payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    name = "none" if page_id is None else str(page_id)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


class Damage(ValueError):
    """A failed check."""


def parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` of uncompressed data and where it ends."""
    if data[at:at + 5] != VERSION:
        raise Damage("no version line")
    line = VERSION_LINE.match(data, at)
    if not line:
        raise Damage("bad version line")
    head, pos = {}, line.end()
    while (end := data.find(b"\r\n", pos)) != pos:  # headers of any length; a false candidate ends at its first bad line
        if end < 0:
            raise Damage("no end of headers")
        name, colon, value = data[pos:end].partition(b":")
        if not colon:
            raise Damage("bad header line")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        pos = end + 2
    if missing := [k for k in MANDATORY if not head.get(k)]:
        raise Damage(f"no {missing[0]}")
    if head["warc-type"] not in TYPES or (head["warc-type"] == "revisit" and "warc-profile" not in head):
        raise Damage("unknown record type" if head["warc-type"] not in TYPES else "no warc-profile")
    if not re.fullmatch(r"[0-9]{1,18}", head["content-length"]):
        raise Damage("no content length")
    start, size = end + 2, int(head["content-length"])
    if data[start + size:start + size + 4] != b"\r\n\r\n":
        raise Damage("wrong content length")
    block = data[start:start + size]
    if (want := head.get("warc-block-digest", "")).startswith("sha256:") and want[7:] != hashlib.sha256(block).hexdigest():
        raise Damage("block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    full = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    want = head.get("warc-payload-digest", "").removeprefix("sha256:")
    if head.get("warc-type") == "response":
        digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
        if want and want != digest:
            raise Damage("payload digest differs")
    else:
        digest, length, payload = want, int(full[1]) if full else None, None
    number = lambda k: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", head.get(k, ""))) else None
    return {"page_id": number("warc-record-id"), "record_type": head.get("warc-type"), "refers_to": number("warc-refers-to"),
            "target_uri": head.get("warc-target-uri"), "payload_bytes": length, "payload_digest": digest,
            "payload": payload}, start + size + 4


class Found(NamedTuple):
    """A record or a gap: where it is in the file and, for a gzip member, in what the member holds."""
    kind: str
    start: int
    stop: int
    reason: str | None
    record: dict | None
    inner_start: int | None = None
    inner_stop: int | None = None
    after_gap: bool = False


def plain(data: bytes) -> Iterator[Found]:
    """Records and gaps of uncompressed data."""
    at, gap, reason = 0, None, None
    while at < len(data):
        try:
            got, end = parse(data, at)
        except Damage as e:
            if gap is None:
                gap, reason = at, str(e)
            later = VERSION_LINE.search(data, at + 1)
            at = later.start() if later else len(data)
            continue
        if gap is not None:
            yield Found("gap", gap, at, reason, None)
        yield Found("record", at, end, None, got, after_gap=gap is not None)
        at, gap = end, None
    if gap is not None:
        yield Found("gap", gap, len(data), reason, None)


def gzip_head(data: bytes, at: int) -> int:
    """Where the compressed bytes of the member at ``at`` begin; a false head is left within NAME_BYTES."""
    if len(data) < at + 18:
        raise Damage("member is cut off")
    flags, pos = data[at + 3], at + 10
    if flags & 0xE0:
        raise Damage("gzip: reserved flags")
    if flags & 4:
        pos += 2 + int.from_bytes(data[pos:pos + 2], "little")
    for bit in (8, 16):
        if flags & bit:
            end = data.find(b"\0", pos, pos + NAME_BYTES)
            if end < 0:
                raise Damage("gzip: no end of name")
            pos = end + 1
    if flags & 2:
        if int.from_bytes(data[pos:pos + 2], "little") != zlib.crc32(data[at:pos]) & 0xFFFF:
            raise Damage("gzip: head checksum differs")
        pos += 2
    return pos


def inflate(data: bytes, pos: int) -> tuple[bytes, int, str | None]:
    """What the compressed bytes at ``pos`` hold as far as they can be read, where they end, and what is wrong with them."""
    view = memoryview(data)
    try:  # only what begins as a record is worth reading up to the damaged byte
        worth = zlib.decompressobj(-15).decompress(view[pos:pos + 4096], len(VERSION)) == VERSION
    except zlib.error:
        worth = False
    unpack, out, step = zlib.decompressobj(-15), [], 1 << 18
    while not unpack.eof:
        if pos >= len(data):
            return b"".join(out), len(data), "member is cut off"
        before = unpack.copy() if step > 1 and worth else None
        try:
            out.append(unpack.decompress(view[pos:pos + step]))
            pos += step
        except zlib.error as e:
            if before is None:
                return b"".join(out), min(pos, len(data)), f"gzip: {e}"
            unpack, step = before, step >> 9  # once more in smaller pieces: a failed call gives nothing back
    end, inner = min(pos, len(data)) - len(unpack.unused_data), b"".join(out)
    trailer = data[end:end + 8]
    if len(trailer) < 8:
        return inner, len(data), "member is cut off"
    whole = trailer == zlib.crc32(inner).to_bytes(4, "little") + (len(inner) & 0xFFFFFFFF).to_bytes(4, "little")
    return inner, end + 8, None if whole else "gzip: checksum or length differs"


def member(data: bytes, at: int) -> tuple[list[Found], int, str | None, int | None]:
    """Records and inner gaps of the member at ``at``, where reading goes on, what is wrong, and from which inner byte on it is lost."""
    try:
        inner, end, wrong = inflate(data, gzip_head(data, at))
    except Damage as e:
        return [], at + 1, str(e), None
    parts = list(plain(inner))
    records = [p for p in parts if p.kind == "record"]
    if not wrong and (records or not inner):
        lost = None
    elif len(records) > 1 or (records and inner.startswith(VERSION, records[0].stop)):
        lost = parts.pop().start if parts[-1].kind == "gap" else len(inner)
    else:  # all of it
        return [], at + 1 if wrong else end, wrong or parts[0].reason, None
    return ([Found(p.kind, at, end, p.reason or wrong, p.record, p.start, p.stop, p.after_gap) for p in parts],
            at + 1 if wrong else end, wrong, lost)


def salvage(data: bytes) -> Iterator[Found]:
    """Records and gaps over a whole file."""
    at, gap = 0, None
    while at < len(data):
        if data[at:at + 3] == MAGIC:
            parts, end, wrong, lost = member(data, at)
        else:
            try:
                got, end = parse(data, at)
                parts, wrong, lost = [Found("record", at, end, None, got)], None, None
            except Damage as e:
                parts, end, wrong, lost = [], at + 1, str(e), None
        if parts and gap:
            yield gap._replace(stop=at)
            if parts[0].kind == "record":
                parts[0] = parts[0]._replace(after_gap=True)
            gap = None
        yield from parts
        if not wrong:
            at = end
            continue
        gap = gap or Found("gap", at, len(data), wrong, None, lost)
        later = CANDIDATE.search(data, end)
        at = later.start() if later else len(data)
    if gap:
        yield gap


# -- Spark -------------------------------------------------------------------
def with_types(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(page_id, url, html, digest, size, refers_to); equal payloads are found by digest, counted before any shuffle."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col), F.lit("")).alias("html"))
    p = p.withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html").cast("long")})
    first = (p.where(F.col("size") >= REVISIT_BYTES).groupBy(F.col("digest").alias("of"))
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null"))
    # payloads too small for a revisit meet nothing; keys of their own keep the many empty ones out of one task
    key = F.when(F.col("size") >= REVISIT_BYTES, F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    joined = p.join(first, key == F.col("of"), "left")
    return joined.withColumn("refers_to", F.when(F.col("page_id") != F.col("first"), F.col("first"))).drop("of", "first", "n")


def write_warc(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", damaged_copy_every: int = 0) -> None:
    """Archives of all pages.  A record whose id is divisible by ``damaged_copy_every`` comes behind a copy with one changed
    byte, which every reading has to find out and leave (0: none)."""
    def run(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        names, row, number = [], next(rows, None), 0
        while row:
            name = f"part-{TaskContext.get().partitionId():06d}-{number:06d}.warc.gz"
            with committed(folder, name) as out:
                while row and out.tell() < FILE_BYTES:
                    page_id, url, html, digest, size, refers_to = row
                    whole = record(page_id, url, html.encode(), digest, size, refers_to)
                    if damaged_copy_every and page_id is not None and page_id % damaged_copy_every == 0:
                        middle = len(whole) // 2
                        out.write(whole[:middle] + bytes([whole[middle] ^ 0xFF]) + whole[middle + 1:])
                    out.write(whole)
                    row = next(rows, None)
            names.append(name)
            number += 1
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])

    typed = with_types(pages, id_col, url_col, payload_col).sortWithinPartitions("page_id", "digest", "url")
    (typed.select("page_id", "url", "html", "digest", "size", "refers_to").mapInArrow(run, "file string")
     .write.format("noop").mode("overwrite").save())


def read_warc(spark: SparkSession, folder: str, *, payloads: bool = True) -> DataFrame:
    """Records and gaps (``kind``) of all archives of a folder; gaps have their bytes and the failed check."""
    def run(batches):
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                out, held = [], 0
                for f in salvage(content.as_py()):
                    got = f.record or dict.fromkeys(("page_id", "record_type", "refers_to", "target_uri", "payload_bytes",
                                                "payload_digest", "payload"))
                    held += len(got["payload"] or b"")
                    if not payloads:
                        got["payload"] = None
                    out.append({"path": path, "kind": f.kind, "start": f.start, "stop": f.stop, "reason": f.reason,
                                "inner_start": f.inner_start, "inner_stop": f.inner_stop, "after_gap": f.after_gap} | got)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)
                        out, held = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*")
             .schema("path string, modificationTime timestamp, length bigint, content binary").load(folder))
    return files.select("path", "content").mapInArrow(run, FIELDS)


SCHEMA = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[t])
                    for n, t in (f.split() for f in FIELDS.split(", "))])
