"""WARC archives: a writer of one gzip member per record, and a reader that splits archives at any byte.

A reading task gets a byte range of an archive. It scans the range for the gzip magic, accepts a position as the start of a member
if the bytes there inflate to a WARC version line, and owns the records whose members start inside its range; the last one is
read beyond the end of the range. From an accepted member it goes on at the byte behind it, so ranges agree on every start. The exception is
a payload that deflate stored as it was and that holds a gzipped record itself: a range that begins inside it takes that for a record.
Text such as html cannot hold one, as the magic is no UTF-8; read archives of binary payloads with ``split_bytes`` of their size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.llm.common import new_folder, slices, small, storage, written

MAGIC = b"\x1f\x8b\x08"
#: Names and version line of the WARC 1.1 format.
VERSION, PROFILE = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INTEGER = re.compile(r"-?[0-9]{1,19}")
ARCHIVE_BYTES, SPLIT_BYTES, READ_BYTES = 512 << 20, 16 << 20, 1 << 20
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, level: int = 6) -> bytes:
    """One record as a gzip member of its own; a revisit keeps the HTTP head with the payload's length, not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Target-URI", (url or "").replace("\r", " ").replace("\n", " ")),
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"), ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))), ("X-Page-Id", "" if page_id is None else str(page_id))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    raw = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the finished archives (path, records, bytes) as a written table.

    Of rows with equal payloads of at least ``min_bytes``, those with the largest page_id are responses, the others revisits of it.
    Null html is an empty payload; a null page_id is smaller than any. Only archives of tasks that succeeded are in the table, so a
    repeated or lost task leaves no record twice.
    """
    pages = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    pages = pages.withColumn("sha", F.sha2("payload", 256)).withColumn("weighed", F.octet_length("payload") >= min_bytes)
    groups = pages.where("weighed").groupBy("sha").agg(F.max("page_id").alias("last_id"), F.count("*").alias("n"))
    groups = small(written(groups.where("n > 1 AND last_id IS NOT NULL").select(F.col("sha").alias("group_sha"), "last_id"), "warc-groups"))
    rows = pages.join(groups, (F.col("sha") == F.col("group_sha")) & F.col("weighed"), "left")
    rows = rows.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("last_id")), F.col("last_id")).alias("refers_to"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        fs, base = storage(folder)
        fs.create_dir(base)
        stream, name, done, size = None, "", 0, 0

        def finished():
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder.rstrip('/')}/{name}"], "records": [done], "bytes": [size]})

        for part in slices(batches, "payload"):
            for row in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                if stream is None:
                    name, done, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = member(*row, revisit=row[3] is not None)
                stream.write(data)
                done, size = done + 1, size + len(data)
                if size >= archive_bytes:
                    yield finished()
                    stream = None
        if stream is not None:
            yield finished()

    return written(rows.mapInArrow(run, "path string, records long, bytes long"), "warc-archives")


def number(text: str) -> int | None:
    """A decimal integer of 64 bits, None for any other text."""
    value = int(text) if INTEGER.fullmatch(text) else None
    return value if value is not None and -(1 << 63) <= value < 1 << 63 else None


def parse(record: bytes) -> dict | None:
    """Fields of an inflated record, None if it isn't a whole one or its length is no number. Page ids that are no integers are null."""
    head, gap, block = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = number(fields.get("content-length", ""))
    if length is None or not 0 <= length <= len(block):
        return None
    http, _, payload = block[:length].partition(b"\r\n\r\n")
    kind, page, refers = fields.get("warc-type", ""), fields.get("x-page-id", ""), fields.get("x-refers-to-page-id", "")
    digest, size = fields.get("warc-payload-digest", "").partition(":")[2], len(payload)
    if kind == "revisit":
        sizes = (v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")) if k.strip().lower() == "content-length")
        size = max(number(next(sizes, "")) or 0, 0)
    else:
        digest = sha1_base32(payload)
    return {
        "page_id": number(page), "url": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": number(refers), "payload": None if kind == "revisit" else payload}


class Window:
    """Bytes of a file from a moving position on, read in pieces."""

    def __init__(self, handle, size: int, piece: int = READ_BYTES):
        self.handle, self.size, self.piece, self.at, self.data = handle, size, piece, 0, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at`` on."""
        if not (self.at <= at and at + n <= self.at + len(self.data)) and at < self.size:
            self.handle.seek(at)
            self.at, self.data = at, self.handle.read(min(max(n, self.piece), self.size - at))
        return self.data[at - self.at : at - self.at + n]


def starts_record(window: Window, at: int) -> bool:
    """Do the bytes at ``at`` inflate to the version line of a record?"""
    head = window.get(at, 4096)
    if len(head) < 18 or head[:3] != MAGIC or head[3] & 0xE0:
        return False
    try:
        return zlib.decompressobj(31).decompress(head, 64).startswith(b"WARC/")
    except zlib.error:
        return False


def inflate(window: Window, at: int) -> tuple[bytes, int] | None:
    """The member that starts at ``at`` and the position behind it; None if it is broken or cut off."""
    unpack, out = zlib.decompressobj(31), []
    try:
        while not unpack.eof:
            data = window.get(at, 1 << 16)
            if not data:
                return None
            out.append(unpack.decompress(data))
            at += len(data) - len(unpack.unused_data)
    except zlib.error:
        return None
    return b"".join(out), at


def records_in(window: Window, start: int, stop: int) -> Iterator[dict]:
    """Records whose members start in [start, stop)."""
    at = start
    while at < stop:
        if not starts_record(window, at):
            step = window.get(at, 1 << 16)
            if not step:
                return
            found = step.find(MAGIC, 1)
            at += found if found >= 0 else max(1, len(step) - len(MAGIC) + 1)
            continue
        got = inflate(window, at)
        record = parse(got[0]) if got else None
        if record is None:
            at += 1
            continue
        yield record
        at = got[1]


def read(spark: SparkSession, archives: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """Records (RECORD) of the archives (path, bytes), each read by the task whose byte range its member starts in.

    Broken members are passed over. Without ``payloads`` the payload column is null and only digests and lengths leave the task.
    """
    ranges = archives.where("bytes > 0").select("path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start"))
    n = ranges.count()

    def run(batches) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start"))):
                fs, where = storage(path)
                with fs.open_input_file(where) as handle:
                    held, weight = [], 0
                    for record in records_in(Window(handle, size), start, min(start + split_bytes, size)):
                        if not payloads:
                            record["payload"] = None
                        held.append(record)
                        weight += 200 + len(record["payload"] or b"")
                        if weight > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, weight = [], 0
                    yield pa.RecordBatch.from_pylist(held, schema)

    return ranges.repartition(max(1, min(n, 100_000)), "path", "start").mapInArrow(run, RECORD)


def archived(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all pages, written to archives and read back from them.

    Rows that share the largest page_id of their payload are all responses; rows without a page_id revisit the largest id of their
    payload, or are responses if it has none. Other columns than page_id, url and html are not read; no pages give no records.
    """
    spark = pages.sparkSession
    archives = write(pages, folder or new_folder(spark, "warc"), min_bytes)
    return read(spark, archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
