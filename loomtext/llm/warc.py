"""Web archives: records as gzip members, and a reader that splits the files by byte ranges.

A reading task owns the records that start inside its range. It looks for the gzip magic, takes a
place for a member only if its first bytes decode to a WARC header, and may read past the end of its
range to finish its last record. Payloads that occur more than once are stored once; their other
records are revisits that name it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm.common import attempt, batches, doc_bytes, filesystem, lookup, stored

# Fixed values of the formats.
VERSION = b"WARC/1.1\r\n"
MAGIC = b"\x1f\x8b\x08"

RANGE_BYTES = 8 << 20  # what a reading task looks for record starts in
FILE_BYTES = 256 << 20  # a writing task begins a new file beyond this
MAX_READERS = 10_000
CHUNK = 1 << 16
PROBE = 512

FILES = pa.schema([("path", pa.string()), ("n_bytes", pa.int64())])
RECORDS = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])
RECORDS_DDL = ("record_id string, record_type string, uri string, refers_to string, payload_digest string, "
               "payload_bytes long, payload binary")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def header(fields: list[tuple[str, str]]) -> bytes:
    return VERSION + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"


def clean(value: str) -> str:
    """A header value is one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def member(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as one gzip member; a revisit has no block."""
    block = b"" if refers_to is not None else payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{record_id}>"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("X-Payload-Length", str(len(payload))),
    ]
    if uri is not None:
        fields.append(("WARC-Target-URI", clean(uri)))
    if refers_to is not None:
        fields.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    fields.append(("Content-Length", str(len(block))))
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(header(fields)) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def response_of(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Payloads that occur more than once: `_digest`, and `_id` and `_row` of the record that holds the payload."""
    keys = rows.select("_digest", "_id", "_n", "_row")
    best = F.max(F.struct("_id", "_row")).alias("_best")
    many = keys.where(F.col("_n") >= min_bytes).groupBy("_digest").agg(best, F.count(F.lit(1)).alias("_m"))
    return many.where("_m > 1").select("_digest", F.col("_best._id").alias("_first"), F.col("_best._row").alias("_first_row"))


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", uri: str = "url", payload: str = "html",
               min_bytes: int = 0) -> DataFrame:
    """Write one record per row below `folder`; returns the stored list of files (path, n_bytes).

    Of records with equal payloads of at least `min_bytes` bytes the one with the largest id holds
    the payload and the others are revisits of it. A null payload is empty. A null id is smaller than
    any other and written as `null`; of rows that share id and payload the last one read is the
    response. `pages` is read once: its rows are numbered and written, as a later scan may be split
    otherwise. Other columns are not read.
    """
    body = doc_bytes(F.col(payload))
    rows = stored(pages.select(
        F.col(page_id).alias("_id"), F.col(uri).cast("string").alias("_uri"), body.alias("_body"), F.length(body).alias("_n"),
        F.sha1(body).alias("_digest"), F.monotonically_increasing_id().alias("_row"),
    ), "warc-rows")
    repeated = stored(response_of(rows, min_bytes), "warc-repeated")
    found = lookup(rows, repeated, "_digest", "_row")
    other = F.col("_first_row").isNotNull() & (F.col("_n") >= min_bytes) & (F.col("_first_row") != F.col("_row"))
    text_id = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    records = found.select(text_id("_id").alias("id"), F.col("_uri").alias("uri"), F.col("_body").alias("body"),
                           F.when(other, text_id("_first")).alias("refers_to"))

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        stem, files, out, size = attempt(), [], None, 0
        for batch in it:
            for i in range(batch.num_rows):
                if out is None:
                    name = f"pages-{stem}-{len(files):04d}.warc.gz"
                    out, size = fs.open_output_stream(f"{root}/{name}", compression=None), 0
                got = member(*[batch.column(c)[i].as_py() for c in ("id", "uri", "body", "refers_to")])
                out.write(got)
                size += len(got)
                if size >= FILE_BYTES:
                    out.close()
                    files.append({"path": f"{folder}/{name}", "n_bytes": size})
                    out = None
        if out is not None:
            out.close()
            files.append({"path": f"{folder}/{name}", "n_bytes": size})
        yield from batches(files, FILES)

    return stored(records.mapInArrow(write, "path string, n_bytes long"), "warc-files")


class Window:
    """A growing piece of a file, read forward in chunks; bytes before `low` are let go."""

    def __init__(self, f, start: int, size: int):
        self.f, self.low, self.size, self.buf = f, start, size, b""

    def upto(self, end: int) -> None:
        want = min(end, self.size) - (self.low + len(self.buf))
        if want > 0:
            self.buf += self.f.read_at(max(want, min(CHUNK, self.size - self.low - len(self.buf))), self.low + len(self.buf))

    def drop(self, pos: int) -> None:
        self.buf, self.low = self.buf[max(0, pos - self.low):], max(pos, self.low)

    def find(self, what: bytes, pos: int, end: int) -> int:
        """First place at or after `pos` and before `end`, -1 if none."""
        while pos < end:
            self.drop(pos)
            self.upto(pos + CHUNK)
            at = self.buf.find(what)
            if at >= 0:
                return self.low + at if self.low + at < end else -1
            pos = max(pos + 1, self.low + len(self.buf) - len(what) + 1)
            if self.low + len(self.buf) >= self.size:
                return -1
        return -1


def is_record(window: Window, pos: int) -> bool:
    """Whether a gzip member that decodes to a WARC header starts at `pos`."""
    window.upto(pos + PROBE)
    data = window.buf[pos - window.low : pos - window.low + PROBE]
    if len(data) < 18 or data[3] & 0xE0:
        return False
    try:
        return zlib.decompressobj(31).decompress(data, 16).startswith(b"WARC/")
    except zlib.error:
        return False


def decode(window: Window, pos: int) -> tuple[bytes, int]:
    """The member at `pos`, and where it ends."""
    z, out, at = zlib.decompressobj(31), [], pos
    while not z.eof:
        window.upto(at + CHUNK)
        data = window.buf[at - window.low : at - window.low + CHUNK]
        if not data:
            raise EOFError(f"a gzip member is cut off at {at}")
        out.append(z.decompress(data))
        at += len(data) - len(z.unused_data)
    return b"".join(out), at


def urn(value: str | None) -> str | None:
    return value.removeprefix("<urn:page:").removesuffix(">") if value is not None else None


def parse(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")[1:]
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    body = rest[: int(fields["content-length"])]
    if fields["warc-type"] == "response":  # what is reported is what was read
        digest, size = base32_sha1(body), len(body)
    else:
        digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
    return {
        "record_id": urn(fields["warc-record-id"]), "record_type": fields["warc-type"], "uri": fields.get("warc-target-uri"),
        "refers_to": urn(fields.get("warc-refers-to")), "payload_digest": digest, "payload_bytes": size, "payload": body,
    }


def records_in(path: str, size: int, start: int, end: int) -> Iterator[dict]:
    """The records that start in [start, end)."""
    fs, p = filesystem(path)
    with fs.open_input_file(p) as f:
        window, pos = Window(f, start, size), start
        while (pos := window.find(MAGIC, pos, end)) >= 0:
            if is_record(window, pos):
                data, pos = decode(window, pos)
                yield parse(data)
            else:
                pos += 1


def read_warc(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the files (path, n_bytes), one task per group of byte ranges.

    A revisit has an empty payload; its digest and length are those of the payload it refers to. No
    files, or empty ones, give no records.
    """
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.where("n_bytes > 0").select("path", "n_bytes", at.alias("start"))
    ranges = ranges.repartition(min(MAX_READERS, max(1, ranges.count())), "path", "start")  # a few bytes each: never merged

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for r in batch.to_pylist():
                rows, held = [], 0
                for record in records_in(r["path"], r["n_bytes"], r["start"], min(r["start"] + range_bytes, r["n_bytes"])):
                    rows.append(record)
                    held += len(record["payload"])
                    if held > 4 << 20:
                        yield from batches(rows, RECORDS)
                        rows, held = [], 0
                yield from batches(rows, RECORDS)

    return ranges.mapInArrow(read, RECORDS_DDL)
