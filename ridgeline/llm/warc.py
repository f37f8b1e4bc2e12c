"""WARC archives: one gzip member per record, written by tasks and read in byte ranges.

Writing: of rows with equal payloads one is a response, the others revisit it and
carry no payload. Each task writes files of bounded size into a folder that all
executors share; a name is taken over only when its file is complete, and the
records of a failed attempt stay under a name that nobody reads.

Reading: a file is cut into byte ranges, each a row that any task can take. A task
looks for the gzip magic in its range, proves a candidate by inflating it to the
end of a WARC header block, and owns the records that start inside the range. It
reads beyond the range to finish its last record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.runtime import materialize
from ridgeline.sources.planned import deal_by_bytes

# A new file is begun beyond this many bytes, and a range to read is as long.
FILE_BYTES = 256 << 20
RANGE_BYTES = 16 << 20
_CHUNK = 1 << 20
_LEVEL = 3
_EPOCH = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    """Bare base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """One row per row: ``(page_id, url, payload, digest, length, refers_to, revisit)``.

    Payloads are the UTF-8 bytes of the column, null is empty. Of the rows whose
    payload has at least ``min_bytes`` and is equal, one with the largest id is
    the response; the others revisit it and have a null payload here. A payload
    travels once for each distinct value, whatever the copies.

    Rows repeating id and payload are one response and revisits of it. Null ids are
    the smallest; a response without an id leaves ``refers_to`` null. A null url
    stays null. An empty table gives no rows.
    """
    given = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    )
    sized = given.select("*", F.sha1("payload").alias("sha"), F.octet_length("payload").cast("long").alias("length"))
    small = sized.where(F.col("length") < min_bytes).select(
        "page_id", "url", "payload", "sha", "length", F.lit(None).cast("long").alias("refers_to"), F.lit(False).alias("revisit")
    )
    large = sized.where(F.col("length") >= min_bytes)
    # The url of a response is the smallest among rows of its id, so that a repeated task picks the same.
    order = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", F.col("url").isNotNull().alias("has"), "url")
    best = large.groupBy("sha", "length").agg(F.max(order).alias("best"), F.max("payload").alias("payload"))
    best = materialize(best.select("sha", "length", F.col("best.page_id").alias("best_id"), F.col("best.url").alias("best_url"), "payload"), "warc-responses")
    responses = best.select(
        F.col("best_id").alias("page_id"), F.col("best_url").alias("url"), "payload", "sha", "length",
        F.lit(None).cast("long").alias("refers_to"), F.lit(False).alias("revisit"),
    )
    # Rows that agree in all but their number are counted, and one of the response's goes.
    counted = materialize(large.groupBy("sha", "length", "page_id", "url").agg(F.count("*").alias("n")), "warc-rows")
    joined = counted.join(best.drop("payload").withColumnRenamed("length", "best_length"), "sha")
    own = F.col("page_id").eqNullSafe(F.col("best_id")) & F.col("url").eqNullSafe(F.col("best_url"))
    copies = joined.where(F.col("length") == F.col("best_length")).withColumn("n", F.col("n") - F.when(own, 1).otherwise(0)).where("n > 0")
    revisits = copies.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")).select(
        "page_id", "url", F.lit(None).cast("binary").alias("payload"), "sha", "length",
        F.col("best_id").alias("refers_to"), F.lit(True).alias("revisit"),
    )
    records = responses.unionByName(revisits)
    return records.unionByName(small) if min_bytes > 0 else records


def _header(fields: list[tuple[str, str | None]]) -> bytes:
    lines = [b"WARC/1.0"]
    for name, value in fields:
        if value is not None:
            # A header value is one line; anything below space is escaped as in a url.
            clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value) if name == "WARC-Target-URI" else value
            lines.append(f"{name}: {clean}".encode())
    return b"\r\n".join(lines) + b"\r\n\r\n"


def _record_id(page_id: int | None, sha: str, copy: int | str) -> str:
    """A response is named by its page and payload alone, so that revisits can name it too."""
    return f"<urn:page:{'' if page_id is None else page_id}:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{sha}:{copy}')}>"


def record_member(page_id: int | None, url: str | None, payload: bytes | None, sha: str, length: int, refers_to: int | None, revisit: bool, copy: int | str = 0) -> bytes:
    """A record as a gzip member of its own."""
    block = _HTTP + (b"" if revisit else payload or b"")
    head = _header([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, sha, copy)),
        ("WARC-Date", _EPOCH),
        ("WARC-Target-URI", url),
        ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", _record_id(refers_to, sha, 0) if revisit else None),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(sha)).decode()}"),
        ("WARC-Payload-Length", str(length)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ])
    deflate = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return deflate.compress(head + block + b"\r\n\r\n") + deflate.flush()


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the records of :func:`plan_records` and returns ``(path, length, records)`` per file.

    ``folder`` is a URI that every executor can write to. What is returned names
    the files of the attempts that succeeded, so a repeated task adds nothing.
    """

    def run(batches):
        store, root = FileSystem.from_uri(folder)
        out, name, size, count, seen = None, None, 0, 0, 0

        def close():
            out.close()
            store.move(f"{root}/{name}.part", f"{root}/{name}")
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "length": [size], "records": [count]})

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                if out is None:
                    store.create_dir(root, recursive=True)
                    name, size, count = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}.part")
                seen += 1
                member = record_member(*row, copy=f"{name}:{seen}" if row[-1] else 0)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    columns = records.select("page_id", "url", "payload", "sha", "length", "refers_to", "revisit")
    return materialize(columns.mapInArrow(run, "path string, length long, records long"), "warc-files")


class _Window:
    """Bytes of a file from a place on, fetched in chunks and forgotten behind ``drop``."""

    def __init__(self, source, size: int, start: int):
        self.source, self.size, self.at, self.held = source, size, start, b""

    def more(self) -> bool:
        end = self.at + len(self.held)
        if end >= self.size:
            return False
        self.source.seek(end)
        new = self.source.read(min(_CHUNK, self.size - end))
        self.held += new
        return bool(new)

    def drop(self, to: int) -> None:
        self.held, self.at = self.held[to - self.at :], to


def _inflate(window: _Window, start: int, headers_only: bool) -> tuple[bytes, int] | None:
    """The member at ``start`` (up to its header block, if so asked) and where it ends; None if it is none."""
    inflate, parts, at, length = zlib.decompressobj(31), [], start, 0
    while True:
        while at >= window.at + len(window.held):
            if not window.more():
                return None
        try:
            chunk = window.held[at - window.at : at - window.at + (4096 if headers_only else _CHUNK)]
            data = inflate.decompress(chunk)
        except zlib.error:
            return None
        at += len(chunk) - len(inflate.unused_data)
        parts.append(data)
        length += len(data)
        if headers_only or length < 64:
            head = b"".join(parts)
            if not head.startswith(b"WARC/1."[: len(head)]):
                return None
            if headers_only and b"\r\n\r\n" in head:
                return head, at
        if inflate.eof:
            return (b"".join(parts), at) if length and not headers_only else None


_MAGIC = b"\x1f\x8b\x08"


def members(source, size: int, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Places and contents of the records that start from ``start`` to before ``end``."""
    window = _Window(source, size, start)
    at = start
    while at < end:
        place = window.held.find(_MAGIC, at - window.at)
        if place < 0:
            at = max(at, window.at + len(window.held) - len(_MAGIC) + 1)
            if at >= end or not window.more():
                return
            window.drop(min(at, window.at + len(window.held)))
            continue
        at = window.at + place
        if at >= end:
            return
        found = _inflate(window, at, True) and _inflate(window, at, False)
        if found is None:
            at += 1
            continue
        yield at, found[0]
        at = found[1]
        window.drop(at)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields in lower case, and the block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, rest[: int(fields.get("content-length") or 0)]


def ranges(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, length, start, end)`` for files ``(path, length)``."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    cut = files.select("path", "length", starts.alias("start"))
    return cut.withColumn("end", F.least(F.col("start") + range_bytes, F.col("length")))


def read_archives(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """One row per record: place, type, ids, url, digests, and the payload if wanted.

    ``digest_ok`` tells whether a payload has the digest its header names (null
    for revisits, which carry none). Records without a numeric page id have null.
    """
    cut = ranges(spark, files, range_bytes)
    # Rows of a few bytes stand for ranges of many: they are dealt by the bytes to be read.
    dealt = deal_by_bytes(cut.withColumn("bytes", F.col("end") - F.col("start")), "bytes", ["path", "start"], range_bytes).drop("bytes")

    def run(batches):
        def number(record_id: str | None) -> int | None:
            found = re.match(r"<urn:page:(-?\d+):", record_id or "")
            return int(found[1]) if found else None

        for batch in batches:
            for path, size, start, end in zip(*[c.to_pylist() for c in batch.columns]):
                store, name = FileSystem.from_uri(path)
                with store.open_input_file(name) as source:
                    rows = []
                    held = 0
                    for at, data in members(source, size, start, end):
                        fields, block = parse_record(data)
                        revisit = fields.get("warc-type") == "revisit"
                        payload = block.partition(b"\r\n\r\n")[2]
                        named = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        rows.append((
                            path, at, fields.get("warc-type"), number(fields.get("warc-record-id")), fields.get("warc-target-uri"),
                            number(fields.get("warc-refers-to")), int(fields.get("warc-payload-length") or len(payload)) if revisit else len(payload),
                            named, None if revisit else payload_digest(payload) == named, payload if payloads and not revisit else None,
                        ))
                        held += len(payload) if payloads else 64
                        if held >= 4 * _CHUNK or len(rows) >= 10_000:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    return dealt.mapInArrow(run, _RECORD)


_RECORD = (
    "path string, offset long, record_type string, page_id long, url string, refers_to long, "
    "payload_bytes long, payload_digest string, digest_ok boolean, payload binary"
)
_RECORD_ARROW = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()),
    ("payload", pa.binary()),
])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD_ARROW)], schema=_RECORD_ARROW)
