"""WARC archives: a writer with revisit records and a splittable reader.

The writer makes one gzip member per page. Of pages with equal payloads (of `least_bytes` at
least) the one with the largest key is a response, the others are revisits that refer to it.
Payloads are compared by two digests and their length. Each task writes a file of its own
name and reports it; only reported files belong to the archive, so a repeated task leaves no
second copy of its records in it.

The reader cuts the files into byte ranges. A task looks for gzip magic from the start of
its range, decodes the header of each candidate member to see whether it is a WARC record,
and reads all records that start inside its range, the last one beyond its end. Records of
every type are returned, also those of other writers: `page` is then the record's own id,
the digest is null where the record has none, the payload of a record without HTTP headers is
its block, and chunked transfer is undone. A payload that does not have the digest its record
states stops the job.

Files are opened by Arrow's file systems (file, hdfs, s3, gs) in the folder named by
spark.checkpoint.dir.

Defined results: a null payload is empty; a null key is smallest, and is written and read
back as null; of repeated rows with the largest key one is the response; a null URL leaves
its header out; an empty table gives an archive without records; other columns are not
read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amperine.llm.common import spread_lookup, stored
from amperine.session import scratch_path, settle

MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES = 16 << 20
CHUNK = 1 << 18
DATE = "1970-01-01T00:00:00Z"
LEAST_BYTES = 0
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = (
    "page string, record_type string, uri string, payload_bytes long, payload_digest string, "
    "refers string, file string, start long"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(data: bytes) -> bytes:
    """One gzip member in which no second WARC member can be found."""
    for strategy in (zlib.Z_DEFAULT_STRATEGY, zlib.Z_HUFFMAN_ONLY, zlib.Z_RLE):
        packer = zlib.compressobj(6, zlib.DEFLATED, 31, 9, strategy)
        out = packer.compress(data) + packer.flush()
        at = out.find(MAGIC, 1)
        while at >= 0 and not starts_record(out[at : at + CHUNK]):
            at = out.find(MAGIC, at + 1)
        if at < 0:
            return out
    raise ValueError("a payload holds a WARC member that compression does not hide")


def starts_record(data: bytes) -> bool:
    """Whether bytes that begin with gzip magic decode to the header of a WARC record."""
    if len(data) < 18 or data[3] & 0xE0:
        return False
    try:
        return zlib.decompressobj(31).decompress(data[:4096], 16).startswith(b"WARC/1.")
    except zlib.error:
        return False


def record(page: str | None, url: str | None, payload: bytes, refers: str | None, revisit: bool, digest: str) -> bytes:
    """A response record, or a revisit record whose block is the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page)}",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%:/?#[]@!$&'()*+,;=~-._|{}^`\"<>\\"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers)}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn(page: str | None) -> str:
    return "<urn:x-page:none>" if page is None else f"<urn:x-page:id:{quote(page, safe='')}>"


def _page(urn: str) -> str | None:
    from urllib.parse import unquote

    name = urn.strip("<>").removeprefix("urn:x-page:")
    return None if name == "none" else unquote(name.removeprefix("id:"))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes the archive; returns its files as a table of file, bytes and records."""
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    held = stored(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(key).cast("string").alias("page"),
        F.col(url).alias("url"), payload.alias("payload"),
        F.concat(F.sha2(payload, 256), F.sha1(payload), F.octet_length(payload).cast("string")).alias("same"),
    ))
    first = settle(
        held.filter(F.octet_length("payload") >= least_bytes).groupBy("same")
        .agg(F.max(F.struct("key", "row", "page")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    )
    # of the payloads only the digests travel to find who revisits whom
    revisits = spread_lookup(held.select("row", "same"), first, "same", "n").filter(
        F.col("first.row") != F.col("row")
    ).select("row", F.col("first.page").alias("refers"), F.lit(True).alias("revisit"))
    rows = held.join(revisits, "row", "left").select("page", "url", "payload", "refers", F.coalesce("revisit", F.lit(False)))
    folder = scratch_path(pages.sparkSession, "warc")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _open(folder)
        system.create_dir(place, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        count = 0
        with system.open_output_stream(f"{place}/{name}", compression=None) as out:
            for batch in batches:
                for at in range(len(batch)):
                    page, link, data, refers, revisit = (c[at].as_py() for c in batch.columns)
                    out.write(member(record(page, link, data, refers, revisit, payload_digest(data))))
                    count += 1
            size = out.tell()
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{name}"]), pa.array([size]), pa.array([count])], ["file", "bytes", "records"]
        )

    return settle(rows.mapInArrow(store, "file string, bytes long, records long"))


class _Window:
    """Bytes of a file by position, read a chunk at a time."""

    def __init__(self, source):
        self.source, self.size, self.at, self.data = source, source.size(), 0, b""

    def get(self, at: int, size: int) -> bytes:
        if not (self.at <= at and at + size <= self.at + len(self.data)):
            self.source.seek(at)
            self.at, self.data = at, self.source.read(max(size, CHUNK))
        return self.data[at - self.at : at - self.at + size]

    def next(self, at: int, size: int = 1 << 14) -> bytes:
        """At most `size` bytes from a position; fewer where the chunk in hand ends."""
        if not self.at <= at < self.at + len(self.data):
            return self.get(at, size)
        return self.data[at - self.at : at - self.at + size]


def members(source, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Position and content of the WARC members of a file that start in [start, end)."""
    window, at = _Window(source), start
    end = min(end, window.size)
    while at < end:
        if window.get(at, 3) != MAGIC:
            found = window.get(at, CHUNK).find(MAGIC)
            if found < 0:
                at += max(1, min(CHUNK, window.size - at) - 2)  # magic may straddle two chunks
                continue
            at += found
            if at >= end:
                return
        if not starts_record(window.get(at, 4096)):
            at += 1
            continue
        content, length = _decode(window, at)
        if content is None:
            at += 1
            continue
        yield at, content
        at += length


def _decode(window: _Window, at: int) -> tuple[bytes | None, int]:
    """Content and length of the member at a position; None if it does not decode to its end."""
    unpacker, parts, place = zlib.decompressobj(31), [], at
    while not unpacker.eof:
        data = window.next(place)
        if not data:
            return None, 0
        try:
            parts.append(unpacker.decompress(data))
        except zlib.error:
            return None, 0
        place += len(data)
    return b"".join(parts), place - len(unpacker.unused_data) - at


def parse(content: bytes) -> dict[str, str | bytes]:
    """Headers by lower-case name, and the block under an empty name."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    out: dict[str, str | bytes] = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines[1:])}
    stated = str(out.get("content-length", ""))
    length = int(stated) if stated.isdigit() else len(rest.removesuffix(b"\r\n\r\n"))
    if len(rest) < length:
        raise ValueError("a record is shorter than its header says")
    out[""] = rest[:length]
    return out


def read(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = False) -> DataFrame:
    """Records of archives from a table of file and bytes (RECORD_SCHEMA, and the payload)."""
    last = F.greatest(F.col("bytes") - 1, F.lit(0).cast("long"))
    ranges = settle(files.select(
        "file", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(range_bytes).cast("long"))).alias("start")
    ))
    tasks = max(1, ranges.count())

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                system, place = _open(path)
                rows, held = [], 0
                with system.open_input_file(place) as source:
                    for at, content in members(source, start, start + range_bytes):
                        rows.append(_row(parse(content), path, at, with_payload))
                        held += len(content) if with_payload else 200
                        if held > CHUNK * 16:
                            yield _batch(rows, with_payload)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, with_payload)

    schema = RECORD_SCHEMA + (", payload binary" if with_payload else "")
    return ranges.repartition(min(tasks, 100_000)).mapInArrow(records, schema)


def _fields(http: bytes) -> dict[str, str]:
    lines = (line.partition(b":") for line in http.split(b"\r\n")[1:])
    return {name.strip().lower().decode("latin-1"): value.strip().decode("latin-1") for name, _, value in lines}


def unchunked(body: bytes) -> bytes:
    """The content of a chunked HTTP body; a body that is not well formed stays as it is."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        digits = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        try:
            size = int(digits, 16)
        except ValueError:
            return body
        if size == 0:
            return b"".join(parts)
        if end + 2 + size > len(body):
            return body
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def _row(got: dict, path: str, at: int, with_payload: bool) -> tuple:
    kind, block = got.get("warc-type"), got[""]
    http, body, fields = b"", block, {}
    if str(got.get("content-type", "")).startswith("application/http"):
        http, _, body = block.partition(b"\r\n\r\n")
        fields = _fields(http)
    payload = unchunked(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body
    revisit = kind == "revisit"
    stated = fields.get("content-length", "")
    # a revisit record has the headers of its page and no payload
    size = len(payload) if not revisit else int(stated) if stated.isdigit() else None
    digest = got.get("warc-payload-digest")
    if digest is not None:
        algorithm, _, value = str(digest).rpartition(":")
        wrong = algorithm == "sha1" and len(value) == 32 and value not in (payload_digest(payload), payload_digest(body))
        if not revisit and kind != "request" and wrong:
            raise ValueError(f"{path} at {at}: the payload is not the one that was written")
        digest = value
    refers = got.get("warc-refers-to")
    row = (_page(str(got.get("warc-record-id", ""))), kind, got.get("warc-target-uri"), size, digest,
           _page(refers) if refers is not None else None, path, at)
    return (*row, None if revisit else payload) if with_payload else row


def _batch(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    names = ["page", "record_type", "uri", "payload_bytes", "payload_digest", "refers", "file", "start"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    if with_payload:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def round_trip(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Archive of all pages, read back: key, payload_bytes, payload_digest, record_type, refers_to."""
    kind = dict(pages.dtypes)[key]
    return read(pages.sparkSession, write(pages, key)).select(
        F.col("page").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type",
        F.col("refers").cast(kind).alias("refers_to"), "file", "start",
    )
