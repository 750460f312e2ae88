"""Web archives: records as gzip members, written by Spark's text sink and read by byte range.

Writing: of equal payloads the row with the largest page id becomes a response, the others revisit it. Every
record is one gzip member. A member ends with the high byte of its length, which is zero below 16 MiB; that
byte is written as the sink's line separator, so the file is nothing but members (a longer record is
followed by an empty member, which ends in zeros). This reaches every file system Spark can write to, under
its commit protocol.

Reading: Spark's line reader is given the gzip magic as line separator, so each task finds the magic in its
byte range and owns the candidates that start there. A candidate is a member when its header decodes and its
content begins as a record does; otherwise the magic was part of compressed data, and the bytes belong to the
member before it. Pieces that such a false magic leaves at the edges of a range are few; they are joined per file.

Defined cases: a null page is an empty payload; a null page id is smaller than any other; rows that repeat
page id and payload are all responses if theirs is the largest; control characters in an address are
escaped; records of other writers are rows of their own type, with null for what they do not say; members that cannot
be read are rows of type ``damaged`` with their bytes; an empty table gives an empty archive; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.llm.batches import bound, slices
from marketflow.session import broadcast_if_small, scratch_path, stage

MAGIC = b"\x1f\x8b\x08"
# Type of the rows for records that cannot be read, or do not have the digest or the size that they state.
DAMAGED = "damaged"
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EMPTY_MEMBER = zlib.compressobj(LEVEL, zlib.DEFLATED, 31).flush()
_RECORD = (
    "record_id string, record_type string, target_uri string, page_id long, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _address(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member that ends in a zero byte."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_address(url)}")
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()
    return out if out[-1] == 0 else out + _EMPTY_MEMBER


def write(pages: DataFrame, path: str, least_bytes: int = 0, id_column: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write one record per row of ``pages`` below ``path``."""
    bound(pages.sparkSession)
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    plain = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("html"))
    plain = plain.withColumn("key", F.when(F.octet_length("html") >= least_bytes, F.sha2("html", 256)))
    groups = plain.groupBy("key").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("rows"))
    groups = groups.where("rows > 1 and key is not null").drop("rows")
    joined = plain.join(broadcast_if_small(groups).withColumn("grouped", F.lit(True)), "key", "left")
    revisit = F.coalesce("grouped", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("response"))
    rows = joined.select("page_id", "url", "html", "response", revisit.alias("revisit"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = [c.to_pylist() for c in part.columns]
            for a, b in slices([len(h) for h in columns[2]]):
                made = [member(i, u, h.encode(), r, v)[:-1] for i, u, h, r, v in zip(*(c[a:b] for c in columns), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    # The cast relabels the bytes; the sink writes them as they are.
    members = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.option("lineSep", "\x00").option("compression", "none").text(path)


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def parse(record: bytes) -> tuple:
    """The fields of one record of any type; what it does not say is null.

    The payload is the body of an HTTP message, else the whole block; only responses and other records with a body carry it.
    One that does not have the digest it states makes the record ``damaged``, and so does a block that is cut off.
    """
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head.decode("utf-8", "replace").split("\r\n")[1:])
    size = _number(fields.get("content-length"))
    block = rest if size is None else rest[:size]
    payload, stated = block, None
    if block.startswith(b"HTTP/"):
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = _number(_fields(http.decode("latin-1").split("\r\n")[1:]).get("content-length"))
    digest = fields.get("warc-payload-digest")
    kind = fields.get("warc-type")
    name = fields.get("warc-record-id")
    whole = size is None or len(block) == size
    if kind == "revisit":
        payload = None
    elif digest and digest.lower().startswith("sha1:"):
        whole = whole and sha1_base32(payload) == digest[5:].upper()
    digest = digest[5:] if digest and digest.lower().startswith("sha1:") else digest
    refers = _page(fields.get("warc-refers-to"))
    length = stated if payload is None else len(payload)
    return name, kind if whole else DAMAGED, fields.get("warc-target-uri"), _page(name), refers, length, digest, payload


class _Reader:
    """Puts the pieces between magics together to members, in the order of one file."""

    def __init__(self):
        self.inflate = None
        self.pieces: list[bytes] = []
        self.content: list[bytes] = []

    def _feed(self, piece: bytes) -> bytes | None:
        """The finished record (empty for an empty member), or none yet; raises if the bytes are no part of one."""
        self.content.append(self.inflate.decompress(MAGIC + piece))
        begins = b"".join(self.content)[:5] if not self.content[0] else self.content[0][:5]
        if not b"WARC/".startswith(begins) or self.inflate.unused_data:
            raise zlib.error("no record")
        if not self.inflate.eof:
            return None
        self.inflate = None
        return b"".join(self.content)

    def take(self, piece: bytes) -> tuple[list[bytes], list[bytes]]:
        """Offer the bytes that follow a magic: what turned out to begin no member, and finished records."""
        lost, records, waiting = [], [], [piece]
        while waiting:
            piece = waiting.pop(0)
            if self.inflate is None:
                self.inflate, self.pieces, self.content = zlib.decompressobj(31), [], []
            self.pieces.append(piece)
            try:
                record = self._feed(piece)
            except zlib.error:
                # The first magic was none; any of those that it swallowed may begin a member.
                self.inflate = None
                lost.append(self.pieces[0])
                waiting = self.pieces[1:] + waiting
                continue
            if record:
                records.append(record)
        return lost, records

    def rest(self) -> list[bytes]:
        """The pieces of what has begun and not ended."""
        begun = [] if self.inflate is None else self.pieces
        self.inflate = None
        return begun


def _records(pieces: Iterator[tuple[str, int, bytes]]) -> Iterator[tuple]:
    """For (file, range, piece) in order: ("record", ...) and the leftovers ("piece", file, range, number, bytes)."""
    reader, place, number = _Reader(), None, 0
    for file, start, piece in pieces:
        if (file, start) != place:
            for k, left in enumerate(reader.rest()):
                yield ("piece", *place, number + k, left)
            place, number = (file, start), 0
            if start == 0 and not piece:
                continue  # what precedes the first magic of a file
        lost, records = reader.take(piece)
        # Compressed data of a member that began in an earlier range.
        for left in lost:
            yield ("piece", file, start, number, left)
            number += 1
        for record in records:
            yield ("record", record)
    for k, left in enumerate(reader.rest()):
        yield ("piece", *place, number + k, left)


def _scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces() -> Iterator[tuple[str, int, bytes]]:
        for part in parts:
            yield from zip(*(part.column(n).to_pylist() for n in ("file", "start", "piece")), strict=True)

    held, size = [], 0
    for found in _records(pieces()):
        record = parse(found[1]) if found[0] == "record" else (None,) * 8
        left = found[1:] if found[0] == "piece" else (None,) * 4
        held.append((*record, *left))
        size += len(found[-1])
        if size > 8 << 20:
            yield _scanned(held)
            held, size = [], 0
    if held:
        yield _scanned(held)


_LEFT = "file string, start long, number long, piece binary"
_KINDS = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
_NAMES = [f.split()[0] for f in f"{_RECORD}, {_LEFT}".split(", ")]


def _scanned(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*held, strict=True), _KINDS, strict=True)], names=_NAMES)


def _unread(piece: bytes) -> tuple:
    """A row for bytes after a magic that are part of no record: a damaged member, or one that the file ends in."""
    return (None, DAMAGED, None, None, None, len(MAGIC) + len(piece), None, MAGIC + piece)


def _mended(left):
    """The records of one file whose pieces lie in several byte ranges, and a row for every piece that is part of none."""
    import pandas as pd

    reader, out = _Reader(), []
    for piece in left.sort_values(["start", "number"])["piece"]:
        lost, records = reader.take(bytes(piece))
        out += [*map(_unread, lost), *map(parse, records)]
    out += map(_unread, reader.rest())
    return pd.DataFrame(out, columns=_NAMES[:8])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``: ids, type, address, payload with its size and digest (the full payload's for revisits)."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
    pieces = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("piece")
    )
    # Written once: both parts below come from one scan.
    scanned = stage(pieces.mapInArrow(_scan, f"{_RECORD}, {_LEFT}"), "records")
    whole = scanned.where("file is null").select(*_NAMES[:8])
    left = scanned.where("file is not null").select(*_NAMES[8:])
    return whole.unionByName(left.groupBy("file").applyInPandas(_mended, _RECORD))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` written to the shared folder and read back."""
    path = scratch_path(pages.sparkSession, "archive")
    write(pages, path, least_bytes)
    return read(pages.sparkSession, path)
