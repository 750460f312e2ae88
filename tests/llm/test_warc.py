import gzip
import hashlib
import os
import zlib

import pytest

from marketflow.llm import warc

ROWS = [
    (1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u r\nl", "<p>x</p>"), (4, "u", ""), (5, "u", None), (None, "u", "<p>x</p>"),
    (6, "u", "ü" * 200_000), (7, "u", "alone"), (9, "u", "twice"), (9, "u", "twice"),
]


@pytest.mark.parametrize("split", ["128m", "512"])
@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, folder, split, least):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
        path = f"{folder}/archive"
        warc.write(pages, path, least)
        got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read(spark, path).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = []
    for i, _, h in ROWS:
        body = (h or "").encode()
        top = max((j for j, _, g in ROWS if (g or "") == (h or "") and j is not None), default=None)
        first = i == top or len(body) < least
        want.append((i, len(body), warc.sha1_base32(body), "response" if first else "revisit", None if first else top))
    assert got == sorted(want, key=repr)
    members = b"".join(open(f"{path}/{f}", "rb").read() for f in os.listdir(path) if f.startswith("part"))
    assert gzip.decompress(members).count(b"WARC/1.1\r\n") == len(ROWS)


def stored(page_id, payload):
    """A record whose compressed form holds its payload as it is."""
    plain = gzip.decompress(warc.member(page_id, "u", payload, None, False))
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    return packer.compress(plain) + packer.flush()


@pytest.mark.parametrize("split", ["128m", "700", "64"])
def test_magic_inside_compressed_data(spark, folder, split):
    payloads = [b"a" * k + warc.MAGIC + b"\x00" * 9 + warc.MAGIC * 3 + bytes([k]) * 300 for k in range(1, 25)]
    with open(f"{folder}/part-0", "wb") as f:
        f.write(b"".join(stored(k, p) for k, p in enumerate(payloads)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r["page_id"]: (r["payload_digest"], bytes(r["payload"])) for r in warc.read(spark, folder).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {k: (warc.sha1_base32(p), p) for k, p in enumerate(payloads)}


def test_long_records_and_damage():
    payload = hashlib.sha512(b"x").hexdigest().encode() * 140_000
    raw = warc.member(1, "u", payload, None, False)
    assert raw[-1] == 0 and gzip.decompress(raw).endswith(payload + b"\r\n\r\n")
    record = gzip.decompress(warc.member(1, "u", b"good", None, False))
    assert warc.parse(record)[1] == "response"
    assert warc.parse(record.replace(b"good", b"evil"))[1] == warc.DAMAGED and warc.parse(record[:-6])[1] == warc.DAMAGED


FOREIGN = [
    b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/\r\nContent-Length: 24\r\n\r\nHTTP/1.0 200 OK\r\n\r\nbody!\r\n\r\n",
    b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:uuid:1>\r\n\r\nno length",
    b"WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Payload-Digest: md5:abc\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
]


@pytest.mark.parametrize("split", ["128m", "200"])
def test_archives_of_other_writers(spark, folder, split):
    cut = gzip.compress(FOREIGN[0] * 9)[:-20]
    broken = warc.MAGIC + b"no gzip at all " * 20
    with open(f"{folder}/part-0", "wb") as f:
        f.write(b"".join(map(gzip.compress, FOREIGN[:2])) + broken + b"".join(map(gzip.compress, FOREIGN[2:])) + cut)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = warc.read(spark, folder).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    found = {r["record_type"]: (r["target_uri"], r["payload_bytes"], r["payload_digest"], r["payload"] and bytes(r["payload"])) for r in got}
    assert found.pop(warc.DAMAGED)[3].startswith(warc.MAGIC)
    assert found == {
        "warcinfo": (None, 5, None, b"hello"), "response": ("http://x/", 5, None, b"body!"),
        "metadata": (None, 9, None, b"no length"), "revisit": (None, None, "md5:abc", None),
    }
    assert sum(r["record_type"] == warc.DAMAGED for r in got) == 2


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string, payload string")).count() == 0
