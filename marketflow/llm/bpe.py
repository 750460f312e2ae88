"""Byte-level BPE by a global shuffle of distinct words.

Texts are cut into pre-tokens. A chunk of documents numbers its distinct pre-tokens (words) and keeps, per
document, the numbers in order: these are the positions. The distinct words of all chunks are shuffled by
their hash, every distinct word is encoded once in its hash bucket, and the ids are joined back to the
chunks, where the numbers put them into place. Words travel in one row per chunk and bucket, so that
neither a frequent word nor its positions pile up anywhere; the positions are written once, bucketed by
chunk, and do not move again. Decoding looks every id up in the table of
token bytes, whose size is that of the vocabulary.

Defined cases: a null or empty text has no ids; strings of special tokens are ordinary text; rows that
repeat are encoded each; an empty table gives an empty result; other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.batches import bound, slices
from marketflow.llm.tokens import SPACE
from marketflow.session import scratch_path

# Buckets the distinct words are dealt into.
BUCKETS = 128
# Characters after which a chunk ends.
CHUNK_CHARS = 6 << 20
# Words a bucket remembers before it starts its table anew.
TABLE_WORDS = 1_000_000


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids: one line per token, base64 and a number."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def splitter(pattern: str) -> regex.Pattern:
    r"""The pre-token pattern with white space as Unicode defines it (``\s`` also takes control characters here)."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))


def _packed(codes: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    return zstandard.compress(np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def _unpacked(raw: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8) if count else np.empty(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(4, count).T).view("<u4").ravel()


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _joined(words: list[bytes]) -> bytes:
    """Words as one compressed string, their sizes first."""
    sizes = np.array([len(w) for w in words], "<u4").tobytes()
    return zstandard.compress(len(words).to_bytes(4, "little") + sizes + b"".join(words), 3)


def _split(raw: bytes) -> list[str]:
    plain = zstandard.decompress(raw)
    count = int.from_bytes(plain[:4], "little")
    text = plain[4 + 4 * count :]
    ends = np.cumsum(np.frombuffer(plain, "<u4", count, 4)).tolist()
    return [text[a:b].decode() for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _counted(counts: np.ndarray) -> bytes:
    return len(counts).to_bytes(4, "little") + _packed(counts)


def _counts(raw: bytes) -> np.ndarray:
    return _unpacked(raw[4:], int.from_bytes(raw[:4], "little")).astype(np.int64)


_CHUNK = "chunk long, bucket int, words binary, doc_ids array<long>, sizes array<int>, codes binary"


def _chunks(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """Per chunk, one row per bucket with its distinct words in order, and one row with the documents."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = splitter(pattern).findall
        names = ["chunk", "bucket", "words", "doc_ids", "sizes", "codes"]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        chunk = TaskContext.get().partitionId() << 32
        table, codes, rows, size = _Numbers(), [], [], 0

        def made() -> pa.RecordBatch:
            words = [w.encode() for w in table]
            dealt = [xxhash.xxh3_64_intdigest(w) % buckets for w in words]
            order = sorted(range(len(words)), key=lambda k: (dealt[k], words[k]))
            number = np.empty(len(order), np.uint32)
            number[order] = np.arange(len(order), dtype=np.uint32)
            out = [(chunk, -1, None, rows, [len(c) for c in codes], _packed(number[np.concatenate(codes)]))]
            held, first = np.unique([dealt[k] for k in order], return_index=True)
            edges = [*first.tolist(), len(order)]
            for k, i, j in zip(held.tolist(), edges[:-1], edges[1:], strict=True):
                out.append((chunk, int(k), _joined([words[w] for w in order[i:j]]), None, None, None))
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for part in parts:
            for row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                found = find(text) if text else []
                codes.append(np.fromiter(map(table.__getitem__, found), np.uint32, len(found)))
                rows.append(row)
                size += len(text or "")
                if size >= CHUNK_CHARS:
                    yield made()
                    chunk += 1
                    table, codes, rows, size = _Numbers(), [], [], 0
        if rows:
            yield made()

    return docs.mapInArrow(run, _CHUNK)


_CORES: dict[tuple[str, str], tiktoken.Encoding] = {}


def core(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of this process; loaded once."""
    if (path, pattern) not in _CORES:
        _CORES[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})
    return _CORES[path, pattern]


def _encoded_words(words: DataFrame, path: str, pattern: str) -> DataFrame:
    """(chunk, bucket, counts, ids): the ids of the words of each row, one after another."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A word is one piece already; the pattern is not applied to it again.
        encode = core(path, pattern)._encode_single_piece
        table: dict[str, list[int]] = {}
        last = None
        for part in parts:
            counts, ids = [], []
            for bucket, found in zip(part.column("bucket").to_pylist(), part.column("words").to_pylist(), strict=True):
                if bucket != last or len(table) > TABLE_WORDS:
                    table, last = {}, bucket
                mine = []
                for word in _split(found):
                    got = table.get(word)
                    if got is None:
                        got = table[word] = encode(word.encode())
                    mine.append(got)
                counts.append(_counted(np.array([len(m) for m in mine], np.uint32)))
                ids.append(_packed(np.array([i for m in mine for i in m], np.uint32)))
            columns = [part.column("chunk"), part.column("bucket"), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "bucket", "counts", "ids"])

    dealt = words.select("chunk", "bucket", "words").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "chunk long, bucket int, counts binary, ids binary")


def gathered(codes: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The ids of words given by number; ``counts`` and ``ids`` list the words in the order of their numbers."""
    starts = np.cumsum(counts) - counts
    many = counts[codes]
    ends = np.cumsum(many)
    if not len(ends):
        return np.empty(0, "<u4")
    return ids[np.repeat(starts[codes] - (ends - many), many) + np.arange(int(ends[-1]))]


def _reassembled(chunks: DataFrame) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(part.num_rows):
                row = part.slice(at, 1)
                doc_ids, sizes = (row.column(n).to_pylist()[0] for n in ("doc_ids", "sizes"))
                words = sorted(row.column("words").to_pylist()[0] or [], key=lambda w: w["bucket"])
                counts = [_counts(w["counts"]) for w in words]
                ids = [_unpacked(w["ids"], int(c.sum())) for w, c in zip(words, counts, strict=True)]
                counts = np.concatenate(counts) if counts else np.empty(0, np.int64)
                ids = np.concatenate(ids) if ids else np.empty(0, "<u4")
                codes = _unpacked(row.column("codes")[0].as_py(), sum(sizes))
                out, start = [], 0
                for size in sizes:
                    out.append(gathered(codes[start : start + size], counts, ids).astype("<u4").tobytes())
                    start += size
                for a, b in slices([len(o) for o in out]):
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids[a:b], pa.int64()), pa.array(out[a:b], pa.binary())], names=["doc_id", "ids"])

    return chunks.mapInArrow(run, "doc_id long, ids binary")


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """doc_id and ``ids``, little-endian unsigned 32-bit integers, of every row."""
    bound(docs.sparkSession)
    plain = docs.select(F.col(id_column).cast("long"), F.col(text).cast("string"))
    chunks = _bucketed(_chunks(plain, pattern, buckets))
    words = _encoded_words(chunks.where("bucket >= 0"), path, pattern)
    by_chunk = words.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "counts", "ids")).alias("words"))
    bodies = chunks.where("bucket < 0").select("chunk", "doc_ids", "sizes", "codes")
    return _reassembled(bodies.join(by_chunk, "chunk", "left"))


def _bucketed(chunks: DataFrame) -> DataFrame:
    """``chunks`` written once, as a table in the shared folder that is bucketed by chunk, so that the join back moves only ids."""
    spark = chunks.sparkSession
    name = f"marketflow_chunks_{uuid.uuid4().hex}"
    writer = chunks.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk")
    writer.option("path", scratch_path(spark, "chunks")).saveAsTable(name)
    return spark.read.table(name)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the bytes its ids stand for."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {i: token for token, i in ranks(path).items()}
        for part in parts:
            raw = part.column("ids").to_pylist()
            for a, b in slices([len(r) for r in raw]):
                text = [b"".join(map(table.__getitem__, np.frombuffer(r, "<u4").tolist())) for r in raw[a:b]]
                some = part.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(text, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
