"""Duplicate passages by a hash join on minimizer anchors.

Every document is cut into blocks: a block is a run of windows (50 consecutive words) that
share one anchor, the smallest 8-word hash inside the window. Equal passages are therefore cut at the
same places in every document, and blocks are joined by their anchor: an anchor whose block is the same
wherever it occurs is taken as a whole from the smallest document that has it. The windows of blocks that
differ under one anchor are joined one by one by their hash, so that a passage ends exactly where the
repeated words end. The words of repeated windows are removed from every document but the smallest. This
replaces relative Lempel-Ziv parsing: no factor is searched or extended.

Only anchors (about one in 22 words) are shuffled for all documents; windows only around boundaries, and
texts only of documents with a shared anchor.

Defined cases: a null or empty text has no words; documents under 50 words lose nothing; rows with a null
id lose nothing and take nothing from others; rows that repeat an id do not take from each other;
an empty table gives an empty result; other columns, whatever their names, are ignored by ``removals``
and carried along by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm import batches, words
from marketflow.session import broadcast_if_small, stage

WINDOW = 50
GRAM = 8
_SPAN = WINDOW - GRAM + 1
_WORD_AND_BLANKS = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    count, span, low = len(values) - width + 1, 1, values
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[:count], low[width - span : width - span + count])


def blocks(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor and hash of every window, and the first window of every block; all empty below 50 words."""
    windows = words.window_hashes(codes, WINDOW)
    if not len(windows):
        return windows, windows, np.empty(0, np.int64)
    anchors = sliding_min(words.window_hashes(codes, GRAM), _SPAN)
    return anchors, windows, np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])


def block_hashes(windows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One hash per block over its windows in order."""
    place = np.arange(len(windows)) - np.repeat(starts, np.diff(np.r_[starts, len(windows)]))
    return np.add.reduceat(words.mixed(windows + place.astype(np.uint64)), starts)


def _fingerprint(text: str | None) -> tuple:
    found = words.split_words(words.encoded(text))
    anchors, windows, starts = blocks(words.codes(found))
    pairs = np.empty((0, 2), np.uint64)
    if len(starts):
        pairs = np.unique(np.stack([anchors[starts], block_hashes(windows, starts)], axis=1), axis=0)
    digest = hashlib.sha256(b" ".join(found)).hexdigest()
    return len(found), digest, pairs[:, 0].view(np.int64), pairs[:, 1].view(np.int64)


def _fingerprints(docs: DataFrame) -> DataFrame:
    """id, n_words, digest of the words, and the distinct (anchor, block) pairs as two arrays."""

    def make(texts: list) -> list[list]:
        return [list(v) for v in zip(*map(_fingerprint, texts), strict=True)]

    added = [("n_words", "long"), ("digest", "string"), ("anchors", "array<long>"), ("blocks", "array<long>")]
    return batches.with_columns(docs, "text", added, make).drop("text")


def _marks(prints: DataFrame) -> DataFrame:
    """Per id, the anchors whose only block an earlier document has, and those whose blocks differ."""
    pairs = prints.where(F.col("id").isNotNull()).select("id", F.explode(F.arrays_zip("anchors", "blocks")).alias("p"))
    pairs = pairs.select("id", F.col("p.anchors").alias("anchor"), F.col("p.blocks").alias("block"))
    shared = pairs.groupBy("anchor").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), (F.min("block") == F.max("block")).alias("whole")
    )
    shared = shared.where("first < last").drop("last")
    met = pairs.select("id", "anchor").join(shared, "anchor").where("not whole or id > first")
    return met.groupBy("id").agg(
        F.collect_set(F.when(F.col("whole"), F.col("anchor"))).alias("copied"),
        F.collect_set(F.when(~F.col("whole"), F.col("anchor"))).alias("differing"),
    )


def _within(values: np.ndarray, wanted: list | None) -> np.ndarray:
    if not wanted:
        return np.zeros(len(values), bool)
    return np.isin(values, np.array(wanted, np.int64).view(np.uint64))


def _boundary_windows(docs: DataFrame) -> DataFrame:
    """(id, window): the windows of blocks that differ under one anchor. ``docs`` has id, text, differing."""

    def run(parts):
        import pyarrow as pa

        for part in parts:
            ids, texts, wanted = (part.column(n).to_pylist() for n in ("id", "text", "differing"))
            for row, text, anchors_wanted in zip(ids, texts, wanted, strict=True):
                anchors, windows, _ = blocks(words.codes(words.split_words(words.encoded(text))))
                hit = np.unique(windows[_within(anchors, anchors_wanted)]).view(np.int64)
                if len(hit):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), row)), pa.array(hit)], names=["id", "window"])

    return docs.select("id", "text", "differing").mapInArrow(run, "id long, window long")


def _affected(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of ``docs`` (with ``id``) that share an anchor, and their marks. Unaffected texts are not shuffled while the ids fit."""
    return docs.join(broadcast_if_small(marks.select("id")), "id", "left_semi").join(marks, "id")


def repeated(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For rows (id, text): their fingerprints; and per id what it repeats (anchors ``copied``, hashes ``windows``)."""
    prints = stage(_fingerprints(docs), "fingerprints")
    marks = stage(_marks(prints), "marks")
    texts = _affected(docs, marks.where(F.size("differing") > 0))
    found = stage(_boundary_windows(texts), "windows")
    first = found.groupBy("window").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    later = found.join(first.drop("last"), "window").where("id > first")
    by_id = later.groupBy("id").agg(F.collect_set("window").alias("windows"))
    whole = marks.select("id", "copied").join(by_id, "id", "left")
    return prints, stage(whole.where("size(copied) > 0 or windows is not null"), "repeats")


def covered_words(codes: np.ndarray, copied: list | None, window_set: list | None) -> np.ndarray:
    """Which words lie in a window of a copied block or in a copied window."""
    anchors, windows, _ = blocks(codes)
    starts = np.flatnonzero(_within(anchors, copied) | _within(windows, window_set))
    return words.covered(starts, WINDOW, len(codes))


def _cut(raw: bytes, copied: list | None, window_set: list | None) -> tuple[list[bytes], np.ndarray]:
    found = words.split_words(raw)
    return found, covered_words(words.codes(found), copied, window_set)


def removals(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    prints, repeats = repeated(plain)

    def run(parts):
        import pyarrow as pa

        for part in parts:
            out = []
            for row, body, copied, windows in zip(*(c.to_pylist() for c in part.columns), strict=True):
                found, gone = _cut(words.encoded(body), copied, windows)
                kept = b" ".join(w for w, g in zip(found, gone.tolist(), strict=True) if not g)
                before = hashlib.sha256(b" ".join(found)).hexdigest()
                out.append((row, before, int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*out, strict=True)], names=["id", "digest", "n_removed", "kept"])

    texts = _affected(plain, repeats).select("id", "text", "copied", "windows")
    changed = texts.mapInArrow(run, "id long, digest string, n_removed long, kept string").distinct()
    changed = broadcast_if_small(stage(changed, "removals"))
    return prints.join(changed, ["id", "digest"], "left").select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept", "digest").alias("kept_sha256"),
    )


def _shortened(text: str | None, copied: list | None, window_set: list | None) -> str | None:
    found, gone = _cut(words.encoded(text), copied, window_set)
    if not gone.any():
        return text
    pieces = _WORD_AND_BLANKS.findall(text)
    return "".join(p for p, g in zip(pieces, gone.tolist(), strict=True) if not g).strip(words.BLANKS.decode())


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text; untouched texts stay as they are, no row is dropped."""
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    _, repeats = repeated(plain)
    key, copied, windows = (batches.fresh(docs, n) for n in ("repeat_id", "copied", "windows"))
    told = repeats.select(F.col("id").alias(key), F.col("copied").alias(copied), F.col("windows").alias(windows))
    ids = broadcast_if_small(told.select(key))
    same = F.col(id_column).cast("long") == F.col(key)
    rest = docs.join(ids, same, "left_anti")
    touched = docs.join(ids, same, "left_semi").join(told, same)

    @F.pandas_udf("string")
    def shortened(texts, copied_sets, window_sets):
        cut = [
            _shortened(t, None if c is None else list(c), None if w is None else list(w))
            for t, c, w in zip(texts, copied_sets, window_sets, strict=True)
        ]
        return texts.__class__(cut, index=texts.index, dtype=object)

    changed = shortened(F.col(text).cast("string"), F.col(copied), F.col(windows))
    return rest.unionByName(touched.withColumn(text, changed).select(docs.columns))
