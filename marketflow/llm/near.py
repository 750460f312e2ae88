"""N-gram Jaccard join with Bayesian candidate pruning.

A document is the set of its five-word shingles. Documents with one set form one text; texts whose sets
have a Jaccard similarity of 0.8 or more are linked. Candidates share a band of MinHash values. Inside a
bucket the values of two texts are compared in slices; after each slice the pair is dropped when the
posterior probability that its similarity reaches the threshold (uniform prior, binomial likelihood) is
below the tolerance. What survives is verified on the whole shingle sets, so no false link is returned. At
similarity 0.8 a link is missed with a probability of about 5e-8 by the bands and 8e-5 by the tolerance, which is
applied after each of eight slices; at 0.82 it is 2e-5, and far less above.

A bucket is cut into blocks of bounded size and every two blocks meet in one task, so a hot bucket is
spread over tasks. A pair is worked on in its first common band only, and pairs never become rows: tasks
return one row per text with its number of links and the smallest text it reaches.

Defined cases: a null or empty text has no shingles, all of these are one text without links; texts
under five words have one shingle, all their words; equal sets are one text; null ids sort last when a
document is chosen; an empty table gives an empty result; other columns, whatever their names, are
ignored by ``linked`` and carried along by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm import batches, words
from marketflow.llm.components import components
from marketflow.session import broadcast_if_small, stage

SHINGLE = 5
# Threshold as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
BANDS, BAND_VALUES = 32, 4
VALUES = BANDS * BAND_VALUES
SLICE = 16
TOLERANCE = 1e-5
# Texts of one block of a bucket.
BLOCK = 1024
# Pairs compared at a time inside a task.
PAIRS = 1 << 16

_RNG = np.random.default_rng(20240229)
_XOR = _RNG.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)
_ODD = _RNG.integers(0, 1 << 31, VALUES, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    codes = words.codes(words.split_words(words.encoded(text)))
    return np.unique(words.window_hashes(codes, min(SHINGLE, len(codes)))) if len(codes) else np.empty(0, np.uint64)


def signature(found: np.ndarray) -> np.ndarray:
    """16 bits of each MinHash value; values of an empty set are zero."""
    low = np.full(VALUES, np.iinfo(np.uint32).max, np.uint32)
    folded = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(folded), 4096):
        low = np.minimum(low, ((folded[at : at + 4096, None] ^ _XOR) * _ODD).min(axis=0))
    return (words.mixed(low.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def least_matches() -> np.ndarray:
    """Per number of slices compared, the matches below which a pair is dropped."""
    out = []
    # Two unequal values agree in 16 bits by chance.
    chance = NUMERATOR / DENOMINATOR
    chance += (1 - chance) / 65536
    for n in range(SLICE, VALUES + 1, SLICE):
        # P(similarity >= t | m of n agree) = P(Binomial(n + 1, t) <= m) under a uniform prior.
        k = np.arange(n + 2)
        log_factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 2)))])
        log_p = log_factorial[n + 1] - log_factorial[k] - log_factorial[n + 1 - k] + k * np.log(chance) + (n + 1 - k) * np.log1p(-chance)
        out.append(int(np.searchsorted(np.cumsum(np.exp(log_p)), TOLERANCE)))
    return np.array(out)


_LEAST = least_matches()


def _fingerprint(text: str | None) -> tuple:
    found = shingles(text)
    sig = signature(found)
    return xxhash.xxh3_128_hexdigest(found.tobytes()), len(found), sig.tobytes()


def _fingerprints(docs: DataFrame) -> DataFrame:
    def make(texts: list) -> list[list]:
        return [list(v) for v in zip(*map(_fingerprint, texts), strict=True)]

    return batches.with_columns(docs, "text", [("digest", "string"), ("size", "long"), ("sig", "binary")], make).drop("text")


def _band_keys(texts: DataFrame) -> DataFrame:
    """(node, band, key) of every text with shingles."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = np.tile(np.arange(BANDS, dtype=np.int32), 1)
        for part in parts:
            n = part.num_rows
            sigs = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16).reshape(n, VALUES)
            keys = np.ascontiguousarray(sigs).view(np.uint64)
            mixed = words.mixed(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            nodes = np.repeat(part.column("node").to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(np.tile(band, n)), pa.array(mixed.ravel().view(np.int64))], names=["node", "band", "key"]
            )

    return texts.where("size > 0").select("node", "sig").mapInArrow(run, "node long, band int, key long")


def _buckets(keys: DataFrame) -> DataFrame:
    """(key, p, q, band, block, node): every pair of blocks of every bucket of two texts or more."""
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = keys.join(sizes, "key")
    cut = F.ceil(F.col("members") / BLOCK).cast("int")
    met = met.select("key", "band", "node", cut.alias("cut"), F.pmod(F.xxhash64("node"), cut).cast("int").alias("block"))
    alone = met.where("cut = 1").select("key", F.lit(0).alias("p"), F.lit(0).alias("q"), "band", "block", "node")
    other = F.explode(F.sequence(F.lit(0), F.col("cut") - 1))
    many = met.where("cut > 1").select("key", "band", "block", "node", other.alias("other"))
    return alone.unionByName(
        many.select("key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "band", "block", "node")
    )


class _Members:
    """Texts of one pair of blocks."""

    def __init__(self, band: int, cross: bool, blocks: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, sigs: np.ndarray):
        self.band, self.cross, self.blocks, self.nodes, self.sizes, self.sigs = band, cross, blocks, nodes, sizes, sigs

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs first met in this band whose posterior stays above the tolerance."""
        n = len(self.nodes)
        bands = np.ascontiguousarray(self.sigs).view(np.uint64)
        firsts, seconds = [], []
        step = max(1, PAIRS // n)
        for at in range(0, n, step):
            i, j = np.meshgrid(np.arange(at, min(n, at + step)), np.arange(n), indexing="ij")
            pick = i < j
            if self.cross:
                pick &= self.blocks[i] != self.blocks[j]
            i, j = i[pick], j[pick]
            few, more = np.minimum(self.sizes[i], self.sizes[j]), np.maximum(self.sizes[i], self.sizes[j])
            near = DENOMINATOR * few >= NUMERATOR * more
            i, j = i[near], j[near]
            for band in range(self.band):
                fresh = bands[i, band] != bands[j, band]
                i, j = i[fresh], j[fresh]
            agree = np.zeros(len(i), np.int64)
            for k, least in enumerate(_LEAST):
                part = slice(k * SLICE, (k + 1) * SLICE)
                agree += (self.sigs[i, part] == self.sigs[j, part]).sum(axis=1)
                stay = agree >= least
                i, j, agree = i[stay], j[stay], agree[stay]
            firsts.append(i)
            seconds.append(j)
        return np.concatenate(firsts), np.concatenate(seconds)


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common shingles of each pair (i, j) of sets."""
    if len(i) <= 8:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], np.int64)
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    base = int((held == n).sum())
    # Shingles of one set meet nothing, those of all sets are counted once.
    useful = (held > 1) & (held < n)
    column = np.cumsum(useful) - 1
    pick = useful[place]
    owner, place = owner[pick], column[place[pick]]
    common = np.full((n, n), base, np.float32)
    width = max(256, (1 << 23) // n)
    for at in range(0, int(useful.sum()), width):
        inside = (place >= at) & (place < at + width)
        held_by = np.zeros((n, width), np.float32)
        held_by[owner[inside], place[inside] - at] = 1
        common += held_by @ held_by.T
    return common[i, j].astype(np.int64)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place each of ``n`` places reaches over the links."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        np.minimum.at(after, root[i], low)
        np.minimum.at(after, root[j], low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    return root


def _grouped(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by (key, p, q), one table per group."""
    held: list[pa.Table] = []
    last = None
    for part in parts:
        if not part.num_rows:
            continue
        table = pa.Table.from_batches([part])
        marks = np.stack([table.column(n).to_numpy() for n in ("key", "p", "q")])
        cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), table.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            mark = tuple(marks[:, a])
            if mark != last and held:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(a, b - a))
            last = mark
    if held:
        yield pa.concat_tables(held)


def _members(group: pa.Table) -> _Members:
    sigs = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint16).reshape(group.num_rows, VALUES)
    p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
    columns = (group.column(n).to_numpy() for n in ("block", "node", "size"))
    return _Members(group.column("band")[0].as_py(), p != q, *columns, sigs)


def _participants(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with at least one surviving pair."""
    waiting, rows = [], 0
    for group in _grouped(parts):
        if group.num_rows < 2:
            continue
        i, j = _members(group).candidates()
        if len(i):
            waiting.append(group.take(np.union1d(i, j)).select(["key", "p", "q", "band", "block", "node", "size", "sig"]))
            rows += waiting[-1].num_rows
        if rows > 2000:
            yield from pa.concat_tables(waiting).combine_chunks().to_batches()
            waiting, rows = [], 0
    if waiting:
        yield from pa.concat_tables(waiting).combine_chunks().to_batches()


def _verified(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, links, low) of members with a verified link."""
    out: list[tuple] = []
    for group in _grouped(parts):
        members = _members(group)
        i, j = members.candidates()
        sets = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
        common = _overlaps(sets, i, j)
        # common / (a + b - common) >= N / D
        linked = (NUMERATOR + DENOMINATOR) * common >= NUMERATOR * (members.sizes[i] + members.sizes[j])
        i, j = i[linked], j[linked]
        links = np.bincount(np.concatenate([i, j]), minlength=len(sets))
        order = np.argsort(members.nodes)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        low = members.nodes[order][_roots(len(sets), rank[i], rank[j])][rank]
        some = links > 0
        out.append((members.nodes[some], links[some], low[some]))
        if len(out) >= 500:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).astype(np.int64)) for v in zip(*out, strict=True)], names=["node", "links", "low"])


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """(digest, shingles) of rows with a text."""

    def make(bodies: list) -> list[list]:
        sets = [shingles(t).tobytes() for t in bodies]
        return [[xxhash.xxh3_128_hexdigest(s) for s in sets], sets]

    return batches.with_columns(texts.select("text"), "text", [("digest", "string"), ("shingles", "binary")], make).drop("text")


def _links(plain: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, links, low), several rows a node; ``texts`` has node, id, digest, size, sig."""
    buckets = _buckets(stage(_band_keys(texts), "bands"))
    with_sig = buckets.join(texts.select("node", "size", "sig"), "node")
    columns = "key long, p int, q int, band int, block int, node long, size long, sig binary"
    columns_in = ["key", "p", "q", "band", "block", "node", "size", "sig"]
    met = with_sig.select(columns_in).repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    found = stage(met.mapInArrow(_participants, columns), "participants")
    wanted = found.select("node").distinct().join(texts.select("node", "id", "digest"), "node")
    wanted = stage(wanted, "wanted")
    ids = broadcast_if_small(wanted.select(F.col("id").alias("wanted_id")).distinct())
    bodies = plain.join(ids, F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi")
    digests = broadcast_if_small(wanted.select("node", "digest"))
    sets = _shingle_sets(bodies).join(digests, "digest").dropDuplicates(["node"]).select("node", "shingles")
    full = found.join(sets, "node").select(*columns_in, "shingles")
    full = full.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return stage(full.mapInArrow(_verified, "node long, links long, low long"), "links")


def linked(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``.

    doc_id; class_id, the smallest id among documents it is linked with, directly or not; n_links, the
    other texts it is linked with; text_id and n_copies, the smallest id and the rows of its own text;
    mark, a hash of the text.
    """
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    prints = stage(
        _fingerprints(plain.withColumn("mark", F.xxhash64("text"))).withColumn("row", F.monotonically_increasing_id()),
        "signatures",
    )
    groups = prints.groupBy("digest").agg(F.min("row").alias("node"), F.min("id").alias("text_id"), F.count(F.lit(1)).alias("n_copies"))
    groups = stage(groups, "texts")
    firsts = broadcast_if_small(groups.where("n_copies > 1").select(F.col("node").alias("row"), "digest"))
    copies = prints.select("row", "digest").join(firsts.select("digest"), "digest", "left_semi")
    copies = copies.join(firsts.select("row"), "row", "left_anti").select("row")
    texts = prints.join(broadcast_if_small(stage(copies, "copies")), "row", "left_anti").withColumnRenamed("row", "node")
    links = _links(plain, texts)
    counts = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    roots = components(links.select(F.col("node").alias("u"), F.col("low").alias("v")))
    named = roots.join(groups.select("node", "text_id"), "node")
    names = named.groupBy("root").agg(F.min("text_id").alias("class_id"))
    known = stage(roots.join(names, "root").join(counts, "node").select("node", "class_id", "n_links"), "classes")
    told = groups.join(known, "node", "left").select(
        "digest", F.when(F.col("n_links").isNull(), F.col("text_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "text_id", "n_copies",
        F.coalesce(F.col("n_links") > 0, F.lit(False)).alias("linked"),
    )
    # Texts that stand alone are not joined.
    told = stage(told.where("linked or n_copies > 1").drop("linked"), "told")
    return prints.join(broadcast_if_small(told), "digest", "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("n_copies").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("n_copies").isNull(), F.col("id")).otherwise(F.col("text_id")).alias("text_id"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"), "mark", "digest",
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document per class: the one with the smallest id."""
    rows = stage(linked(docs, id_column, text), "linked")
    met = rows.where("n_copies > 1 or n_links > 0").withColumn("class", F.coalesce(F.col("class_id").cast("string"), F.col("digest")))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("mark"))
    best = met.groupBy("class").agg(F.min(order).alias("best"))
    judged = met.join(best, "class").select("doc_id", "mark", (order == F.col("best")).alias("stays"))
    judged = stage(judged.distinct(), "judged")
    key, mark = batches.fresh(docs, "near_id"), batches.fresh(docs, "near_mark")
    same = F.col(id_column).cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(F.col(text).cast("string")) == F.col(mark))
    told = judged.select(F.col("doc_id").alias(key), F.col("mark").alias(mark), "stays")
    stays = broadcast_if_small(told.where("stays").drop("stays"))
    alone = docs.join(broadcast_if_small(told.drop("stays")), same, "left_anti")
    return alone.unionByName(docs.join(stays, same).dropDuplicates([key, mark]).select(docs.columns))
