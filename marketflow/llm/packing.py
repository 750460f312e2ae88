"""Packing documents into token sequences by cutting-stock column generation.

Every document becomes its token ids and an end id. Long documents are cut into full sequences; what
remains is shorter than a sequence. The histogram of these lengths, at most one row per length, decides
the rest: a linear program chooses how often each pattern (a multiset of length classes that fits) is
used, and a knapsack by dynamic programming finds the pattern that improves it most, until the bound it
gives shows the plan to be near its optimum. Whole multiples of the patterns are given to documents by their
rank within their class; the few remaining documents, at most the items of one pattern per class, are
placed best fit, the longest first. Only the histogram and the plan pass through the driver, and their size does not
depend on the number of documents.

Defined cases: a null or empty text is the end id alone; equal lengths are ranked by a hash of the row;
rows that repeat are packed each; an empty table gives an empty result; other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.batches import bound, slices
from marketflow.llm.tokens import encoder
from marketflow.session import stage

CAPACITY = 2048
END_ID = 1
# Tokens of one length class; a class counts with its largest length.
CLASS_WIDTH = 8
# The plan may use this share more sequences than the linear program's lower bound.
GAP = 5e-4
# Rows of one length are ranked in this many parts at least.
RANK_PARTS = 64
RANK_ROWS = 100_000


def pieces(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): documents cut at multiples of ``capacity``."""
    bound(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, pattern).encode
        for part in parts:
            ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for a, b in slices([len(t or "") for t in texts]):
                out = []
                for row, text in zip(ids[a:b], texts[a:b], strict=True):
                    raw = encode(text) + end
                    for at in range(0, len(raw), 4 * capacity):
                        cut = raw[at : at + 4 * capacity]
                        out.append((row, at // 4, len(cut) // 4, zlib.crc32(cut), len(raw) // 4, *[cut] * keep_ids))
                kinds = [pa.int64()] * 5 + [pa.binary()] * keep_ids
                columns = [pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names)
    return docs.mapInArrow(run, schema)


def best_pattern(worth: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The multiset of items of most worth that fits into ``room``: its worth and the count of each item."""
    value = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    useful = np.flatnonzero(worth > 1e-12)
    size, gain = sizes[useful], worth[useful]
    for r in range(1, room + 1):
        fit = np.searchsorted(size, r, side="right")
        value[r], choice[r] = value[r - 1], -1
        if fit:
            options = value[r - size[:fit]] + gain[:fit]
            k = int(options.argmax())
            if options[k] > value[r] + 1e-12:
                value[r], choice[r] = options[k], k
    counts, r = np.zeros(len(sizes), np.int64), room
    while r > 0:
        if choice[r] < 0:
            r -= 1
        else:
            counts[useful[choice[r]]] += 1
            r -= size[choice[r]]
    return float(value[room]), counts


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray, float]:
    """Patterns (one per row) and how often each is used, near the optimum of the linear program; and its lower bound.

    ``sizes`` ascend. The basis starts with patterns of one item kind each. Besides patterns there are free
    columns: an item may take the place of the next larger one, and a place may stay empty. They keep the
    prices in the order of the sizes, which settles the program many times sooner.
    """
    m = len(sizes)
    columns = np.diag(room // sizes).astype(np.float64)
    costs = np.ones(m)
    inverse = np.diag(1.0 / np.diag(columns))
    used = inverse @ demand
    bound = float(sizes @ demand) / room
    while True:
        prices = costs @ inverse
        falls = prices[:-1] - prices[1:]
        entering, cost = np.zeros(m), 0.0
        if m > 1 and falls.max() > max(1e-9, -prices.min()):
            k = int(falls.argmax())
            entering[k], entering[k + 1] = 1, -1
        elif prices.min() < -1e-9:
            entering[int(prices.argmin())] = -1
        else:
            worth, counts = best_pattern(prices, sizes, room)
            total = float(costs @ used)
            bound = max(bound, float(prices @ demand) / max(worth, 1.0))
            if worth <= 1 + 1e-9 or total - bound <= max(0.5, gap * total):
                break
            entering, cost = counts.astype(np.float64), 1.0
        direction = inverse @ entering
        steps = np.where(direction > 1e-9, used / np.where(direction > 1e-9, direction, 1.0), np.inf)
        leaves = int(steps.argmin())
        if not np.isfinite(steps[leaves]):
            break
        used = used - steps[leaves] * direction
        used[leaves] = steps[leaves]
        columns[leaves], costs[leaves] = entering, cost
        row = inverse[leaves] / direction[leaves]
        inverse -= np.outer(direction, row)
        inverse[leaves] = row
    return columns[costs > 0], np.maximum(used[costs > 0], 0.0), bound


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each length, the longest first, each into the fullest bin that has room."""
    order = sorted(range(len(lengths)), key=lambda k: -lengths[k])
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = np.zeros(capacity + 1, bool)
    out, bins = [0] * len(lengths), 0
    for k in order:
        at = lengths[k] + int(some[lengths[k] :].argmax())
        if some[at]:
            chosen = room[at].pop()
            some[at] = bool(room[at])
        else:
            chosen, at, bins = bins, capacity, bins + 1
        room[at - lengths[k]].append(chosen)
        some[at - lengths[k]] = True
        out[k] = chosen
    return out


@dataclass
class Plan:
    """Which ranks of which class go to which sequence.

    Slot k holds the ranks of class ``kind[k]`` from ``first[k]`` on; with ``each[k]`` places a sequence, of
    which ``shift[k]`` are taken before.
    """

    kind: np.ndarray
    first: np.ndarray
    each: np.ndarray
    shift: np.ndarray
    sequence: np.ndarray
    sequences: int

    def assign(self, kind: np.ndarray, rank: np.ndarray) -> np.ndarray:
        slot = np.searchsorted(self._keys(self.kind, self.first), self._keys(kind, rank), side="right") - 1
        return self.sequence[slot] + (rank - self.first[slot] + self.shift[slot]) // self.each[slot]

    @staticmethod
    def _keys(kind: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return (kind.astype(np.int64) << 48) + rank


def plan(histogram: dict[int, int], capacity: int = CAPACITY, width: int = CLASS_WIDTH) -> Plan:
    """The plan for a histogram of lengths below ``capacity``."""
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    kinds = -(-lengths // width)
    sizes = np.unique(kinds)
    demand = np.array([counts[kinds == s].sum() for s in sizes], np.int64)
    places: list[list[list[int]]] = [[] for _ in sizes]
    sequences = 0
    if len(sizes):
        patterns, used, _ = column_generation(sizes, demand.astype(np.float64), capacity // width)
        for pattern, times in zip(patterns.astype(np.int64), np.floor(used + 1e-9).astype(np.int64).tolist(), strict=True):
            for k in np.flatnonzero(pattern) if times else ():
                places[k].append([int(times * pattern[k]), int(pattern[k]), 0, sequences])
            sequences += times
    slots: list[tuple[int, int, int, int, int]] = []
    left: list[tuple[int, int, int]] = []
    free: list[list[int]] = []
    # The largest first: what is free among larger places takes the rest of a class.
    for k in range(len(sizes) - 1, -1, -1):
        size, rank = int(sizes[k]), 0
        free = places[k][::-1] + free if demand[k] else free + places[k]
        while free and rank < demand[k]:
            room, each, shift, sequence = free[0]
            taken = int(min(room, demand[k] - rank))
            slots.append((size, rank, each, shift, sequence))
            rank += taken
            if taken == room:
                free.pop(0)
            else:
                free[0] = [room - taken, each, shift + taken, sequence]
        mine = kinds == size
        ranks = np.arange(rank, demand[k])
        own = lengths[mine][np.searchsorted(np.cumsum(counts[mine]), ranks, side="right")]
        left += [(size, r, n) for r, n in zip(ranks.tolist(), own.tolist(), strict=True)]
    bins = best_fit([n for _, _, n in left], capacity)
    slots += [(size, rank, 1, 0, sequences + b) for (size, rank, _), b in zip(left, bins, strict=True)]
    sequences += max(bins, default=-1) + 1
    slots.sort()
    columns = [np.array(v, np.int64) for v in zip(*slots, strict=True)] if slots else [np.zeros(0, np.int64)] * 5
    return Plan(*columns, sequences)


def _ranked(rest: DataFrame, rows: int, width: int) -> DataFrame:
    """``rest`` with its length class ``kind`` and its ``rank`` there, by length."""
    parts = max(RANK_PARTS, rows // RANK_ROWS)
    kind = F.ceil(F.col("length") / width).cast("long")
    dealt = rest.withColumn("kind", kind).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    sizes = dealt.groupBy("kind", "length", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("kind").orderBy("length", "part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    place = F.row_number().over(Window.partitionBy("kind", "length", "part").orderBy("row"))
    return dealt.withColumn("place", place).join(sizes, ["kind", "length", "part"]).withColumn("rank", F.col("base") + F.col("place") - 1)


def pack(
    docs: DataFrame, tokenizer: str, pattern: str, id_column: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for."""
    plain = docs.select(F.col(id_column).cast("long"), F.col(text).cast("string"))
    cut = pieces(plain, tokenizer, pattern, capacity, end_id, keep_ids).withColumn("row", F.monotonically_increasing_id())
    cut = stage(cut, "pieces")
    columns = [c for c in cut.columns if c not in ("row", "ids")] + ["sequence_id", "offset"] + ["ids"] * keep_ids
    histogram = {r["length"]: r["n"] for r in cut.where(F.col("length") < capacity).groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    made = plan(histogram, capacity)
    full = cut.where(F.col("length") >= capacity)
    full = full.withColumn("sequence_id", F.col("row") + made.sequences).withColumn("offset", F.lit(0).cast("long"))

    def assigned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            kind, rank = (part.column(n).to_numpy(zero_copy_only=False) for n in ("kind", "rank"))
            yield part.append_column("sequence_id", pa.array(made.assign(kind, rank)))

    ranked = _ranked(cut.where(F.col("length") < capacity).drop("ids"), sum(histogram.values()), CLASS_WIDTH)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row", "kind", "rank"]
    schema = ", ".join(f"{n} long" for n in [*names, "sequence_id"])
    placed = ranked.select(*names).mapInArrow(assigned, schema).drop("kind", "rank")
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))
    if keep_ids:
        placed = placed.join(cut.select("row", "ids"), "row")
    return full.select(columns).unionByName(placed.select(columns))


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """(sequence_id, tokens, ids): the pieces of ``pack(..., keep_ids=True)`` joined in order and padded, unless they fill a power of two."""
    one = packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    pad = np.array([pad_id], "<u4").tobytes()
    whole = F.col("tokens").bitwiseAND(F.col("tokens") - 1) == 0
    missing = F.when(whole, F.lit(0)).otherwise(capacity - F.col("tokens")).cast("int")

    @F.pandas_udf("binary")
    def joined(parts, short):
        return parts.__class__([b"".join(bytes(p["ids"]) for p in row) + pad * n for row, n in zip(parts, short, strict=True)], dtype=object)

    return one.select("sequence_id", "tokens", joined("parts", missing).alias("ids"))
