"""Exact duplicates against immutable snapshots, screened by static binary-fuse filters.

Texts are equal when they are identical without blanks (space and the characters 9 to 13). Of equal texts
the row with the most code points in its original text stays, then the one with the smallest id.

A snapshot is frozen once: its exact buckets (one row per digest) and, per shard of the digests, one
filter. Arriving digests are first grouped among themselves, then probed shard by shard. Only positives
join the exact buckets. Every group of two rows or more is then checked byte by byte; digests that stand
for different texts are grouped again by the texts themselves.

Defined cases: a null text counts as empty, empty texts equal each other; null ids sort last; of rows
that repeat id and text one is kept; an empty table gives an empty result; other columns, whatever their
names, are carried along by ``keep_first`` and ignored by ``duplicates``.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm import batches, fuse
from marketflow.session import broadcast_if_small, stage

# Digests of one filter, on average. The least number of shards spreads small tables over tasks.
SHARD_KEYS = 200_000
LEAST_SHARDS = 64

_BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    """The text without blanks; null is empty. Six plain replacements copy faster than one pattern."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for blank in _BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _first(chars: str = "chars", row_id: str = "id") -> Column:
    """Sorts the row that stays to the front."""
    return F.struct(
        (-F.col(chars)).alias("less"), F.col(row_id).isNull().alias("unnamed"), F.col(row_id).alias("id")
    )


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min(_first()).alias("best"), F.count(F.lit(1)).alias("rows"))


@dataclass(frozen=True)
class Snapshot:
    """Exact buckets and filters of documents that no longer change."""

    buckets: DataFrame
    filters: DataFrame
    shards: int


def freeze(rows: DataFrame, expected: int) -> Snapshot:
    """The snapshot of keyed rows (id, chars, digest), for ``expected`` distinct digests or fewer on either side."""
    shards = max(LEAST_SHARDS, -(-expected // SHARD_KEYS))
    buckets = stage(_grouped(rows), "buckets")

    def built(shard: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [shard[0]], "filter": [fuse.build(part["key"].to_numpy("int64").view("uint64"))]})

    keys = buckets.select(_shard(shards).alias("shard"), F.xxhash64("digest").alias("key"))
    filters = keys.groupBy("shard").applyInPandas(built, "shard int, filter binary")
    return Snapshot(buckets, stage(filters, "filters"), shards)


def screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """``groups`` (one row per digest) whose digest the snapshot may hold."""

    def probed(shard: tuple, part: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(held):
            return part[["digest"]].iloc[:0]
        return part[["digest"]][fuse.probe(held["filter"].iloc[0], part["key"].to_numpy("int64").view("uint64"))]

    keys = groups.select("digest", F.xxhash64("digest").alias("key"), _shard(snapshot.shards).alias("shard"))
    return keys.groupBy("shard").cogroup(snapshot.filters.groupBy("shard")).applyInPandas(probed, "digest string")


def _merged(arriving: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Groups of two rows or more over the snapshot and the arriving rows, by digest."""
    new = stage(_grouped(arriving), "arriving")
    positive = screen(new, snapshot).select("digest")
    old = snapshot.buckets.select("digest", F.col("best").alias("old_best"), F.col("rows").alias("old_rows"))
    both = stage(new.join(positive, "digest").join(old, "digest"), "positives")
    met = both.select("digest", F.least("best", "old_best").alias("best"), (F.col("rows") + F.col("old_rows")).alias("rows"))
    alone = snapshot.buckets.where("rows > 1").unionByName(new.where("rows > 1"))
    return met.unionByName(alone.join(broadcast_if_small(both.select("digest")), "digest", "left_anti"))


def _keyed_columns(id_column: str, text: str) -> list[Column]:
    chars = F.coalesce(F.char_length(F.col(text)), F.lit(0)).cast("long")
    return [F.col(id_column).alias("id"), chars.alias("chars"), digest(F.col(text)).alias("digest")]


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(*_keyed_columns(id_column, text))


def _groups(docs: DataFrame, keyed: DataFrame, arrives: Column, text: str) -> tuple[DataFrame, bool]:
    """Groups of two rows or more, checked by bytes; whether some digest stands for several texts (then ``body`` tells them apart)."""
    snapshot = freeze(keyed.where(~arrives), keyed.count())
    groups = stage(_merged(keyed.where(arrives), snapshot), "groups")
    texts = docs.select(digest(F.col(text)).alias("digest"), normalised(F.col(text)).alias("body"))
    suspects = texts.join(broadcast_if_small(groups.select("digest")), "digest", "left_semi")
    differing = (
        suspects.groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high"))
        .where("low <> high").select("digest")
    )
    differing = stage(differing, "collisions")
    if differing.isEmpty():
        return groups, False
    few = broadcast_if_small(differing)
    bodies = docs.select(*_keyed_columns("id", text), normalised(F.col(text)).alias("body")).join(few, "digest", "left_semi")
    apart = bodies.groupBy("digest", "body").agg(F.min(_first()).alias("best"), F.count(F.lit(1)).alias("rows"))
    sure = groups.join(few, "digest", "left_anti").withColumn("body", F.lit(None).cast("string"))
    return stage(sure.unionByName(apart), "groups"), True


def default_split() -> Column:
    """Which keyed rows arrive, when the caller names no snapshot: half of them, by the hash of the id."""
    return F.pmod(F.xxhash64("id"), F.lit(2)) == 1


def duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", arrives: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``arrives`` is a condition over ``id``: rows for which it is false form the snapshot.
    """
    plain = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    arrives = F.coalesce(default_split() if arrives is None else arrives, F.lit(True))
    keyed = stage(_keyed(plain, "id", "text").withColumn("row", F.monotonically_increasing_id()), "keyed")
    groups, apart = _groups(plain, keyed, arrives, "text")
    size = broadcast_if_small(groups.select(F.col("digest").alias("of"), "best", "rows", *["body"] * apart))
    if apart:
        rows = plain.select(*_keyed_columns("id", "text"), normalised(F.col("text")).alias("text"))
        rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "bodies")
        on = (F.col("digest") == F.col("of")) & F.coalesce(F.col("body") == F.col("text"), F.col("body").isNull())
    else:
        rows, on = keyed, F.col("digest") == F.col("of")
    joined = rows.join(size, on, "left")
    front = F.col("best").isNull() | (F.col("best.id").eqNullSafe(F.col("id")) & (-F.col("best.less") == F.col("chars")))
    judged = joined.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("rows", F.lit(1).cast("long")).alias("group_size"), front.alias("front"), "row",
        F.col("best").isNotNull().alias("grouped"), F.col("digest").alias("text_sha256"),
    )
    # Rows that repeat id and text share the front; the first of them is kept. Only fronts are compared.
    judged = stage(judged, "judged")
    one = judged.where("front and grouped").groupBy("doc_id", "text_sha256").agg(F.min("row").alias("first"))
    one = broadcast_if_small(one.where("first is not null").select(F.col("first").alias("row"), F.lit(True).alias("one")))
    return judged.join(one, "row", "left").select(
        "doc_id", "keep_id", "group_size",
        (F.col("front") & (~F.col("grouped") | F.coalesce("one", F.lit(False)))).alias("kept"), "text_sha256",
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", text: str = "text", arrives: Column | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged."""
    plain = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    arrives = F.coalesce(default_split() if arrives is None else arrives, F.lit(True))
    keyed = stage(_keyed(plain, "id", "text"), "keyed")
    groups, apart = _groups(plain, keyed, arrives, "text")
    mark, best, less, body = (batches.fresh(docs, n) for n in ("digest", "best", "less", "body"))
    # Flat columns, so that their size can be measured and texts stay where they are.
    told = groups.select(
        F.col("digest").alias(mark), F.col("best.id").alias(best), F.col("best.less").alias(less), *[F.col("body").alias(body)] * apart
    )
    size = broadcast_if_small(told)
    own = batches.fresh(docs, "own_digest")
    rows = docs.withColumn(own, digest(F.col(text)))
    on = F.col(own) == F.col(mark)
    if apart:
        on = on & (F.col(body).isNull() | (F.col(body) == normalised(F.col(text))))
    joined = rows.join(size, on, "left")
    chars = F.coalesce(F.char_length(F.col(text)), F.lit(0)).cast("long")
    front = F.col(best).eqNullSafe(F.col(id_column)) & (-F.col(less) == chars)
    single = joined.where(F.col(mark).isNull()).select(docs.columns)
    # Rows that repeat the best id with as many characters share the front, whatever their blanks; one of a group stays.
    shared = joined.where(F.col(mark).isNotNull() & front)
    if apart:
        whole = batches.fresh(docs, "whole_text")
        shared = shared.withColumn(whole, normalised(F.col(text))).dropDuplicates([own, whole])
    else:
        shared = shared.dropDuplicates([own])
    return single.unionByName(shared.select(docs.columns))
