"""Load disciplines: (target, batch) to the target's new rows or new state.

None of them writes a table; ``marketflow.sinks`` and ``marketflow.streaming`` do.
The distinct batch is staged once in the shared folder, as a loader's staging table
would be, because its keys are measured, its keys are joined and its rows are added:
its own lineage, however long, runs once.

At scale the target is far larger than the batch, so each discipline first cuts the
target down by the batch's keys. Those keys are broadcast when their measured size
allows, and then the target is filtered in place, without a shuffle; beyond that
both sides are shuffled on the keys and adaptive execution splits the hot ones
(``left_semi`` and ``left_anti`` joins can be split on their left side).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from marketflow.functions import periods
from marketflow.session import BROADCAST_LIMIT, broadcast_if_small, bytes_of, fits_broadcast, stage

_TEMPORAL = ("date", "timestamp", "timestamp_ntz")

# Bytes a broadcast digest may take; there is at most one per batch row.
_DIGEST_BYTES = 24

# A batch above so many bytes is compared in slices, by digest; every slice reads both sides, so they are few.
_SLICE_BYTES = 512 * 1024 * 1024
_MOST_SLICES = 8


def _identity(df: DataFrame, names: Sequence[str], granularity: str) -> list[Column]:
    """Columns as compared between target and batch: temporal ones by day."""
    kinds = dict(df.dtypes)
    by_day = {n for n in names if granularity == "day" and kinds[n] in _TEMPORAL}
    return [F.to_date(n) if n in by_day else F.col(n) for n in names]


def _common_types(target: DataFrame, batch: DataFrame) -> dict[str, str]:
    """The type both sides are compared in, per batch column whose types differ."""
    theirs = dict(target.dtypes)
    common = {}
    for name, kind in batch.dtypes:
        other = theirs[name]
        if other == kind or {kind, other} <= set(_TEMPORAL):
            continue
        if "string" in (kind, other):
            raise TypeError(f"{name} is {other} in the table and {kind} in the batch")
        both = [F.lit(None).cast(k) for k in (kind, other)]
        common[name] = batch.limit(0).select(F.coalesce(*both).alias("c")).dtypes[0][1]
    return common


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both, columns matched by name."""
    return target.unionByName(batch, allowMissingColumns=True)


def union_batches(*batches: DataFrame) -> DataFrame:
    """Pages or files of one report as a single batch: one load instead of many."""
    return reduce(append, batches)


def truncate_load(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch replaces the target, repeats included; target columns are kept."""
    kinds = dict(target.dtypes)
    have = set(batch.columns)
    return batch.select(
        *[F.col(n).cast(k) if n in have else F.lit(None).cast(k).alias(n) for n, k in kinds.items()]
    )


def new_rows(
    target: DataFrame,
    batch: DataFrame,
    granularity: str = "day",
    broadcast_limit: int = BROADCAST_LIMIT,
    staged: bool = False,
) -> DataFrame:
    """Distinct batch rows that match no target row on every column.

    Nulls equal each other. With ``granularity="day"`` date and time columns are
    compared by calendar day; ``"exact"`` compares them in full. Rows of one batch
    that differ only in time of day all stay.

    Only target rows within the days of the batch are read. If the batch's 64-bit row
    digests are small they are broadcast, and of the target only rows that (nearly
    always) have a partner go on to the full comparison, which decides. Otherwise
    digests are shuffled, and rows only where digests agree, the target's repeats combined beforehand. Of a large batch
    the rows of one slice of the digests are shuffled at a time, and the slice's new rows staged.

    ``staged`` tells that the batch comes as it was read back from :func:`stage`; it is not staged once more.
    """
    return _unmatched(target, _staged(batch, staged), granularity, broadcast_limit)


def _staged(batch: DataFrame, staged: bool = False) -> DataFrame:
    """The distinct rows of a batch, staged.

    Only digests are shuffled to tell which rows may be there more than once. Where these are few they alone are
    compared, and the others of equal rows are passed over by their places in the staged files.
    """
    batch = batch if staged else stage(batch, "batch")
    names = [F.col(f"`{c}`") for c in batch.columns]
    keyed = batch.select("*", F.xxhash64(*names).alias("_digest"), F.struct("_metadata.file_path", "_metadata.row_index").alias("_place"))
    repeated = stage(keyed.groupBy("_digest").count().where("count > 1").select("_digest"), "repeated")
    if repeated.isEmpty():
        return batch
    if not fits_broadcast(repeated):
        return stage(batch.dropDuplicates(), "batch")
    some = keyed.join(F.broadcast(repeated), "_digest", "left_semi")
    places = some.groupBy("_digest", *names).agg(F.min("_place").alias("_place")).select("_place.file_path", "_place.row_index")
    places = stage(places, "places")
    if not fits_broadcast(places):
        return stage(batch.dropDuplicates(), "batch")
    again, first = repeated.select("_digest", F.lit(True).alias("_again")), places.select(F.struct("*").alias("_place"), F.lit(True).alias("_first"))
    marked = keyed.join(F.broadcast(again), "_digest", "left").join(F.broadcast(first), "_place", "left")
    return marked.where("_again is null or _first").select(*names)


def _extent(batch: DataFrame) -> Row:
    """Rows and their bytes, and per date or time column its first and last day and its nulls."""
    temporal = [n for n, k in batch.dtypes if k in _TEMPORAL]
    first = [F.min(F.to_date(n)).cast("string") for n in temporal]
    last = [F.max(F.to_date(n)).cast("string") for n in temporal]
    nulls = [F.count_if(F.col(n).isNull()) for n in temporal]
    return batch.agg(
        F.count("*").alias("rows"),
        bytes_of(batch),
        *[F.array(*found).alias(label) for label, found in (("first", first), ("last", last), ("nulls", nulls))],
    ).first()


def _within_days(target: DataFrame, batch: DataFrame, extent: Row) -> DataFrame:
    """Target rows that lie in the batch's day range in every date or time column.

    The bounds are literals, so they prune partitions and Parquet row groups.
    """
    temporal = [(n, k) for n, k in batch.dtypes if k in _TEMPORAL]
    for (name, kind), low, high, nulls in zip(temporal, extent["first"], extent["last"], extent["nulls"]):
        column = F.col(name)
        near = F.lit(False)
        if low is not None:
            after = F.date_add(F.lit(high).cast("date"), 1)
            near = (column >= F.lit(low).cast("date").cast(kind)) & (column < after.cast(kind))
        target = target.where(near | column.isNull() if nulls else near)
    return target


def _unmatched(target: DataFrame, batch: DataFrame, granularity: str, broadcast_limit: int) -> DataFrame:
    names = batch.columns
    common = _common_types(target, batch)
    # Mixed date and time columns that are compared in full are instants.
    kinds, theirs = dict(batch.dtypes), dict(target.dtypes)
    if granularity != "day":
        common |= {n: "timestamp_ntz" for n in names if kinds[n] in _TEMPORAL and theirs[n] != kinds[n]}

    # Columns that are compared by something else than their value; the others are in the key and are not kept beside it.
    changed = [n for n in names if n in common or (granularity == "day" and kinds[n] in _TEMPORAL and kinds[n] != "date")]
    rows = [F.col(n) if n in changed else F.col(f"_identity._c{i}").alias(n) for i, n in enumerate(names)]

    def keyed(df: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
        # One struct as key: its null members equal each other, and the plan stays
        # small for wide tables, unlike one null-safe comparison per column. Hashes
        # differ by type, so both sides are brought to one type first.
        parts = zip(names, _identity(df, names, granularity))
        typed = [c.cast(common[n]) if n in common else c for n, c in parts]
        identity = F.struct(*[c.alias(f"_c{i}") for i, c in enumerate(typed)])
        return df.select(*kept, identity.alias("_identity")).withColumn("_digest", F.xxhash64("_identity"))

    extent = _extent(batch)

    def unknown(fresh: DataFrame, known: DataFrame) -> DataFrame:
        # Spark knows only how small the files are.
        distinct = known.dropDuplicates() if extent["bytes"] <= broadcast_limit else known.dropDuplicates().hint("merge")
        return fresh.join(distinct, ["_digest", "_identity"], "left_anti").select(*rows)

    fresh = keyed(batch, changed)
    known = keyed(_within_days(target, batch, extent))
    if extent["rows"] * _DIGEST_BYTES <= broadcast_limit:
        digests = fresh.select("_digest").distinct()
        return unknown(fresh, known.join(F.broadcast(digests), "_digest", "left_semi"))
    # Digests of both sides meet first; rows whose digest the target lacks are new and are not shuffled.
    met = fresh.select("_digest").join(known.select("_digest").distinct().hint("merge"), "_digest", "left_semi").distinct()
    met = stage(met, "digests")
    if met.isEmpty():
        return batch
    if fits_broadcast(met, broadcast_limit):
        new = fresh.join(F.broadcast(met), "_digest", "left_anti").select(*rows)
        fresh, known = (df.join(F.broadcast(met), "_digest", "left_semi") for df in (fresh, known))
        return new.unionByName(unknown(fresh, known))
    slices = min(_MOST_SLICES, -(-extent["bytes"] // _SLICE_BYTES))
    if slices < 2:
        return unknown(fresh, known)
    # The shuffles of a slice go when its new rows are staged.
    slice_of = F.pmod("_digest", F.lit(slices))
    return reduce(DataFrame.unionByName, [stage(unknown(fresh.where(slice_of == i), known.where(slice_of == i)), "new") for i in range(slices)])


def insert_if_new(
    target: DataFrame,
    batch: DataFrame,
    granularity: str = "day",
    broadcast_limit: int = BROADCAST_LIMIT,
    staged: bool = False,
) -> DataFrame:
    """Target plus the batch rows it does not have yet. Replaying a batch adds nothing."""
    return append(target, new_rows(target, batch, granularity, broadcast_limit, staged))


def without_keys(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Target rows whose key does not occur in the batch; null keys never match."""
    parts = _identity(batch, keys, "day")
    slots = [f"_k{i}" for i in range(len(keys))]
    taken = batch.select(*[c.alias(s) for c, s in zip(parts, slots)]).dropna().distinct()
    taken = broadcast_if_small(taken, broadcast_limit)
    same = [c == taken[s] for c, s in zip(_identity(target, keys, "day"), slots)]
    return target.join(taken, reduce(lambda a, b: a & b, same), "left_anti")


def keyed_replace(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    broadcast_limit: int = BROADCAST_LIMIT,
    staged: bool = False,
) -> DataFrame:
    """Delete target rows whose key is in the batch, then add the whole distinct batch.

    Date keys match by day. Several batch rows of one key all survive.
    """
    fresh = _staged(batch, staged)
    return append(without_keys(target, fresh, keys, broadcast_limit), fresh)


def null_key_rows(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many batch rows can never be replaced, because a key part is null."""
    unkeyed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return batch.agg(F.count_if(unkeyed).alias("null_key_rows"))


def month_replace(target: DataFrame, batch: DataFrame, date_column: str, staged: bool = False) -> DataFrame:
    """Replace the calendar months that occur in the batch.

    No remaining target row can equal a dated batch row, so only rows without a
    date need the insert-if-new comparison.
    """
    column = F.col(date_column)
    fresh = _staged(batch, staged)
    months = broadcast_if_small(fresh.select(F.trunc(column, "MM").alias("_month")).dropna().distinct())
    kept = target.join(months, F.trunc(target[date_column], "MM") == months["_month"], "left_anti")
    undated = _unmatched(target.where(column.isNull()), fresh.where(column.isNull()), "day", BROADCAST_LIMIT)
    return append(append(kept, fresh.where(column.isNotNull())), undated)


def calendar_month_replace(target: DataFrame, batch: DataFrame, date_column: str, ref_date) -> DataFrame:
    """Replace the calendar month of ``ref_date``, then insert the new batch rows.

    The bounds are plain column comparisons, so a target partitioned or sorted by
    date is pruned.
    """
    first = F.trunc(periods.ref(ref_date), "MM").cast("timestamp_ntz")
    following = F.trunc(F.add_months(periods.ref(ref_date), 1), "MM").cast("timestamp_ntz")
    column = F.col(date_column)
    kept = target.where(column.isNull() | (column < first) | (column >= following))
    return insert_if_new(kept, batch)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    order: Sequence[str],
    mutable: Sequence[str],
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """One row per key: first values of all columns, last values of the mutable ones.

    ``target`` has one row per key, as a primary key sees to; ``order`` must order the batch rows of a key
    uniquely. A target row counts as older than any batch row. Target rows of other keys pass as they are, neither
    shuffled nor sorted; the others meet the batch in an aggregate that combines before the shuffle, so a key with
    very many changes is no hot spot. Null keys equal each other.
    """
    names = target.columns
    first = [n for n in names if n not in mutable and n != key]
    rank = F.struct(F.lit(1).alias("_batch"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    none = F.struct(
        F.lit(0).alias("_batch"),
        *[F.lit(None).cast(dict(batch.dtypes)[o]).alias(f"_o{i}") for i, o in enumerate(order)],
    )
    batch = stage(batch, "batch")
    changed = broadcast_if_small(batch.select(F.col(key).alias("_key")).distinct(), broadcast_limit)
    same = target[key].eqNullSafe(changed["_key"])
    tagged = target.join(changed, same, "left_semi").select("*", none.alias("_rank")).unionByName(batch.select(*names, rank.alias("_rank")))
    return target.join(changed, same, "left_anti").unionByName(_first_and_last(tagged, key, first, mutable, names))


def key_bucket(key: Column | str, buckets: int) -> Column:
    """The bucket of a key, by its hash; tables of state are partitioned by it."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def upsert_log(log: DataFrame, key: str, order: Sequence[str], mutable: Sequence[str]) -> DataFrame:
    """The state an append-only log of upserts adds up to."""
    first = [n for n in log.columns if n not in mutable and n != key]
    tagged = log.withColumn("_rank", F.struct(*order))
    return _first_and_last(tagged, key, first, mutable, log.columns)


def _first_and_last(
    tagged: DataFrame, key: str, first: Sequence[str], mutable: Sequence[str], names: Sequence[str]
) -> DataFrame:
    packed = tagged.groupBy(key).agg(
        F.min_by(F.struct(F.lit(0).alias("_"), *first), "_rank").alias("_first"),
        F.max_by(F.struct(F.lit(0).alias("_"), *mutable), "_rank").alias("_last"),
    )
    pick = {n: F.col(f"_first.`{n}`") for n in first} | {n: F.col(f"_last.`{n}`") for n in mutable}
    return packed.select(*[F.col(key) if n == key else pick[n].alias(n) for n in names])
