"""Arriving report files through the batch load disciplines.

Each micro-batch is committed to a :class:`~marketflow.streaming.store.Store` under its id, so a repeated one adds
nothing: with the source's checkpoint that makes every load exactly-once, also when executors or the driver are lost
half way. Stores fold themselves when their tail grows long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketflow.operators import load, lookups, messages
from marketflow.session import broadcast_if_small
from marketflow.streaming.store import SEED, SEQUENCE, Store

def arrivals(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_format: str = "parquet",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """A stream over the files that land in a folder."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def run_available(
    stream: DataFrame,
    checkpoint: str,
    each: Callable[[DataFrame, int], None],
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Process what has arrived, then stop; the checkpoint remembers it.

    With ``every``, such as ``"10 minutes"``, the query goes on looking for files and is
    returned running.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger)
    query = writer.foreachBatch(each).start()
    if not every:
        query.awaitTermination()
    return query


def delivery_name(checkpoint: str) -> str:
    """The name of a stream in its store: streams with a checkpoint of their own number their micro-batches from zero."""
    return "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def seed(initial: DataFrame, path: str, day: str | None = None) -> None:
    """Start a store with what the table already holds (possibly nothing)."""
    _store(initial.sparkSession, path, initial.schema, day).append(lambda state: initial, SEED, -1)


def _store(spark: SparkSession, path: str, schema: T.StructType, day: str | None = None) -> Store:
    """A store partitioned by ``day``, by default its first date or time column."""
    temporal = [f.name for f in schema.fields if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")]
    return Store(spark, path, schema, day or next(iter(temporal), None))


def rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a store."""
    return _store(spark, path, schema).read().drop(SEQUENCE)


def ingest_new(
    stream: DataFrame, path: str, checkpoint: str, granularity: str = "day", delivery: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Insert-if-new for every micro-batch, against all earlier ones; only files with its days are opened.

    Every stream writes under its own ``delivery`` name, by default that of its
    checkpoint. With ``every`` the query goes on and is returned running; so it is for
    all ingests.
    """
    store = _store(stream.sparkSession, path, stream.schema)
    delivery = delivery or delivery_name(checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        days = None
        if store.day:
            day = F.to_date(store.day)
            low, high, undated = batch.agg(F.min(day).cast("string"), F.max(day).cast("string"), F.count_if(day.isNull())).first()
            # Rows without a day are always read, so a batch of nothing else needs no other.
            days = (low, high) if low else ("9999-12-31", "0001-01-01")

        def fresh(state: dict) -> DataFrame:
            earlier = store.read(state, days).drop(SEQUENCE)
            return load.new_rows(earlier, batch, granularity)

        store.append(fresh, delivery, batch_id)
        store.compact_if_long()

    return run_available(stream, checkpoint, each, every=every)


def log_into(store: Store, delivery: str, prepare: Callable[[DataFrame], DataFrame], fold=None) -> Callable[[DataFrame, int], None]:
    """What a stream does with each micro-batch: append it, prepared, and fold the store when it has grown long."""

    def each(batch: DataFrame, batch_id: int) -> None:
        store.append(lambda state: prepare(batch), delivery, batch_id)
        store.compact_if_long(fold)

    return each


def ingest_restated(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = (), delivery: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Keyed replace by log: the store keeps every micro-batch, readers see the last.

    A restated key costs one small write now and nothing is rewritten; see
    :func:`restated_rows`. With ``keys``, rows that were replaced go when the store is folded; without, they stay.
    """
    store = _store(stream.sparkSession, path, stream.schema)
    fold = (lambda df: _current(df, keys)) if keys else None
    each = log_into(store, delivery or delivery_name(checkpoint), DataFrame.dropDuplicates, fold)
    return run_available(stream, checkpoint, each, every=every)


def restated_rows(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Rows of the last micro-batch of each key, of whichever stream; rows with a null key all stay.

    The last batch of every restated key is one small row, combined before the
    shuffle; date and time keys count by day.
    """
    return _current(_store(spark, path, schema).read(), keys).drop(SEQUENCE)


def _current(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    temporal = ("date", "timestamp", "timestamp_ntz")
    kinds = dict(stored.dtypes)
    parts = {f"_k{i}": F.to_date(k) if kinds[k] in temporal else F.col(k) for i, k in enumerate(keys)}
    keyed = stored.select("*", *[c.alias(n) for n, c in parts.items()])
    restated = keyed.where(F.col(SEQUENCE) > 0).dropna(subset=list(parts))
    newest = restated.groupBy(*parts).agg(F.max(SEQUENCE).alias("_newest"))
    joined = keyed.join(broadcast_if_small(newest), list(parts), "left")
    current = F.col("_newest").isNull() | (F.col(SEQUENCE) == F.col("_newest"))
    return joined.where(current).drop("_newest", *parts)


def ingest_upserts(
    stream: DataFrame, path: str, checkpoint: str, key: str, order: Sequence[str], delivery: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Log upserts, reduced per micro-batch, and when the store is folded, to the first and last row of each key."""
    store = _store(stream.sparkSession, path, stream.schema)
    prepare = lambda batch: _ends(batch, key, order)
    each = log_into(store, delivery or delivery_name(checkpoint), prepare, prepare)
    return run_available(stream, checkpoint, each, every=every)


def _ends(batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    whole = F.struct(*batch.columns)
    rank = F.struct(*order)
    ends = batch.groupBy(key).agg(F.min_by(whole, rank).alias("_first"), F.max_by(whole, rank).alias("_last"))
    return ends.select(F.inline(F.array_distinct(F.array("_first", "_last"))))


def upsert_state(
    spark: SparkSession, path: str, schema: T.StructType, key: str, order: Sequence[str], mutable: Sequence[str]
) -> DataFrame:
    """The current row of every key of an upsert log."""
    return load.upsert_log(rows(spark, path, schema), key, order, mutable)


def count_failures(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    at: str,
    service: str,
    status: str,
    failed: str = "failed",
    window: str = "1 hour",
    watermark: str = "1 hour",
    delivery: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Failed tasks per event-time window and service, kept up to date in a store.

    State holds open windows only; rows later than the watermark are left out.
    """
    # Watermarks need an instant; in the UTC session naive times convert one to one.
    counts = (
        stream.where(F.col(status) == failed)
        .withColumn(at, F.col(at).cast("timestamp"))
        .withWatermark(at, watermark)
        .groupBy(F.window(at, window).alias("w"), F.col(service))
        .agg(F.count("*").alias("failures"))
        .select(F.col("w.start").cast(stream.schema[at].dataType).alias("window_start"), F.col(service), "failures")
    )
    store = _store(stream.sparkSession, path, _counted(stream.schema, at, service))
    each = log_into(store, delivery or delivery_name(checkpoint), lambda batch: batch, lambda df: _last_counts(df, service))
    return run_available(counts, checkpoint, each, mode="update", every=every)


def _counted(schema: T.StructType, at: str, service: str) -> T.StructType:
    return T.StructType([T.StructField("window_start", schema[at].dataType), schema[service], T.StructField("failures", T.LongType())])


def _last_counts(stored: DataFrame, service: str) -> DataFrame:
    last = stored.groupBy("window_start", service).agg(F.max_by("failures", SEQUENCE).alias("failures"), F.max(SEQUENCE).alias(SEQUENCE))
    return last.select("window_start", service, "failures", SEQUENCE)


def failure_counts(spark: SparkSession, path: str, schema: T.StructType, at: str, service: str) -> DataFrame:
    """The last count of every window; ``schema`` is that of the task stream."""
    return _last_counts(_store(spark, path, _counted(schema, at, service)).read(), service).drop(SEQUENCE)


def ingest_codes(
    stream: DataFrame, path: str, checkpoint: str, delivery: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Payload stream to the code log; rows without a code are left out."""
    coded = messages.message_codes(stream)
    store = _store(stream.sparkSession, path, coded.schema)
    return run_available(coded, checkpoint, log_into(store, delivery or delivery_name(checkpoint), lambda batch: batch), every=every)


def code_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The codes received so far; ``schema`` is that of the payload stream."""
    kept = [f for f in schema.fields if f.name not in ("event", "result")]
    code = [T.StructField("phone", T.StringType()), T.StructField("otp_code", T.StringType())]
    return rows(spark, path, T.StructType([*kept, *code]))


def answer_requests(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    codes: Callable[[SparkSession], DataFrame],
    key: str,
    at: str,
    created_at: str,
    seconds: int = lookups.CODE_SECONDS,
    order: Sequence[str] = (),
    delivery: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Look up the newest code of each requested phone in the code log.

    ``codes`` reads the log anew for every micro-batch, as it keeps growing; of the log
    only the span that the requests can see is read on.
    """
    store = _store(stream.sparkSession, path, _answer_schema(stream.schema))

    def found(batch: DataFrame) -> DataFrame:
        bounds = batch.agg(F.min(at).cast("string").alias("low"), F.max(at).cast("string").alias("high")).first()
        log = codes(batch.sparkSession)
        # Literal bounds on the stored column are pushed into the scan.
        low, high = (F.lit(bounds[b]).cast(log.schema[created_at].dataType) for b in ("low", "high"))
        seen = log.where((F.col(created_at) > low - F.expr(f"interval {int(seconds)} seconds")) & (F.col(created_at) <= high))
        return lookups.latest_within(batch, seen, key, at, created_at, ["otp_code"], seconds, order)

    return run_available(stream, checkpoint, log_into(store, delivery or delivery_name(checkpoint), found), every=every)


def _answer_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("latest_otp_code", T.StringType())])


def answers(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Answered requests; ``schema`` is that of the request stream."""
    return rows(spark, path, _answer_schema(schema))
